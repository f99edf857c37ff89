"""Layer I/O: untyped landing of source files (S1-S3), layer scans (S4), the
warehouse load (S15).  Batch sinks (S11-S14) are in ``batches``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..contracts import TableContract
from .batches import list_batches, read_batch, write_batch_partition
from .landing import land


def land_csv(spark: SparkSession, path: str, contract: TableContract, run_ts: str) -> DataFrame:
    """The well-formed rows of ``landing.land``: contract columns by
    header name, every field a string, lineage.  Use ``land`` itself for the
    records of the wrong width and the columns beyond the contract."""
    return land(spark, path, contract, run_ts).rows.drop("_extra")


def read_layer(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan of a layer table (column pruning reaches the scan)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None, batch_size: int = 50000,
               truncate: bool = True) -> None:
    """Optional load of a layer table into an external warehouse table
    (overwrite keeps the table definition via TRUNCATE; rows go in batches).
    The Parquet gold store stays the system of record."""
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", batch_size).option("truncate", truncate).mode("overwrite"))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


__all__ = ["land_csv", "read_layer", "write_jdbc", "write_batch_partition", "list_batches", "read_batch"]
