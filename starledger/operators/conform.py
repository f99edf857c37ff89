"""Conform raw string tables to their contract.

Per contracted column: trim spaces (``trim`` removes U+0020 only, as the
reference's trim does), empty -> NULL, then a *tolerant* cast: a malformed
value becomes NULL instead of failing the job (``try_cast``; ANSI mode stays
on).  Only the contracted columns are kept, in contract order, plus any
``carry`` columns (lineage) appended after them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import TableContract


def blank_to_null(c: Column) -> Column:
    """Trim, then '' -> NULL."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def tolerant_cast(c: Column, dtype: T.DataType) -> Column:
    """P5: malformed -> NULL."""
    if isinstance(dtype, T.StringType):
        return c
    return c.try_cast(dtype)


def conform(df: DataFrame, contract: TableContract, carry: list[str] | tuple = (),
            carry_types: dict[str, T.DataType] | None = None) -> DataFrame:
    cols = []
    for col in contract.columns:
        src = F.col(col.name) if col.name in df.columns else F.lit(None).cast("string")
        cols.append(tolerant_cast(blank_to_null(src), col.spark_type).alias(col.name))
    for c in carry:
        v = F.col(c)
        if carry_types and c in carry_types:
            v = tolerant_cast(blank_to_null(v), carry_types[c])
        cols.append(v.alias(c))
    return df.select(*cols)


def with_batch_metadata(df: DataFrame, batch_id: str | Column, processed_at: str) -> DataFrame:
    """Constant run metadata plus the partition copy of the batch id."""
    b = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return df.withColumns({"_silver_processed_at_utc": F.lit(processed_at), "_silver_batch_id": b,
                           "silver_batch_id": b})
