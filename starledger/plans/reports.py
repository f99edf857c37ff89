"""Reporting views over the gold star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exact as X
from ..operators.star import join_dim


def rpt_daily(tables: dict[str, DataFrame]) -> DataFrame:
    """Per calendar day (+ year, month, weekend): count, declined, fx, gross
    volume and average ticket as decimal(18,2)."""
    f = tables["fact_transactions"].select("date_key", "is_declined", "is_fx", "abs_amount_egp")
    j = join_dim(f, tables["dim_date"], "date_key", "date_key", ["full_date", "year", "month", "is_weekend"])
    agg = j.groupBy("full_date", "year", "month", "is_weekend").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("is_declined").cast("bigint").alias("declined_count"),
        F.sum("is_fx").cast("bigint").alias("fx_count"),
        F.sum("abs_amount_egp").alias("_gross"),
    )
    return agg.select(
        "full_date", "year", "month", "is_weekend", "txn_count", "declined_count", "fx_count",
        F.col("_gross").cast(X.MONEY).alias("gross_volume_egp"),
        X.avg_money("_gross", "txn_count").alias("avg_ticket_egp"),
    )


def rpt_health(tables: dict[str, DataFrame]) -> DataFrame:
    """R2/Q22: one-row warehouse health snapshot."""
    f = tables["fact_transactions"]
    return f.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_distinct("transaction_id").alias("distinct_transaction_ids"),
        F.sum("is_outbound").cast("bigint").alias("outbound_count"),
        F.sum("is_declined").cast("bigint").alias("declined_count"),
        F.sum("is_fx").cast("bigint").alias("fx_count"),
        F.min("date_key").alias("min_date_key"),
        F.max("date_key").alias("max_date_key"),
        F.sum("abs_amount_egp").cast("decimal(20,2)").alias("gross_volume_egp"),
    )


def register_views(spark: SparkSession, tables: dict[str, DataFrame], schema_prefix: str = "") -> list[str]:
    """Register the star and the reporting views as temp views, names verbatim."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{schema_prefix}{name}")
        names.append(f"{schema_prefix}{name}")
    for name, fn in (("rpt_daily_transactions", rpt_daily), ("rpt_warehouse_health", rpt_health)):
        fn(tables).createOrReplaceTempView(f"{schema_prefix}{name}")
        names.append(f"{schema_prefix}{name}")
    return names
