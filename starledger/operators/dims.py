"""Dimension builders.

The calendar and clock dimensions are generated by Spark from their bounds,
so their size depends on the date range (days) or is fixed (1,440 minutes),
never on the fact size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import keys as K


def calendar_from_bounds(bounds: DataFrame, weekend_days=(6, 7)) -> DataFrame:
    """One row per day between ``lo`` and ``hi`` (inclusive) of a one-row
    ``bounds`` frame (DateType columns ``lo``, ``hi``)."""
    days = bounds.select(F.explode(F.sequence(F.col("lo"), F.col("hi"), F.expr("interval 1 day"))).alias("full_date"))
    return days.select(
        K.date_key("full_date").alias("date_key"),
        F.col("full_date"),
        F.dayofmonth("full_date").alias("day"),
        F.month("full_date").alias("month"),
        F.quarter("full_date").alias("quarter"),
        F.year("full_date").alias("year"),
        K.is_weekend("full_date", weekend_days).alias("is_weekend"),
    )


def calendar(spark: SparkSession, start: str, end: str, weekend_days=(6, 7)) -> DataFrame:
    """D1 with literal bounds (``yyyy-MM-dd``)."""
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("lo"), F.to_date(F.lit(end)).alias("hi"))
    return calendar_from_bounds(bounds, weekend_days)


def calendar_covering(dates: DataFrame, date_col: str, weekend_days=(6, 7)) -> DataFrame:
    """D1 spanning min..max of a date column (one partial+final aggregate)."""
    d = F.col(date_col).cast("date")
    bounds = dates.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    return calendar_from_bounds(bounds, weekend_days)


def time_of_day(spark: SparkSession) -> DataFrame:
    """Minute-of-day dimension, 1,440 rows."""
    m = spark.range(0, 1440, numPartitions=1)
    h, mi = (F.col("id") / 60).cast("int"), (F.col("id") % 60).cast("int")
    return m.select(
        K.time_key(h, mi).alias("time_key"),
        h.alias("hour_of_day"),
        K.time_bucket(h).alias("time_bucket"),
        K.is_daytime(h).alias("is_daytime"),
        K.hour_label(h, mi).alias("hour_label"),
    )


def clock_attributes(df: DataFrame, ts_col: str) -> DataFrame:
    """D2 derivations (F3, F6, F7) for the minute of day of a timestamp column."""
    h, mi = F.hour(ts_col), F.minute(ts_col)
    return df.withColumns({
        "time_key": K.time_key(h, mi), "hour_of_day": h.cast("int"), "time_bucket": K.time_bucket(h),
        "is_daytime": K.is_daytime(h), "hour_label": K.hour_label(h, mi)})


def assign_lookup_keys(values: DataFrame, value_col: str, key_col: str, order: list[Column] | None = None) -> DataFrame:
    """D3: key 1..n for the distinct values of a small lookup, by the given
    order (default: the value itself).  The distinct set is small by
    definition (a lookup); the global window runs on it, not on facts."""
    distinct = values.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    w = Window.orderBy(*(order or [F.col(value_col)]))
    return distinct.select(F.row_number().over(w).cast("int").alias(key_col), value_col)


def numbered_names(df: DataFrame, group_cols: list[str], order_col: str, base: Column, out: str) -> DataFrame:
    """Number members within a group and append the number to a base name,
    e.g. ``<brand> - <city> #2``."""
    w = Window.partitionBy(*group_cols).orderBy(order_col)
    return df.withColumn(out, F.concat(base, F.lit(" #"), F.row_number().over(w).cast("string")))


def derive_amounts(df: DataFrame, abs_col: str = "abs_amount_egp", outbound: str = "is_outbound",
                   rate_e6: str = "exchange_rate_e6") -> DataFrame:
    """Signed amount, minor units and foreign minor amount from the
    absolute amount, the direction flag and the x1e6 exchange rate."""
    from ..functions import exact as X
    signed = X.signed_amount(abs_col, outbound)
    abs_minor = (F.col(abs_col).cast(X.MONEY) * 100).cast("bigint")
    return df.withColumns({
        "amount_egp": signed,
        "amount_minor": (signed * 100).cast("bigint"),
        "fx_amount_minor": F.when(F.col(rate_e6).isNotNull(), X.fx_minor(abs_minor, F.col(rate_e6))),
    })
