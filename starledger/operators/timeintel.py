"""Time intelligence.

Facts are first aggregated to one row per day (partial aggregation before the
shuffle), then laid on a spine built from the calendar, so days and months
without facts still exist.  The running-total windows partition by year (or
year/quarter, year/month) over that day-level frame: its size is bounded by
the calendar, never by the number of facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact as X
from ..functions import keys as K
from .star import broadcast_if_small

GRAIN_PARTITIONS = {"year": ["year"], "quarter": ["year", "quarter"], "month": ["year", "month"]}


def daily_volume(tables: dict[str, DataFrame], where=None) -> DataFrame:
    """Gross volume per calendar day on the full calendar spine (NULL = no facts)."""
    f = tables["fact_transactions"]
    if where is not None:
        f = f.where(where)
    per_day = f.groupBy("date_key").agg(F.sum("abs_amount_egp").cast(X.MONEY_SUM).alias("volume"))
    cal = tables["dim_date"].select("date_key", "full_date", "year", "quarter", "month")
    return cal.join(per_day, "date_key", "left")


def member_days(per_day: DataFrame, calendar: DataFrame, by: list[str], value: str = "volume") -> DataFrame:
    """W3-W8 per member: the days of each member of ``by``, from its first to its
    last active day in the current slicers, NULL on days without facts.

    ``per_day`` has one row per (member, date_key).  The spine is made of one row
    per member, so it is as long as members are active, not members times the
    calendar, and a member's days stay together: no join of members with days."""
    days = calendar.select("date_key", "full_date")
    active = per_day.join(broadcast_if_small(days), "date_key")
    # the span and the values of a member go through one exchange by member
    spans = active.groupBy(*by).agg(F.min("full_date").alias("_first"), F.max("full_date").alias("_last"))
    spine = spans.select(*by, F.explode(F.sequence("_first", "_last")).alias("full_date"))
    held = active.select(*[F.col(c).alias(f"_m_{c}") for c in by], F.col("full_date").alias("_day"), value)
    match = F.col("full_date") == F.col("_day")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_m_{c}"))
    d = F.col("full_date")
    return (spine.join(held, match, "left").select(*by, "full_date", value)
            .withColumns({"year": F.year(d), "quarter": F.quarter(d), "month": F.month(d)}))


def member_months(days: DataFrame, by: list[str], value: str = "volume") -> DataFrame:
    """Volume per member and month over a member's days (``member_days``)."""
    return (days.groupBy(*by, "year", "month").agg(F.sum(value).cast(X.MONEY_SUM).alias(value),
                                                   F.min("full_date").alias("_first"))
            .withColumn("month_index", K.month_index("_first")).drop("_first"))


def to_date(daily: DataFrame, value: str = "volume", grain: str = "year", out: str | None = None,
            by: list[str] = ()) -> DataFrame:
    """Running total from the start of the year / quarter / month, for
    each member of ``by``."""
    w = (Window.partitionBy(*by, *GRAIN_PARTITIONS[grain]).orderBy("full_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.withColumn(out or f"{value}_{grain[0]}td",
                            F.coalesce(F.sum(value).over(w), F.lit(0)).cast(X.MONEY_SUM))


def monthly_volume(tables: dict[str, DataFrame], where=None) -> DataFrame:
    """Gross volume per month on the calendar's month spine."""
    f = tables["fact_transactions"]
    if where is not None:
        f = f.where(where)
    per_day = f.groupBy("date_key").agg(F.sum("abs_amount_egp").cast(X.MONEY_SUM).alias("v"))
    cal = tables["dim_date"].select("date_key", "year", "month", "full_date")
    months = cal.groupBy("year", "month").agg(F.min("full_date").alias("month_start"))
    vol = (per_day.join(cal, "date_key", "inner").groupBy("year", "month")
                  .agg(F.sum("v").cast(X.MONEY_SUM).alias("volume")))
    return (months.join(vol, ["year", "month"], "left")
                  .withColumn("month_index", K.month_index("month_start")))


def shift_period(monthly: DataFrame, value: str = "volume", months: int = -1, out: str | None = None,
                 by: list[str] = ()) -> DataFrame:
    """The value of the month ``months`` away, by month index (gap-safe),
    of the same member of ``by``."""
    if by:
        # a member has one row per month: its own window, no self-join
        at = Window.partitionBy(*by).orderBy("month_index").rangeBetween(months, months)
        return monthly.withColumn(out or f"{value}_shifted", F.max(value).over(at))
    prev = monthly.select((F.col("month_index") - months).alias("month_index"), F.col(value).alias("__shifted"))
    return monthly.join(prev, "month_index", "left").withColumnRenamed("__shifted", out or f"{value}_shifted")


def growth_ppm(df: DataFrame, cur: str, prev: str, out: str) -> DataFrame:
    """(cur - prev) / prev in ppm, half-up, NULL when prev is NULL or 0."""
    num = X.to_minor(F.coalesce(F.col(cur), F.lit(0)) - F.col(prev))
    return df.withColumn(out, X.half_up_div(num * X.PPM, X.to_minor(prev)).cast("bigint"))


def same_day_shifted(daily: DataFrame, value: str = "volume", months: int = -1, out: str | None = None,
                     by: list[str] = ()) -> DataFrame:
    """Value of the same day ``months`` earlier (day clamped to month end),
    of the same member of ``by``."""
    prev = daily.select(*[F.col(c).alias(f"__m_{c}") for c in by], F.col("full_date").alias("__d"), F.col(value).alias("__v"))
    match = F.add_months(daily["full_date"], months) == prev["__d"]
    for c in by:
        match = match & daily[c].eqNullSafe(prev[f"__m_{c}"])
    j = daily.join(prev, match, "left")
    return j.drop("__d", *[f"__m_{c}" for c in by]).withColumnRenamed("__v", out or f"{value}_shifted")
