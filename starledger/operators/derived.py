"""Measures by name that are more than one aggregate (M17-M21, M25, M27-M30):
each takes the star tables and returns the measure at its natural grain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact as X
from . import measures as M
from . import star as ST
from . import timeintel as TI

Tables = dict[str, DataFrame]


def _to_date(grain: str, out: str) -> Callable[[Tables], DataFrame]:
    return lambda t: TI.to_date(TI.daily_volume(t), "volume", grain, out).select("full_date", out)


def _last_month(t: Tables) -> DataFrame:
    return TI.shift_period(TI.monthly_volume(t), "volume", -1, "volume_last_month")


def _by_category(t: Tables, measures: list[str]) -> DataFrame:
    return M.query_eager(t["fact_transactions"], t["dim_merchant"], "merchant_key", "merchant_key",
                         ["merchant_category"], measures, how="left", blank=ST.BLANK)


def _p2p_to_peer(t: Tables) -> DataFrame:
    g = M.query_eager(t["fact_transactions"], t["dim_account"], "peer_account_key", "account_key",
                      {"customer_tier": "peer_customer_tier"}, ["gross_volume"], how="left", blank=ST.BLANK)
    return g.withColumnRenamed("gross_volume", "p2p_volume_to_peer")


def _share(t: Tables) -> DataFrame:
    g = _by_category(t, ["gross_volume"])                 # one row per category
    total = F.sum("gross_volume").over(Window.partitionBy()).cast(X.MONEY_SUM)
    return g.withColumn("total", total).select(
        "merchant_category", X.money_ratio_ppm("gross_volume", "total").alias("volume_share_ppm"))


def _all_dates(t: Tables) -> DataFrame:
    return t["fact_transactions"].agg(F.sum("abs_amount_egp").cast(X.MONEY_SUM).alias("total_volume_all_dates"))


def _band(t: Tables) -> DataFrame:
    g = _by_category(t, ["average_ticket"])
    return g.select("merchant_category", M.volume_band(F.col("average_ticket")).alias("volume_band"))


DERIVED: dict[str, Callable[[Tables], DataFrame]] = {
    "p2p_volume_to_peer": _p2p_to_peer,
    "volume_ytd": _to_date("year", "volume_ytd"),
    "volume_mtd": _to_date("month", "volume_mtd"),
    "volume_qtd": _to_date("quarter", "volume_qtd"),
    "volume_last_month": lambda t: _last_month(t).select("year", "month", "volume_last_month"),
    "mom_growth_ppm": lambda t: TI.growth_ppm(_last_month(t), "volume", "volume_last_month", "mom_growth_ppm").select(
        "year", "month", "mom_growth_ppm"),
    "high_value_accounts": lambda t: M.high_value_accounts(t["fact_transactions"]),
    "volume_share_ppm": _share,
    "total_volume_all_dates": _all_dates,
    "volume_band": _band,
}


def evaluate(tables: Tables, name: str) -> DataFrame:
    """F16: any measure by name; a plain one over the whole star."""
    if name in DERIVED:
        return DERIVED[name](tables)
    roles = ["date", "time"] if name in ("weekend_volume", "weekday_volume", "daytime_transactions") else []
    return M.query(M.star(tables, roles), [name])
