"""Query catalog: one Spark plan per SURVEY inventory key.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the gold
star built from that folder (or over raw / event frames the adapter derives
from it).  Output columns are aliased and cast so they match the oracle SQL
(plans/oracle_queries.py) name for name and type for type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import TIME_BUCKETS
from ..functions import exact as X
from ..functions import keys as K
from ..operators import context as CX
from ..operators import measures as M
from ..operators import star as ST
from ..operators import timeintel as TI
from . import reports
from .gold import star_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _q(spark, sf_dir, roles, measures, **kw) -> DataFrame:
    t = star_tables(spark, sf_dir)
    return M.query(M.star(t, roles), measures, **kw)


def _account_dim(t, with_location: bool = False) -> DataFrame:
    a = t["dim_account"]
    if not with_location:
        return a
    return ST.join_dim(a, t["dim_location"], "location_key", "location_key",
                       {"city": "customer_city", "governorate": "customer_governorate"})


def _merchant_dim(t) -> DataFrame:
    return ST.join_dim(t["dim_merchant"], t["dim_location"], "location_key", "location_key",
                       {"city": "merchant_city", "governorate": "merchant_governorate"}, "left")


def _by_account(spark, sf_dir, attrs, measures, with_location=False, **kw) -> DataFrame:
    """Reports over account attributes: eager aggregation on account_key."""
    t = star_tables(spark, sf_dir)
    return M.query_eager(t["fact_transactions"], _account_dim(t, with_location), "account_key", "account_key",
                         attrs, measures, **kw)


def _by_merchant(spark, sf_dir, attrs, measures, **kw) -> DataFrame:
    """Reports over merchant attributes: eager aggregation on merchant_key,
    left join so facts without a merchant form the (Blank) member."""
    t = star_tables(spark, sf_dir)
    return M.query_eager(t["fact_transactions"], _merchant_dim(t), "merchant_key", "merchant_key", attrs,
                         measures, how="left", blank=ST.BLANK, **kw)


# -- reporting views (R1, R2, S17) ---------------------------------------------
@register("rpt_daily")
def q_rpt_daily(spark, sf_dir):
    return reports.rpt_daily(star_tables(spark, sf_dir))


@register("rpt_health")
def q_rpt_health(spark, sf_dir):
    return reports.rpt_health(star_tables(spark, sf_dir))


@register("gold_summary")
def q_gold_summary(spark, sf_dir):
    f = star_tables(spark, sf_dir)["fact_transactions"]
    a = f.agg(F.count(F.lit(1)).alias("fact_rows"), F.sum("abs_amount_egp").alias("_s"))
    return a.select("fact_rows", X.avg_money("_s", "fact_rows").cast("decimal(10,2)").alias("avg_ticket_egp"))


# -- measures (M*, A7, A12, P8) -------------------------------------------------
@register("measures_total")
def q_measures_total(spark, sf_dir):
    return _q(spark, sf_dir, [], M.CORE_KPIS)


@register("measures_by_group")
def q_measures_by_group(spark, sf_dir):
    return _q(spark, sf_dir, ["type"], ["transaction_count", "average_ticket", "decline_rate_ppm", "fx_share_ppm"],
              by=["transaction_group"])


@register("avg_fx_rate")
def q_avg_fx_rate(spark, sf_dir):
    return _q(spark, sf_dir, ["date"], ["avg_exchange_rate", "fx_transactions"], by=["year", "month"])


@register("weekend_split")
def q_weekend_split(spark, sf_dir):
    return _q(spark, sf_dir, ["date"], ["weekend_volume", "weekday_volume"])


@register("daytime_count")
def q_daytime_count(spark, sf_dir):
    return _q(spark, sf_dir, ["time"], ["daytime_transactions", "transaction_count"])


@register("total_surcharge")
def q_total_surcharge(spark, sf_dir):
    return _q(spark, sf_dir, ["date"], ["total_surcharge"], by=["year"])


@register("high_value_accounts")
def q_high_value_accounts(spark, sf_dir):
    return M.high_value_accounts(star_tables(spark, sf_dir)["fact_transactions"])


@register("volume_band")
def q_volume_band(spark, sf_dir):
    g = _by_merchant(spark, sf_dir, ["merchant_size"], ["average_ticket"])
    return g.withColumn("volume_band", M.volume_band(F.col("average_ticket")))


@register("selected_value")
def q_selected_value(spark, sf_dir):
    f = M.star(star_tables(spark, sf_dir), ["type"])
    return f.groupBy("transaction_group").agg(
        F.when(F.count_distinct("transaction_type_name") == 1, F.max("transaction_type_name"))
         .otherwise(F.lit("All Types")).alias("selected_type"))


@register("category_share")
def q_category_share(spark, sf_dir):
    g = _by_merchant(spark, sf_dir, ["merchant_category"], ["gross_volume"])
    total = F.sum("gross_volume").over(_window_all())
    return g.withColumn("total_volume", total.cast(X.MONEY_SUM)) \
            .withColumn("volume_share_ppm", X.money_ratio_ppm("gross_volume", "total_volume"))


def _window_all():
    from pyspark.sql import Window
    # over the grouped result only: one row per group, never per fact
    return Window.partitionBy()


@register("all_dates_share")
def q_all_dates_share(spark, sf_dir):
    g = _q(spark, sf_dir, ["date"], ["gross_volume"], by=["year"])
    return g.withColumn("total_volume_all_dates", F.sum("gross_volume").over(_window_all()).cast(X.MONEY_SUM)) \
            .withColumn("share_ppm", X.money_ratio_ppm("gross_volume", "total_volume_all_dates"))


# -- report pages (R3-R14, A8, A14, A18, T*) -----------------------------------
@register("mix_by_group")
def q_mix_by_group(spark, sf_dir):
    return _q(spark, sf_dir, ["type"], ["transaction_count", "gross_volume"], by=["transaction_group"])


@register("account_status_mix")
def q_account_status_mix(spark, sf_dir):
    a = star_tables(spark, sf_dir)["dim_account"]
    return a.groupBy("account_status").agg(F.count(F.lit(1)).alias("accounts"))


@register("category_size")
def q_category_size(spark, sf_dir):
    return _by_merchant(spark, sf_dir, ["merchant_category", "merchant_size"], ["gross_volume", "transaction_count"])


@register("city_drill")
def q_city_drill(spark, sf_dir):
    return _by_account(spark, sf_dir, ["customer_governorate", "customer_city"],
                       ["gross_volume", "transaction_count"], with_location=True)


@register("count_by_channel")
def q_count_by_channel(spark, sf_dir):
    return _by_account(spark, sf_dir, ["acquisition_channel"], ["transaction_count"])


@register("customer_geo")
def q_customer_geo(spark, sf_dir):
    return _by_account(spark, sf_dir, ["customer_governorate"], ["gross_volume", "active_accounts"],
                       with_location=True)


@register("merchant_geo")
def q_merchant_geo(spark, sf_dir):
    return _by_merchant(spark, sf_dir, ["merchant_governorate"], ["gross_volume", "distinct_merchants"])


@register("decline_by_category")
def q_decline_by_category(spark, sf_dir):
    return _by_merchant(spark, sf_dir, ["merchant_category"],
                        ["decline_rate_ppm", "declined_transactions", "gross_volume"])


@register("decline_rate_by_month")
def q_decline_rate_by_month(spark, sf_dir):
    return _q(spark, sf_dir, ["date"], ["decline_rate_ppm", "declined_transactions", "transaction_count"],
              by=["year", "month"])


@register("declines_by_reason")
def q_declines_by_reason(spark, sf_dir):
    return _q(spark, sf_dir, ["decline_reason"], ["declined_transactions", "declined_volume"],
              by=["decline_reason_name"], where=F.col("is_declined") == 1,
              order=[F.desc("declined_transactions"), F.asc("decline_reason_name")])


@register("direction_by_group")
def q_direction_by_group(spark, sf_dir):
    return _q(spark, sf_dir, ["type"], ["outbound_volume", "inbound_volume"], by=["transaction_group"])


@register("engagement_by_tier")
def q_engagement_by_tier(spark, sf_dir):
    return _by_account(spark, sf_dir, ["customer_tier"],
                       ["active_accounts", "transaction_count", "avg_txn_per_account_ppm"])


@register("fx_by_category")
def q_fx_by_category(spark, sf_dir):
    return _by_merchant(spark, sf_dir, ["merchant_category"], ["fx_transactions", "fx_volume"])


@register("fx_by_month")
def q_fx_by_month(spark, sf_dir):
    return _q(spark, sf_dir, ["date"], ["fx_volume", "fx_transactions", "fx_share_ppm"], by=["year", "month"])


@register("heatmap")
def q_heatmap(spark, sf_dir):
    f = M.star(star_tables(spark, sf_dir), ["time", "date"])
    p = f.groupBy("time_bucket").pivot("is_weekend", [0, 1]).agg(F.count(F.lit(1)))
    return p.select("time_bucket", F.coalesce(F.col("0"), F.lit(0)).cast("bigint").alias("weekday_count"),
                    F.coalesce(F.col("1"), F.lit(0)).cast("bigint").alias("weekend_count"))


@register("heatmap_volume")
def q_heatmap_volume(spark, sf_dir):
    """Gross volume of the time matrix."""
    f = M.star(star_tables(spark, sf_dir), ["time", "date"])
    g = M.query(f, ["gross_volume"], by=["time_bucket", "is_weekend"])
    p = g.groupBy("time_bucket").pivot("is_weekend", [0, 1]).agg(F.first("gross_volume"))
    return p.select("time_bucket", F.coalesce(F.col("0"), F.lit(0)).cast(X.MONEY_SUM).alias("weekday_volume"),
                    F.coalesce(F.col("1"), F.lit(0)).cast(X.MONEY_SUM).alias("weekend_volume"))


@register("volume_by_age_band")
def q_volume_by_age_band(spark, sf_dir):
    return _by_account(spark, sf_dir, ["age_band"], ["gross_volume", "transaction_count", "average_ticket"])


@register("count_by_merchant_category")
def q_count_by_merchant_category(spark, sf_dir):
    return _by_merchant(spark, sf_dir, ["merchant_category"], ["transaction_count", "decline_rate_ppm"])


@register("governorate_concentration")
def q_governorate_concentration(spark, sf_dir):
    """Active governorates, the top one and its share of the volume."""
    g = _by_account(spark, sf_dir, ["customer_governorate"], ["gross_volume"], with_location=True)
    top = F.min(F.struct((-F.col("gross_volume")).alias("v"), F.col("customer_governorate").alias("name")))
    a = g.agg(F.count(F.lit(1)).alias("active_governorates"), top.alias("t"), F.sum("gross_volume").cast(X.MONEY_SUM).alias("total"))
    return (a.withColumn("top_volume", (-F.col("t.v")).cast(X.MONEY_SUM))
            .select("active_governorates", F.col("t.name").alias("top_governorate"), "top_volume",
                    X.money_ratio_ppm("top_volume", "total").alias("top_share_ppm")))


@register("fx_by_group")
def q_fx_by_group(spark, sf_dir):
    return _q(spark, sf_dir, ["type"], ["fx_transactions", "fx_volume", "fx_share_ppm"], by=["transaction_group"])


@register("fx_split")
def q_fx_split(spark, sf_dir):
    """FX against domestic transactions."""
    return _q(spark, sf_dir, [], ["transaction_count", "gross_volume", "average_ticket", "decline_rate_ppm"],
              by=["is_fx"])


@register("tier_time_decline")
def q_tier_time_decline(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    g = M.query_eager(t["fact_transactions"], t["dim_account"], "account_key", "account_key", ["customer_tier"],
                      ["decline_rate_ppm"], post=[(t["dim_time"], "time_key", "time_key", ["time_bucket"])])
    p = g.groupBy("customer_tier").pivot("time_bucket", list(TIME_BUCKETS)).agg(F.first("decline_rate_ppm"))
    return p.select("customer_tier", *[F.col(b).alias(f"{b.lower()}_decline_ppm") for b in TIME_BUCKETS])


@register("type_by_declined")
def q_type_by_declined(spark, sf_dir):
    return _q(spark, sf_dir, ["type"], ["transaction_count"], by=["transaction_type_name", "is_declined"])


@register("volume_by_category")
def q_volume_by_category(spark, sf_dir):
    return _by_merchant(spark, sf_dir, ["merchant_category"], ["gross_volume"]) \
        .orderBy(F.desc("gross_volume"), F.asc("merchant_category"))


@register("volume_by_governorate")
def q_volume_by_governorate(spark, sf_dir):
    return _by_account(spark, sf_dir, ["customer_governorate"], ["gross_volume"], with_location=True) \
        .orderBy(F.desc("gross_volume"), F.asc("customer_governorate"))


@register("volume_by_tier")
def q_volume_by_tier(spark, sf_dir):
    return _by_account(spark, sf_dir, ["customer_tier"], ["gross_volume", "transaction_count"])


@register("size_by_month")
def q_size_by_month(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    return M.query_eager(t["fact_transactions"], _merchant_dim(t), "merchant_key", "merchant_key",
                         ["merchant_size"], ["gross_volume"], how="left", blank=ST.BLANK,
                         dates=t["dim_date"], date_attrs=["year", "month"])


@register("top20_merchants")
def q_top20_merchants(spark, sf_dir):
    g = _by_merchant(spark, sf_dir, {"merchant_key": "merchant_key_", "merchant_name": "merchant_name"},
                     ["gross_volume"], where=F.col("merchant_key").isNotNull())
    return (g.withColumnRenamed("merchant_key_", "merchant_key")
             .orderBy(F.desc("gross_volume"), F.asc("merchant_key")).limit(20))


@register("top10_merchants")
def q_top10_merchants(spark, sf_dir):
    g = _by_merchant(spark, sf_dir, {"merchant_key": "merchant_key_", "merchant_name": "merchant_name",
                                     "merchant_category": "merchant_category"},
                     ["gross_volume", "transaction_count", "average_ticket", "decline_rate_ppm"],
                     where=F.col("merchant_key").isNotNull())
    return (g.withColumnRenamed("merchant_key_", "merchant_key")
             .orderBy(F.desc("gross_volume"), F.asc("merchant_key")).limit(10))


@register("top_p2p")
def q_top_p2p(spark, sf_dir):
    return _q(spark, sf_dir, [], ["p2p_transactions", "gross_volume"], by=["account_key"],
              where=F.col("peer_account_key").isNotNull(),
              order=[F.desc("p2p_transactions"), F.asc("account_key")], top=10)


@register("p2p_by_month")
def q_p2p_by_month(spark, sf_dir):
    return _q(spark, sf_dir, ["date"], ["p2p_transactions", "gross_volume"], by=["year", "month"],
              where=F.col("peer_account_key").isNotNull())


@register("p2p_by_tier")
def q_p2p_by_tier(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    g = M.query_eager(t["fact_transactions"], t["dim_account"], "peer_account_key", "account_key",
                      {"customer_tier": "peer_customer_tier"}, ["gross_volume"], how="left", blank=ST.BLANK)
    return g.withColumnRenamed("gross_volume", "p2p_volume_to_peer")


@register("hour_profile")
def q_hour_profile(spark, sf_dir):
    return _q(spark, sf_dir, ["time"], ["transaction_count", "gross_volume"], by=["hour_of_day"])


@register("volume_by_week")
def q_volume_by_week(spark, sf_dir):
    f = M.star(star_tables(spark, sf_dir), ["date"]).withColumn(
        "week_start", F.date_trunc("week", F.col("full_date")).cast("date"))
    return M.query(f, ["gross_volume", "transaction_count"], by=["week_start"])


@register("fx_rate_distribution")
def q_fx_rate_distribution(spark, sf_dir):
    return _q(spark, sf_dir, [], ["fx_transactions", "fx_volume"], by=["exchange_rate_e6"],
              where=F.col("is_fx") == 1)


@register("slicer_query")
def q_slicer_query(spark, sf_dir):
    """Date range + IN-lists on dimension attributes, propagated to the fact."""
    t = star_tables(spark, sf_dir)
    # date slicer as a date_key range on the fact (reaches the Parquet scan),
    # type slicer as a semi join with the bounded type dimension, account
    # slicer applied to the account dimension inside an eager aggregation
    fact = t["fact_transactions"].where(F.col("date_key").between(K.date_key(F.lit("1996-01-01").cast("date")),
                                                                   K.date_key(F.lit("1996-12-31").cast("date"))))
    types = t["dim_transaction_type"].where(F.col("transaction_group").isin("Payment")).select("transaction_type_key")
    fact = fact.join(ST.broadcast_if_small(types), "transaction_type_key", "left_semi")
    accounts = _account_dim(t, with_location=True).where(F.col("customer_tier").isin("Premium", "Business"))
    return M.query_eager(fact, accounts, "account_key", "account_key", ["customer_governorate"],
                         ["gross_volume", "transaction_count"])


@register("type_rollup")
def q_type_rollup(spark, sf_dir):
    return _q(spark, sf_dir, ["type"], ["transaction_count", "gross_volume", "average_ticket"],
              by=["transaction_group", "transaction_type_name"], totals="rollup")


@register("detail_table")
def q_detail_table(spark, sf_dir):
    """Drill-through detail with presentation names."""
    t = star_tables(spark, sf_dir)
    # drill-through filters first: the year as a date_key range on the fact scan,
    # the category as a semi join with the merchant keys; then the six roles
    fact = t["fact_transactions"].where(F.col("date_key").between(19970101, 19971231))
    cat = t["dim_merchant"].where(F.col("merchant_category") == "CAT_3").select("merchant_key")
    fact = fact.join(ST.broadcast_if_small(cat), "merchant_key", "left_semi")
    f = M.star(t, ["date", "time", "account", "type", "decline_reason", "merchant", "customer_location"], fact=fact)
    return f.select(
        F.col("transaction_id").alias("Transaction ID"), F.col("full_date").alias("Date"),
        F.col("hour_label").alias("Time"), F.col("account_id").alias("Account"),
        F.col("merchant_name").alias("Merchant"), F.col("transaction_type_name").alias("Type"),
        F.col("amount_egp").alias("Amount (EGP)"), F.col("is_declined").alias("Declined"),
        F.col("decline_reason_name").alias("Decline Reason"), F.col("customer_city").alias("City"))


@register("related_governorate")
def q_related_governorate(spark, sf_dir):
    f = M.star(star_tables(spark, sf_dir), ["customer_location"])
    return f.select("transaction_id", "customer_governorate")


@register("txn_count_per_account")
def q_txn_count_per_account(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    return ST.fact_count_per_member(t["dim_account"].select("account_key"), t["fact_transactions"], "account_key",
                                    "transaction_count")


@register("inactive_accounts")
def q_inactive_accounts(spark, sf_dir):
    """Accounts without any fact."""
    t = star_tables(spark, sf_dir)
    return ST.members_without_facts(t["dim_account"].select("account_key", "account_id"), t["fact_transactions"],
                                    "account_key")


@register("merchants_blank")
def q_merchants_blank(spark, sf_dir):
    return _by_merchant(spark, sf_dir, ["merchant_name"], ["transaction_count"])


@register("signups_by_month")
def q_signups_by_month(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    a = ST.join_dim(t["dim_account"], t["dim_date"], "signup_date_key", "date_key",
                    {"year": "signup_year", "month": "signup_month"})
    return a.groupBy("signup_year", "signup_month").agg(F.count(F.lit(1)).alias("signups"))


@register("merchants_opened_by_month")
def q_merchants_opened_by_month(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    m = ST.join_dim(t["dim_merchant"], t["dim_date"], "opened_date_key", "date_key",
                    {"year": "opened_year", "month": "opened_month"})
    return m.groupBy("opened_year", "opened_month").agg(F.count(F.lit(1)).alias("merchants_opened"))


@register("month_labels")
def q_month_labels(spark, sf_dir):
    d = star_tables(spark, sf_dir)["dim_date"]
    return (d.groupBy("year", "month").agg(F.min("full_date").alias("_d"))
             .select("year", "month", K.month_name("_d").alias("month_name"), K.month_label("_d").alias("month_label"))
             .orderBy("year", "month"))


# -- time intelligence (W3-W8) -------------------------------------------------
@register("volume_ytd")
def q_volume_ytd(spark, sf_dir):
    d = TI.to_date(TI.daily_volume(star_tables(spark, sf_dir)), "volume", "year", "volume_ytd")
    return d.select("full_date", "volume", "volume_ytd")


@register("volume_qtd")
def q_volume_qtd(spark, sf_dir):
    d = TI.to_date(TI.daily_volume(star_tables(spark, sf_dir)), "volume", "quarter", "volume_qtd")
    return d.select("full_date", "volume", "volume_qtd")


@register("volume_mtd")
def q_volume_mtd(spark, sf_dir):
    d = TI.to_date(TI.daily_volume(star_tables(spark, sf_dir)), "volume", "month", "volume_mtd")
    return d.select("full_date", "volume", "volume_mtd")


@register("volume_last_month")
def q_volume_last_month(spark, sf_dir):
    m = TI.shift_period(TI.monthly_volume(star_tables(spark, sf_dir)), "volume", -1, "volume_last_month")
    return m.select("year", "month", "volume", "volume_last_month")


@register("mom_growth")
def q_mom_growth(spark, sf_dir):
    m = TI.shift_period(TI.monthly_volume(star_tables(spark, sf_dir)), "volume", -1, "volume_last_month")
    m = TI.growth_ppm(m, "volume", "volume_last_month", "mom_growth_ppm")
    return m.select("year", "month", "volume", "volume_last_month", "mom_growth_ppm")


@register("same_day_last_month")
def q_same_day_last_month(spark, sf_dir):
    d = TI.same_day_shifted(TI.daily_volume(star_tables(spark, sf_dir)), "volume", -1, "volume_same_day_last_month")
    return d.select("full_date", "volume", "volume_same_day_last_month")


def _days_by_account_attr(t, attr, where=None, with_location=False) -> DataFrame:
    """Volume per (account attribute, day): the fact is reduced by account and
    day before the account dimension is joined."""
    per_day = M.query_eager(t["fact_transactions"], _account_dim(t, with_location), "account_key", "account_key", [attr],
                            ["gross_volume"], fact_by=["date_key"], where=where).withColumnRenamed("gross_volume", "volume")
    return TI.member_days(per_day, t["dim_date"], [attr])


def _to_date_by(days, attr) -> DataFrame:
    for grain, out in (("year", "volume_ytd"), ("quarter", "volume_qtd"), ("month", "volume_mtd")):
        days = TI.to_date(days, "volume", grain, out, [attr])
    return days.select(attr, "full_date", "volume", "volume_ytd", "volume_qtd", "volume_mtd")


def _growth_by(days, attr) -> DataFrame:
    m = TI.shift_period(TI.member_months(days, [attr]), "volume", -1, "volume_last_month", [attr])
    m = TI.growth_ppm(m, "volume", "volume_last_month", "mom_growth_ppm")
    return m.select(attr, "year", "month", "volume", "volume_last_month", "mom_growth_ppm")


@register("to_date_by_tier")
def q_to_date_by_tier(spark, sf_dir):
    """M18, M19, M25 in the context of a customer tier."""
    return _to_date_by(_days_by_account_attr(star_tables(spark, sf_dir), "customer_tier"), "customer_tier")


@register("to_date_by_governorate")
def q_to_date_by_governorate(spark, sf_dir):
    """The same by governorate, under a slicer (declined transactions)."""
    t = star_tables(spark, sf_dir)
    return _to_date_by(_days_by_account_attr(t, "customer_governorate", F.col("is_declined") == 1, True), "customer_governorate")


@register("growth_by_tier")
def q_growth_by_tier(spark, sf_dir):
    """M20, M21 in the context of a customer tier, under a slicer (FX)."""
    return _growth_by(_days_by_account_attr(star_tables(spark, sf_dir), "customer_tier", F.col("is_fx") == 1), "customer_tier")


@register("growth_by_governorate")
def q_growth_by_governorate(spark, sf_dir):
    t = star_tables(spark, sf_dir)
    return _growth_by(_days_by_account_attr(t, "customer_governorate", None, True), "customer_governorate")


@register("same_day_by_tier")
def q_same_day_by_tier(spark, sf_dir):
    days = _days_by_account_attr(star_tables(spark, sf_dir), "customer_tier")
    d = TI.same_day_shifted(days, "volume", -1, "volume_same_day_last_month", ["customer_tier"])
    return d.select("customer_tier", "full_date", "volume", "volume_same_day_last_month")


# -- distinct counts that merge, totals from partials (A4, A15, M14-M16) ----------
@register("merchants_by_governorate")
def q_merchants_by_governorate(spark, sf_dir):
    """Distinct merchants per customer governorate: counted off the key by which
    the facts are reduced."""
    return _by_account(spark, sf_dir, ["customer_governorate"], ["distinct_merchants", "active_accounts", "transaction_count"],
                       with_location=True)


@register("geo_drilldown")
def q_geo_drilldown(spark, sf_dir):
    """Governorate, city and grand total, non-additive measures included."""
    return _by_account(spark, sf_dir, ["customer_governorate", "customer_city"],
                       ["transaction_count", "gross_volume", "average_ticket", "active_accounts", "distinct_merchants",
                        "avg_txn_per_account_ppm"], with_location=True, totals="rollup")


@register("category_size_cube")
def q_category_size_cube(spark, sf_dir):
    return _by_merchant(spark, sf_dir, ["merchant_category", "merchant_size"],
                        ["distinct_merchants", "active_accounts", "decline_rate_ppm"], totals="cube")


# -- filter context (A13, M28, M29) ------------------------------------------------
@register("share_in_context")
def q_share_in_context(spark, sf_dir):
    """Each visible category's share of all categories, under a date and a
    category slicer; all-dates volume of the same category."""
    t = star_tables(spark, sf_dir)
    f = t["fact_transactions"].select("date_key", "merchant_key", "abs_amount_egp")
    df = ST.join_dim(f, t["dim_merchant"], "merchant_key", "merchant_key", ["merchant_category"], "left", ST.BLANK)
    context = {"date": CX.Filter(F.col("date_key").between(19950101, 19961231)),
               "merchant": CX.Filter(F.col("merchant_category").isin("CAT_0", "CAT_3", "CAT_5"), ("merchant_category",))}
    out = CX.in_context(df, context, {
        "gross_volume": CX.Variant("gross_volume"),
        "volume_all_categories": CX.Variant("gross_volume", ("merchant",)),
        "volume_all_dates": CX.Variant("gross_volume", ("date",)),
        "volume_overall": CX.Variant("gross_volume", ("date", "merchant")),
        "average_ticket": CX.Variant("average_ticket")}, by=["merchant_category"])
    return out.withColumn("volume_share_ppm", X.money_ratio_ppm("gross_volume", "volume_all_categories"))


# -- access paths (P10, P11) ---------------------------------------------------
@register("declined_only")
def q_declined_only(spark, sf_dir):
    f = star_tables(spark, sf_dir)["fact_transactions"]
    return f.where(F.col("is_declined") == 1).select("transaction_id", "date_key", "abs_amount_egp",
                                                      "decline_reason_key")


@register("fx_only")
def q_fx_only(spark, sf_dir):
    f = star_tables(spark, sf_dir)["fact_transactions"]
    return f.where(F.col("is_fx") == 1).select("transaction_id", "exchange_rate_e6", "fx_amount_minor")


@register("date_range_lookup")
def q_date_range_lookup(spark, sf_dir):
    f = star_tables(spark, sf_dir)["fact_transactions"]
    return f.where(F.col("date_key").between(19970101, 19970131)).select(
        "transaction_id", "date_key", "amount_egp", "is_declined", "is_fx")


@register("account_activity")
def q_account_activity(spark, sf_dir):
    f = star_tables(spark, sf_dir)["fact_transactions"]
    return f.where(F.col("account_key") == 7).select("transaction_id", "date_key", "abs_amount_egp", "is_declined")


@register("surrogate_keys")
def q_surrogate_keys(spark, sf_dir):
    return star_tables(spark, sf_dir)["fact_transactions"].select("transaction_id", "transaction_sk")
