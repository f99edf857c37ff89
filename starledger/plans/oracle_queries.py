"""Oracle SQL per catalog key (DuckDB dialect), built on the adapter CTEs."""

from __future__ import annotations

from ..contracts import TIME_BUCKETS
from ..operators.measures import CORE_KPIS
from .oracle import (STAR_SQL, avg_money_sql, measures_sql, money_ppm_sql, ppm_sql, signed_ppm_sql, star_query,
                     with_adapter)

ORACLE: dict[str, str] = {}


def _grouped(by: str, measures: list[str], where: str = "", tail: str = "") -> str:
    w = f"WHERE {where}" if where else ""
    return star_query(f"SELECT {by}, {measures_sql(measures)} FROM star {w} GROUP BY {by} {tail}")


def _global(measures: list[str], where: str = "") -> str:
    w = f"WHERE {where}" if where else ""
    return star_query(f"SELECT {measures_sql(measures)} FROM star {w}")


# -- reporting views -----------------------------------------------------------
ORACLE["rpt_daily"] = with_adapter(f"""
SELECT d.full_date, d.year, d.month, d.is_weekend,
       count(*) AS txn_count,
       CAST(sum(f.is_declined) AS BIGINT) AS declined_count,
       CAST(sum(f.is_fx) AS BIGINT) AS fx_count,
       CAST(sum(f.abs_amount_egp) AS DECIMAL(18,2)) AS gross_volume_egp,
       {avg_money_sql('sum(f.abs_amount_egp)', 'count(*)')} AS avg_ticket_egp
FROM fact_transactions f JOIN dim_date d ON d.date_key = f.date_key
GROUP BY d.full_date, d.year, d.month, d.is_weekend""")

ORACLE["rpt_health"] = with_adapter("""
SELECT count(*) AS total_transactions,
       count(DISTINCT transaction_id) AS distinct_transaction_ids,
       CAST(sum(is_outbound) AS BIGINT) AS outbound_count,
       CAST(sum(is_declined) AS BIGINT) AS declined_count,
       CAST(sum(is_fx) AS BIGINT) AS fx_count,
       min(date_key) AS min_date_key, max(date_key) AS max_date_key,
       CAST(sum(abs_amount_egp) AS DECIMAL(20,2)) AS gross_volume_egp
FROM fact_transactions""")

ORACLE["gold_summary"] = with_adapter(f"""
SELECT count(*) AS fact_rows,
       CAST({avg_money_sql('sum(abs_amount_egp)', 'count(*)')} AS DECIMAL(10,2)) AS avg_ticket_egp
FROM fact_transactions""")

# -- measures ------------------------------------------------------------------
ORACLE["measures_total"] = _global(CORE_KPIS)
ORACLE["measures_by_group"] = _grouped("transaction_group", ["transaction_count", "average_ticket",
                                                             "decline_rate_ppm", "fx_share_ppm"])
ORACLE["avg_fx_rate"] = _grouped("year, month", ["avg_exchange_rate", "fx_transactions"])
ORACLE["weekend_split"] = _global(["weekend_volume", "weekday_volume"])
ORACLE["daytime_count"] = _global(["daytime_transactions", "transaction_count"])
ORACLE["total_surcharge"] = _grouped("year", ["total_surcharge"])
ORACLE["high_value_accounts"] = with_adapter("""
SELECT count(*) AS high_value_accounts FROM (
  SELECT account_key, sum(abs_amount_egp) AS v FROM fact_transactions GROUP BY account_key) WHERE v > 100000""")
ORACLE["volume_band"] = star_query(f"""
, g AS (SELECT merchant_size, {measures_sql(['average_ticket'])} FROM star GROUP BY merchant_size)
SELECT merchant_size, average_ticket,
       CASE WHEN average_ticket IS NULL THEN NULL WHEN average_ticket < 100 THEN '< 100 EGP'
            WHEN average_ticket < 1000 THEN '100–1000 EGP' ELSE '> 1000 EGP' END AS volume_band
FROM g""")
ORACLE["selected_value"] = star_query("""
SELECT transaction_group,
       CASE WHEN count(DISTINCT transaction_type_name) = 1 THEN max(transaction_type_name) ELSE 'All Types' END
         AS selected_type
FROM star GROUP BY transaction_group""")
ORACLE["category_share"] = star_query(f"""
, g AS (SELECT merchant_category, {measures_sql(['gross_volume'])} FROM star GROUP BY merchant_category),
t AS (SELECT *, CAST(sum(gross_volume) OVER () AS DECIMAL(38,2)) AS total_volume FROM g)
SELECT merchant_category, gross_volume, total_volume,
       {money_ppm_sql('gross_volume', 'total_volume')} AS volume_share_ppm FROM t""")
ORACLE["all_dates_share"] = star_query(f"""
, g AS (SELECT year, {measures_sql(['gross_volume'])} FROM star GROUP BY year),
t AS (SELECT *, CAST(sum(gross_volume) OVER () AS DECIMAL(38,2)) AS total_volume_all_dates FROM g)
SELECT year, gross_volume, total_volume_all_dates,
       {money_ppm_sql('gross_volume', 'total_volume_all_dates')} AS share_ppm FROM t""")

# -- report pages --------------------------------------------------------------
ORACLE["mix_by_group"] = _grouped("transaction_group", ["transaction_count", "gross_volume"])
ORACLE["account_status_mix"] = with_adapter(
    "SELECT account_status, count(*) AS accounts FROM dim_account GROUP BY account_status")
ORACLE["category_size"] = _grouped("merchant_category, merchant_size", ["gross_volume", "transaction_count"])
ORACLE["city_drill"] = _grouped("customer_governorate, customer_city", ["gross_volume", "transaction_count"])
ORACLE["count_by_channel"] = _grouped("acquisition_channel", ["transaction_count"])
ORACLE["customer_geo"] = _grouped("customer_governorate", ["gross_volume", "active_accounts"])
ORACLE["merchant_geo"] = _grouped("merchant_governorate", ["gross_volume", "distinct_merchants"])
ORACLE["decline_by_category"] = _grouped("merchant_category", ["decline_rate_ppm", "declined_transactions",
                                                               "gross_volume"])
ORACLE["decline_rate_by_month"] = _grouped("year, month", ["decline_rate_ppm", "declined_transactions",
                                                           "transaction_count"])
ORACLE["declines_by_reason"] = _grouped("decline_reason_name", ["declined_transactions", "declined_volume"],
                                        "is_declined = 1")
ORACLE["direction_by_group"] = _grouped("transaction_group", ["outbound_volume", "inbound_volume"])
ORACLE["engagement_by_tier"] = _grouped("customer_tier", ["active_accounts", "transaction_count",
                                                          "avg_txn_per_account_ppm"])
ORACLE["fx_by_category"] = _grouped("merchant_category", ["fx_transactions", "fx_volume"])
ORACLE["fx_by_month"] = _grouped("year, month", ["fx_volume", "fx_transactions", "fx_share_ppm"])
ORACLE["heatmap"] = star_query("""
SELECT time_bucket, count(*) FILTER (WHERE is_weekend = 0) AS weekday_count,
       count(*) FILTER (WHERE is_weekend = 1) AS weekend_count
FROM star GROUP BY time_bucket""")
ORACLE["heatmap_volume"] = star_query("""
SELECT time_bucket,
       CAST(coalesce(sum(abs_amount_egp) FILTER (WHERE is_weekend = 0), 0) AS DECIMAL(38,2)) AS weekday_volume,
       CAST(coalesce(sum(abs_amount_egp) FILTER (WHERE is_weekend = 1), 0) AS DECIMAL(38,2)) AS weekend_volume
FROM star GROUP BY time_bucket""")
ORACLE["volume_by_age_band"] = _grouped("age_band", ["gross_volume", "transaction_count", "average_ticket"])
ORACLE["count_by_merchant_category"] = _grouped("merchant_category", ["transaction_count", "decline_rate_ppm"])
ORACLE["governorate_concentration"] = star_query(f"""
SELECT count(*) AS active_governorates, arg_min(customer_governorate, place) AS top_governorate,
       CAST(max(v) AS DECIMAL(38,2)) AS top_volume, {money_ppm_sql('max(v)', 'sum(v)')} AS top_share_ppm
FROM (SELECT *, row_number() OVER (ORDER BY v DESC, customer_governorate) AS place
      FROM (SELECT customer_governorate, sum(abs_amount_egp) AS v FROM star GROUP BY customer_governorate))""")
ORACLE["fx_by_group"] = _grouped("transaction_group", ["fx_transactions", "fx_volume", "fx_share_ppm"])
ORACLE["fx_split"] = _grouped("is_fx", ["transaction_count", "gross_volume", "average_ticket", "decline_rate_ppm"])
_tier_cols = ", ".join(
    ppm_sql(f"count(*) FILTER (WHERE is_declined = 1 AND time_bucket = '{b}')",
            f"count(*) FILTER (WHERE time_bucket = '{b}')") + f" AS {b.lower()}_decline_ppm"
    for b in TIME_BUCKETS)
ORACLE["tier_time_decline"] = star_query(f"SELECT customer_tier, {_tier_cols} FROM star GROUP BY customer_tier")
ORACLE["type_by_declined"] = _grouped("transaction_type_name, is_declined", ["transaction_count"])
ORACLE["volume_by_category"] = _grouped("merchant_category", ["gross_volume"])
ORACLE["volume_by_governorate"] = _grouped("customer_governorate", ["gross_volume"])
ORACLE["volume_by_tier"] = _grouped("customer_tier", ["gross_volume", "transaction_count"])
ORACLE["size_by_month"] = _grouped("year, month, merchant_size", ["gross_volume"])
ORACLE["top20_merchants"] = _grouped("merchant_key, merchant_name", ["gross_volume"], "merchant_key IS NOT NULL",
                                     "ORDER BY gross_volume DESC, merchant_key LIMIT 20")
ORACLE["top10_merchants"] = _grouped("merchant_key, merchant_name, merchant_category",
                                     ["gross_volume", "transaction_count", "average_ticket", "decline_rate_ppm"],
                                     "merchant_key IS NOT NULL", "ORDER BY gross_volume DESC, merchant_key LIMIT 10")
ORACLE["top_p2p"] = _grouped("account_key", ["p2p_transactions", "gross_volume"], "peer_account_key IS NOT NULL",
                             "ORDER BY p2p_transactions DESC, account_key LIMIT 10")
ORACLE["p2p_by_month"] = _grouped("year, month", ["p2p_transactions", "gross_volume"], "peer_account_key IS NOT NULL")
ORACLE["p2p_by_tier"] = star_query("""
SELECT peer_customer_tier, CAST(sum(abs_amount_egp) AS DECIMAL(38,2)) AS p2p_volume_to_peer
FROM star GROUP BY peer_customer_tier""")
ORACLE["hour_profile"] = _grouped("hour_of_day", ["transaction_count", "gross_volume"])
ORACLE["volume_by_week"] = star_query(f"""
SELECT CAST(date_trunc('week', full_date) AS DATE) AS week_start, {measures_sql(['gross_volume', 'transaction_count'])}
FROM star GROUP BY 1""")
ORACLE["fx_rate_distribution"] = _grouped("exchange_rate_e6", ["fx_transactions", "fx_volume"], "is_fx = 1")
ORACLE["slicer_query"] = _grouped(
    "customer_governorate", ["gross_volume", "transaction_count"],
    "full_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND customer_tier IN ('Premium', 'Business') "
    "AND transaction_group IN ('Payment')")
ORACLE["type_rollup"] = star_query(f"""
SELECT transaction_group, transaction_type_name,
       CAST(GROUPING(transaction_group, transaction_type_name) AS INTEGER) AS grouping_level,
       {measures_sql(['transaction_count', 'gross_volume', 'average_ticket'])}
FROM star GROUP BY ROLLUP (transaction_group, transaction_type_name)""")
ORACLE["detail_table"] = star_query("""
SELECT transaction_id AS "Transaction ID", full_date AS "Date", hour_label AS "Time", account_id AS "Account",
       merchant_name AS "Merchant", transaction_type_name AS "Type", amount_egp AS "Amount (EGP)",
       is_declined AS "Declined", decline_reason_name AS "Decline Reason", customer_city AS "City"
FROM star WHERE merchant_category = 'CAT_3' AND year = 1997""")
ORACLE["related_governorate"] = star_query("SELECT transaction_id, customer_governorate FROM star")
ORACLE["txn_count_per_account"] = with_adapter("""
SELECT a.account_key, count(f.account_key) AS transaction_count
FROM dim_account a LEFT JOIN fact_transactions f ON f.account_key = a.account_key GROUP BY a.account_key""")
ORACLE["inactive_accounts"] = with_adapter("""
SELECT a.account_key, a.account_id FROM dim_account a
WHERE NOT EXISTS (SELECT 1 FROM fact_transactions f
                  WHERE f.account_key = a.account_key)""")
ORACLE["merchants_blank"] = _grouped("merchant_name", ["transaction_count"])
ORACLE["signups_by_month"] = with_adapter("""
SELECT d.year AS signup_year, d.month AS signup_month, count(*) AS signups
FROM dim_account a JOIN dim_date d ON d.date_key = a.signup_date_key GROUP BY 1, 2""")
ORACLE["merchants_opened_by_month"] = with_adapter("""
SELECT d.year AS opened_year, d.month AS opened_month, count(*) AS merchants_opened
FROM dim_merchant m JOIN dim_date d ON d.date_key = m.opened_date_key GROUP BY 1, 2""")
ORACLE["month_labels"] = with_adapter("""
SELECT year, month, strftime(min(full_date), '%B') AS month_name, strftime(min(full_date), '%b %Y') AS month_label
FROM dim_date GROUP BY year, month""")

# -- time intelligence ---------------------------------------------------------
_DAILY = """
, v AS (SELECT date_key, CAST(sum(abs_amount_egp) AS DECIMAL(38,2)) AS volume FROM fact_transactions GROUP BY 1),
daily AS (SELECT d.date_key, d.full_date, d.year, d.quarter, d.month, v.volume
          FROM dim_date d LEFT JOIN v ON v.date_key = d.date_key)"""


def _td(parts: str, out: str) -> str:
    return with_adapter(f"daily_base AS (SELECT 1){_DAILY}", f"""
SELECT full_date, volume,
       CAST(coalesce(sum(volume) OVER (PARTITION BY {parts} ORDER BY full_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS DECIMAL(38,2)) AS {out}
FROM daily""")


ORACLE["volume_ytd"] = _td("year", "volume_ytd")
ORACLE["volume_qtd"] = _td("year, quarter", "volume_qtd")
ORACLE["volume_mtd"] = _td("year, month", "volume_mtd")
_MONTHLY = """monthly_base AS (SELECT 1)
, months AS (SELECT year, month, min(full_date) AS month_start FROM dim_date GROUP BY 1, 2),
mv AS (SELECT d.year, d.month, CAST(sum(f.abs_amount_egp) AS DECIMAL(38,2)) AS volume
       FROM fact_transactions f JOIN dim_date d ON d.date_key = f.date_key GROUP BY 1, 2),
monthly AS (SELECT m.year, m.month, mv.volume, year(m.month_start) * 12 + month(m.month_start) - 1 AS month_index
            FROM months m LEFT JOIN mv ON mv.year = m.year AND mv.month = m.month),
shifted AS (SELECT c.year, c.month, c.volume, p.volume AS volume_last_month
            FROM monthly c LEFT JOIN monthly p ON p.month_index = c.month_index - 1)"""
ORACLE["volume_last_month"] = with_adapter(_MONTHLY, "SELECT year, month, volume, volume_last_month FROM shifted")
ORACLE["mom_growth"] = with_adapter(_MONTHLY, f"""
SELECT year, month, volume, volume_last_month,
       {signed_ppm_sql('CAST((coalesce(volume, 0) - volume_last_month) * 100 AS HUGEINT)',
                       'CAST(volume_last_month * 100 AS HUGEINT)')} AS mom_growth_ppm
FROM shifted""")
ORACLE["same_day_last_month"] = with_adapter(f"daily_base AS (SELECT 1){_DAILY}", """
SELECT c.full_date, c.volume, p.volume AS volume_same_day_last_month
FROM daily c LEFT JOIN daily p ON p.full_date = CAST(c.full_date - INTERVAL 1 MONTH AS DATE)""")

# -- access paths --------------------------------------------------------------
ORACLE["declined_only"] = with_adapter(
    "SELECT transaction_id, date_key, abs_amount_egp, decline_reason_key FROM fact_transactions WHERE is_declined = 1")
ORACLE["fx_only"] = with_adapter(
    "SELECT transaction_id, exchange_rate_e6, fx_amount_minor FROM fact_transactions WHERE is_fx = 1")
ORACLE["date_range_lookup"] = with_adapter(
    "SELECT transaction_id, date_key, amount_egp, is_declined, is_fx FROM fact_transactions "
    "WHERE date_key BETWEEN 19970101 AND 19970131")
ORACLE["account_activity"] = with_adapter(
    "SELECT transaction_id, date_key, abs_amount_egp, is_declined FROM fact_transactions WHERE account_key = 7")
ORACLE["surrogate_keys"] = with_adapter(
    "SELECT transaction_id, CAST(row_number() OVER (ORDER BY transaction_id) AS BIGINT) AS transaction_sk "
    "FROM fact_transactions")


# -- time intelligence per member --------------------------------------------------
def _member_days(attr: str, where: str = "TRUE") -> str:
    return f"""
pd AS (SELECT {attr}, full_date, sum(abs_amount_egp) AS v FROM star WHERE {where} GROUP BY ALL),
md AS (SELECT s.{attr}, d.full_date, d.year, d.quarter, d.month, CAST(p.v AS DECIMAL(38,2)) AS volume
       FROM (SELECT {attr}, min(full_date) AS a, max(full_date) AS z FROM pd GROUP BY 1) s
       JOIN dim_date d ON d.full_date BETWEEN s.a AND s.z
       LEFT JOIN pd p ON p.{attr} = s.{attr} AND p.full_date = d.full_date)"""


def _to_date_by(attr: str, where: str = "TRUE") -> str:
    runs = ", ".join(
        f"CAST(coalesce(sum(volume) OVER (PARTITION BY {attr}, {part} ORDER BY full_date), 0) AS DECIMAL(38,2)) AS volume_{n}td"
        for n, part in (("y", "year"), ("q", "year, quarter"), ("m", "year, month")))
    return with_adapter(f"{STAR_SQL}, {_member_days(attr, where)}", f"SELECT {attr}, full_date, volume, {runs} FROM md")


def _growth_by(attr: str, where: str = "TRUE") -> str:
    return with_adapter(f"""{STAR_SQL}, {_member_days(attr, where)},
mm AS (SELECT {attr}, year, month, CAST(sum(volume) AS DECIMAL(38,2)) AS volume FROM md GROUP BY ALL),
mp AS (SELECT c.*, p.volume AS volume_last_month FROM mm c LEFT JOIN mm p
       ON p.{attr} = c.{attr} AND p.year * 12 + p.month = c.year * 12 + c.month - 1)""", f"""
SELECT {attr}, year, month, volume, volume_last_month,
       {signed_ppm_sql('CAST((coalesce(volume, 0) - volume_last_month) * 100 AS HUGEINT)', 'CAST(volume_last_month * 100 AS HUGEINT)')}
         AS mom_growth_ppm FROM mp""")


ORACLE["to_date_by_tier"] = _to_date_by("customer_tier")
ORACLE["to_date_by_governorate"] = _to_date_by("customer_governorate", "is_declined = 1")
ORACLE["growth_by_tier"] = _growth_by("customer_tier", "is_fx = 1")
ORACLE["growth_by_governorate"] = _growth_by("customer_governorate")
ORACLE["same_day_by_tier"] = with_adapter(f"{STAR_SQL}, {_member_days('customer_tier')}", """
SELECT c.customer_tier, c.full_date, c.volume, p.volume AS volume_same_day_last_month
FROM md c LEFT JOIN md p ON p.customer_tier = c.customer_tier AND p.full_date = CAST(c.full_date - INTERVAL 1 MONTH AS DATE)""")

# -- distinct counts that merge, totals from partials ----------------------------------
ORACLE["merchants_by_governorate"] = _grouped("customer_governorate", ["distinct_merchants", "active_accounts",
                                                                        "transaction_count"])
_DRILL = ["transaction_count", "gross_volume", "average_ticket", "active_accounts", "distinct_merchants",
          "avg_txn_per_account_ppm"]
ORACLE["geo_drilldown"] = star_query(f"""
SELECT customer_governorate, customer_city, CAST(grouping(customer_governorate, customer_city) AS INTEGER) AS grouping_level,
       {measures_sql(_DRILL)} FROM star GROUP BY ROLLUP (customer_governorate, customer_city)""")
ORACLE["category_size_cube"] = star_query(f"""
SELECT merchant_category, merchant_size, CAST(grouping(merchant_category, merchant_size) AS INTEGER) AS grouping_level,
       {measures_sql(["distinct_merchants", "active_accounts", "decline_rate_ppm"])}
FROM star GROUP BY CUBE (merchant_category, merchant_size)""")

# -- filter context ----------------------------------------------------------------------
ORACLE["share_in_context"] = star_query(f"""
SELECT merchant_category, gross_volume, volume_all_categories, volume_all_dates, volume_overall, average_ticket,
       {money_ppm_sql('gross_volume', 'volume_all_categories')} AS volume_share_ppm
FROM (SELECT merchant_category, {measures_sql(["gross_volume", "average_ticket"])},
             (SELECT CAST(sum(abs_amount_egp) AS DECIMAL(38,2)) FROM star WHERE date_key BETWEEN 19950101 AND 19961231)
               AS volume_all_categories,
             (SELECT CAST(sum(abs_amount_egp) AS DECIMAL(38,2)) FROM star) AS volume_overall
      FROM star WHERE date_key BETWEEN 19950101 AND 19961231 AND merchant_category IN ('CAT_0', 'CAT_3', 'CAT_5')
      GROUP BY merchant_category)
JOIN (SELECT merchant_category AS c, CAST(sum(abs_amount_egp) AS DECIMAL(38,2)) AS volume_all_dates FROM star GROUP BY 1)
  ON c = merchant_category""")
