"""DuckDB oracle SQL for the query catalog.

``ADAPTER_CTES`` states the fixture mapping (plans/adapter.py) in plain SQL
over the driver views; each oracle query is ``WITH <adapter>, <query>``.  The
Spark side never runs this text: it is the independent check.
"""

from __future__ import annotations

from ..contracts import AGE_BANDS, DECLINE_REASONS
from .adapter import FX_RATES_E6

_FACT_COLS = ("date_key, time_key, account_key, peer_account_key, transaction_type_key, decline_reason_key, "
              "merchant_key, transaction_id, mc_transaction_id, ach_transfer_id, amount_minor, amount_egp, "
              "abs_amount_egp, fx_amount_minor, exchange_rate_e6, is_outbound, is_declined, is_fx")

_age_case = " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(AGE_BANDS))
_rate_case = " ".join(f"WHEN {i} THEN {r}" for i, r in enumerate(FX_RATES_E6[:-1])) + f" ELSE {FX_RATES_E6[-1]}"
_reasons = ", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(DECLINE_REASONS))

ADAPTER_CTES = f"""
raw_join AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         l.l_discount, l.l_returnflag, l.l_linestatus, o.o_custkey, o.o_orderdate, o.o_orderpriority
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
raw_base AS (
  SELECT *,
    CAST(l_linestatus = 'O' AS INTEGER) AS _outbound,
    CAST(l_returnflag = 'R' AS INTEGER) AS _declined,
    CAST(l_discount > 0.085 AS INTEGER) AS _fx,
    (l_returnflag = 'N' AND l_linestatus = 'F') AS _peer,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS _abs,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS _type
  FROM raw_join),
raw_txn AS (
  SELECT
    CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_key,
    CAST((l_partkey % 24) * 100 + (l_suppkey % 60) AS INTEGER) AS time_key,
    CAST(o_custkey AS INTEGER) AS account_key,
    CAST(CASE WHEN _peer THEN l_suppkey END AS INTEGER) AS peer_account_key,
    _type AS transaction_type_key,
    CAST(CASE WHEN _declined = 1 THEN l_partkey % 8 + 1 END AS INTEGER) AS decline_reason_key,
    CAST(CASE WHEN NOT _peer THEN l_suppkey END AS INTEGER) AS merchant_key,
    'TXN' || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), greatest(length(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)), 10)::INTEGER, '0') AS transaction_id,
    CASE WHEN _type <= 3 THEN 'MC' || lpad(CAST(l_partkey AS VARCHAR), greatest(length(CAST(l_partkey AS VARCHAR)), 12)::INTEGER, '0') END AS mc_transaction_id,
    CASE WHEN _type = 5 THEN 'ACH' || lpad(CAST(l_partkey AS VARCHAR), greatest(length(CAST(l_partkey AS VARCHAR)), 10)::INTEGER, '0') END AS ach_transfer_id,
    CAST(CAST(CASE WHEN _outbound = 1 THEN -_abs ELSE _abs END AS DECIMAL(18,2)) * 100 AS BIGINT) AS amount_minor,
    CAST(CASE WHEN _outbound = 1 THEN -_abs ELSE _abs END AS DECIMAL(18,2)) AS amount_egp,
    _abs AS abs_amount_egp,
    CASE WHEN _fx = 1 THEN (2 * CAST(_abs * 100 AS BIGINT) * 1000000
                            + CAST(CASE l_linenumber % 4 {_rate_case} END AS BIGINT))
                           // (2 * CAST(CASE l_linenumber % 4 {_rate_case} END AS BIGINT)) END AS fx_amount_minor,
    CASE WHEN _fx = 1 THEN CAST(CASE l_linenumber % 4 {_rate_case} END AS BIGINT) END AS exchange_rate_e6,
    _outbound AS is_outbound, _declined AS is_declined, _fx AS is_fx,
    'transactions_raw' AS _kafka_topic,
    CAST(l_orderkey % 3 AS INTEGER) AS _kafka_partition,
    CAST(l_partkey * 100000 + l_suppkey AS BIGINT) AS _kafka_offset,
    l_quantity AS _l_quantity
  FROM raw_base),
txn AS (
  SELECT * EXCLUDE (_rn, _l_quantity) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _kafka_offset, date_key, time_key, account_key, peer_account_key NULLS FIRST, transaction_type_key, decline_reason_key NULLS FIRST, merchant_key NULLS FIRST, mc_transaction_id NULLS FIRST, ach_transfer_id NULLS FIRST, amount_minor, amount_egp, abs_amount_egp, fx_amount_minor NULLS FIRST, exchange_rate_e6 NULLS FIRST, is_outbound, is_declined, is_fx, _kafka_topic, _kafka_partition) AS _rn
    FROM raw_txn)
  WHERE _rn = 1),
fact_transactions AS (SELECT {_FACT_COLS} FROM txn),
dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
         CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
         CAST(CASE WHEN dayofweek(d) IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d
        FROM orders)),
dim_time AS (
  SELECT CAST(h * 100 + m AS INTEGER) AS time_key, CAST(h AS INTEGER) AS hour_of_day,
         CASE WHEN h BETWEEN 5 AND 11 THEN 'Morning' WHEN h BETWEEN 12 AND 16 THEN 'Afternoon'
              WHEN h BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END AS time_bucket,
         CAST(CASE WHEN h BETWEEN 6 AND 18 THEN 1 ELSE 0 END AS INTEGER) AS is_daytime,
         lpad(CAST((h + 11) % 12 + 1 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0')
           || CASE WHEN h < 12 THEN ' AM' ELSE ' PM' END AS hour_label
  FROM (SELECT i // 60 AS h, i % 60 AS m FROM range(1440) t(i))),
dim_location AS (
  SELECT CAST(n_nationkey AS INTEGER) AS location_key, n_name AS city, r_name AS governorate, 'X' AS country
  FROM nation JOIN region ON n_regionkey = r_regionkey),
dim_account AS (
  SELECT CAST(c_custkey AS INTEGER) AS account_key, 'ACC' || lpad(CAST(c_custkey AS VARCHAR), greatest(length(CAST(c_custkey AS VARCHAR)), 8)::INTEGER, '0') AS account_id,
         CAST(c_nationkey AS INTEGER) AS location_key, 'EGP' AS currency,
         CASE c_custkey % 6 {_age_case} END AS age_band, c_mktsegment AS acquisition_channel,
         coalesce(fo.signup_date_key, (SELECT min(CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)) FROM orders)) AS signup_date_key,
         CASE WHEN c_acctbal >= 9000 THEN 'Business' WHEN c_acctbal >= 7000 THEN 'Premium' ELSE 'Standard' END
           AS customer_tier,
         CASE WHEN c_acctbal < 0 THEN 'Dormant' ELSE 'Active' END AS account_status
  FROM customer LEFT JOIN (
    SELECT CAST(o_custkey AS INTEGER) AS ak,
           min(CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER))
             AS signup_date_key
    FROM orders GROUP BY 1) fo ON fo.ak = CAST(c_custkey AS INTEGER)),
dim_merchant AS (
  SELECT CAST(s_suppkey AS INTEGER) AS merchant_key, CAST(s_nationkey AS INTEGER) AS location_key,
         'MER' || lpad(CAST(s_suppkey AS VARCHAR), greatest(length(CAST(s_suppkey AS VARCHAR)), 6)::INTEGER, '0') AS merchant_id, s_name AS merchant_name,
         'CAT_' || CAST(s_suppkey % 8 AS VARCHAR) AS merchant_category,
         CASE WHEN s_acctbal >= 9000 THEN 'Enterprise' WHEN s_acctbal >= 5000 THEN 'Mid-Market' ELSE 'SME' END
           AS merchant_size,
         coalesce(fs.opened_date_key, (SELECT min(CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)) FROM orders)) AS opened_date_key
  FROM supplier LEFT JOIN (
    SELECT CAST(l_suppkey AS INTEGER) AS mk,
           min(CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER))
             AS opened_date_key
    FROM raw_join GROUP BY 1) fs ON fs.mk = CAST(s_suppkey AS INTEGER)),
dim_transaction_type AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS transaction_type_key,
         substr(o_orderpriority, instr(o_orderpriority, '-') + 1) AS transaction_type_name,
         CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2 THEN 'Payment'
              WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 4 THEN 'Transfer' ELSE 'Deposit' END
           AS transaction_group
  FROM orders),
dim_decline_reason AS (
  SELECT CAST(k AS INTEGER) AS decline_reason_key, n AS decline_reason_name
  FROM (VALUES {_reasons}) v(k, n))
"""


def with_adapter(query_ctes: str, final: str | None = None) -> str:
    """``WITH <adapter>, <query_ctes> <final>``; ``final`` may be omitted when
    ``query_ctes`` is a bare SELECT."""
    if final is None:
        return f"WITH {ADAPTER_CTES}\n{query_ctes}"
    return f"WITH {ADAPTER_CTES},\n{query_ctes}\n{final}"


# Integer half-up helpers stated once for the oracle text.
def avg_money_sql(sum_expr: str, n_expr: str) -> str:
    return (f"CAST(((2 * CAST(({sum_expr}) * 100 AS HUGEINT) + ({n_expr})) // (2 * ({n_expr}))) * 0.01 "
            f"AS DECIMAL(18,2))")


def ppm_sql(num: str, den: str) -> str:
    """half-up ppm of two non-negative integer expressions, NULL on zero."""
    return (f"CASE WHEN ({den}) <> 0 THEN CAST((2 * CAST({num} AS HUGEINT) * 1000000 + ({den})) "
            f"// (2 * ({den})) AS BIGINT) END")


def money_ppm_sql(num: str, den: str) -> str:
    return ppm_sql(f"CAST(({num}) * 100 AS HUGEINT)", f"CAST(({den}) * 100 AS HUGEINT)")


def signed_ppm_sql(num: str, den: str) -> str:
    """half-up ppm for a signed integer numerator and positive denominator."""
    return (f"CASE WHEN ({den}) <> 0 THEN CAST(sign({num}) * ((2 * abs(CAST({num} AS HUGEINT)) * 1000000 + ({den})) "
            f"// (2 * ({den}))) AS BIGINT) END")


# Measure SQL: same names and exact semantics as operators/measures.py.
_N = "count(*)"
_DECL = "count(*) FILTER (WHERE is_declined = 1)"
_FX = "count(*) FILTER (WHERE is_fx = 1)"
MEASURE_SQL = {
    "transaction_count": _N,
    "gross_volume": "CAST(sum(abs_amount_egp) AS DECIMAL(38,2))",
    "net_flow": "CAST(sum(amount_egp) AS DECIMAL(38,2))",
    "average_ticket": avg_money_sql("sum(abs_amount_egp)", _N),
    "declined_transactions": _DECL,
    "approved_transactions": f"{_N} - {_DECL}",
    "decline_rate_ppm": ppm_sql(_DECL, _N),
    "fx_transactions": _FX,
    "fx_share_ppm": ppm_sql(_FX, _N),
    "fx_volume": "CAST(sum(CASE WHEN is_fx = 1 THEN abs_amount_egp END) AS DECIMAL(38,2))",
    "avg_exchange_rate": ("CAST(CASE WHEN count(CASE WHEN is_fx = 1 THEN exchange_rate_e6 END) > 0 THEN "
                          "((2 * sum(CASE WHEN is_fx = 1 THEN exchange_rate_e6 END) "
                          "+ count(CASE WHEN is_fx = 1 THEN exchange_rate_e6 END)) "
                          "// (2 * count(CASE WHEN is_fx = 1 THEN exchange_rate_e6 END))) * 0.000001 END "
                          "AS DECIMAL(24,6))"),
    "outbound_volume": "CAST(sum(CASE WHEN is_outbound = 1 THEN abs_amount_egp END) AS DECIMAL(38,2))",
    "inbound_volume": "CAST(sum(CASE WHEN is_outbound = 0 THEN abs_amount_egp END) AS DECIMAL(38,2))",
    "active_accounts": "count(DISTINCT account_key)",
    "distinct_merchants": "count(DISTINCT merchant_key)",
    "avg_txn_per_account_ppm": ppm_sql(_N, "count(DISTINCT account_key)"),
    "weekend_volume": "CAST(sum(CASE WHEN is_weekend = 1 THEN abs_amount_egp END) AS DECIMAL(38,2))",
    "weekday_volume": "CAST(sum(CASE WHEN is_weekend = 0 THEN abs_amount_egp END) AS DECIMAL(38,2))",
    "daytime_transactions": "count(*) FILTER (WHERE is_daytime = 1)",
    "declined_volume": "CAST(sum(CASE WHEN is_declined = 1 THEN abs_amount_egp END) AS DECIMAL(38,2))",
    "total_surcharge": "CAST(sum(abs_amount_egp * CAST(0.005 AS DECIMAL(4,3))) AS DECIMAL(38,5))",
    "p2p_transactions": "count(peer_account_key)",
}


def measures_sql(names) -> str:
    return ", ".join(f"{MEASURE_SQL[n]} AS {n}" for n in names)


# The joined star (all roles) for oracle queries; nullable roles show (Blank).
STAR_SQL = """
star AS (
  SELECT f.*, d.full_date, d.day, d.month, d.quarter, d.year, d.is_weekend,
         t.hour_of_day, t.time_bucket, t.is_daytime, t.hour_label,
         a.account_id, a.age_band, a.acquisition_channel, a.customer_tier, a.account_status,
         a.signup_date_key, a.location_key AS customer_location_key,
         cl.city AS customer_city, cl.governorate AS customer_governorate,
         coalesce(pa.customer_tier, '(Blank)') AS peer_customer_tier,
         coalesce(pa.account_id, '(Blank)') AS peer_account_id,
         tt.transaction_type_name, tt.transaction_group,
         coalesce(dr.decline_reason_name, '(Blank)') AS decline_reason_name,
         coalesce(m.merchant_id, '(Blank)') AS merchant_id, coalesce(m.merchant_name, '(Blank)') AS merchant_name,
         coalesce(m.merchant_category, '(Blank)') AS merchant_category,
         coalesce(m.merchant_size, '(Blank)') AS merchant_size, m.opened_date_key,
         m.location_key AS merchant_location_key,
         coalesce(ml.city, '(Blank)') AS merchant_city, coalesce(ml.governorate, '(Blank)') AS merchant_governorate
  FROM fact_transactions f
  JOIN dim_date d ON d.date_key = f.date_key
  JOIN dim_time t ON t.time_key = f.time_key
  JOIN dim_account a ON a.account_key = f.account_key
  JOIN dim_location cl ON cl.location_key = a.location_key
  LEFT JOIN dim_account pa ON pa.account_key = f.peer_account_key
  JOIN dim_transaction_type tt ON tt.transaction_type_key = f.transaction_type_key
  LEFT JOIN dim_decline_reason dr ON dr.decline_reason_key = f.decline_reason_key
  LEFT JOIN dim_merchant m ON m.merchant_key = f.merchant_key
  LEFT JOIN dim_location ml ON ml.location_key = m.location_key)"""


def star_query(sql: str) -> str:
    return with_adapter(STAR_SQL, sql)
