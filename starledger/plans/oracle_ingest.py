"""Oracle SQL (DuckDB) for the ingest-side catalog entries."""

from __future__ import annotations

import re

from .. import contracts as C
from ..operators.quality import DATE_PATTERN, DECIMAL_PATTERN, INT_RANGES
from .oracle import with_adapter
from .oracle_queries import ORACLE

_SQL_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "decimal(18,2)": "DECIMAL(18,2)", "string": "VARCHAR",
             "date": "DATE"}
FACT = C.FACT_TRANSACTIONS
FACT_COLS = FACT.names
COMPARE_COLS = [c for c in FACT_COLS if c != "transaction_id"]


def _sql_type(col: C.Col) -> str:
    return _SQL_TYPE[col.spark_type.simpleString()]


_dirty_cols = []
for _c in [*FACT_COLS, "_kafka_topic", "_kafka_partition", "_kafka_offset"]:
    _s = f"CAST({_c} AS VARCHAR)"
    if _c == "transaction_id":
        _s = f"CASE WHEN _l_quantity = 50 THEN '' ELSE {_s} END"
    elif _c == "amount_egp":
        _s = f"CASE WHEN _l_quantity = 1 THEN 'N/A' ELSE {_s} END"
    elif _c == "date_key":
        _s = f"CASE WHEN _l_quantity = 2 THEN ' ' ELSE {_s} END"
    _dirty_cols.append(f"{_s} AS {_c}")

_conf_cols = []
for _col in FACT.columns:
    _v = f"NULLIF(trim({_col.name}), '')"
    _t = _sql_type(_col)
    _conf_cols.append(f"{_v} AS {_col.name}" if _t == "VARCHAR" else f"TRY_CAST({_v} AS {_t}) AS {_col.name}")

# one total order of events: offset, partition, then every column
_ORDER = ["_kafka_offset", "_kafka_partition", *FACT_COLS, "_kafka_topic"]
_TOTAL = ", ".join(f"{c} ASC NULLS FIRST" for c in _ORDER)
_TOTAL_DESC = ", ".join(f"{c} DESC NULLS LAST" for c in _ORDER)

_ORPHANS = ", ".join(f"CASE WHEN {c} % {n} = 0 THEN -{c} ELSE {c} END AS {c}"
                     for c, n in (("account_key", 50), ("peer_account_key", 50), ("merchant_key", 10)))

_NEW_ID = "CASE WHEN right(transaction_id, 1) = '3' THEN transaction_id || 'N' ELSE transaction_id END AS transaction_id"

PIPE_CTES = f"""
dirty AS (SELECT {', '.join(_dirty_cols)} FROM raw_txn),
conf AS (SELECT {', '.join(_conf_cols)},
                _kafka_topic, TRY_CAST(NULLIF(trim(_kafka_partition), '') AS INTEGER) AS _kafka_partition,
                TRY_CAST(NULLIF(trim(_kafka_offset), '') AS BIGINT) AS _kafka_offset
         FROM dirty),
dq AS (SELECT *, CASE WHEN transaction_id IS NULL THEN 'missing_transaction_id'
                      WHEN date_key IS NULL THEN 'invalid_or_missing_date_key'
                      WHEN amount_egp IS NULL THEN 'invalid_or_missing_amount' END AS _dq_reason FROM conf),
dq_ranked AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {_TOTAL}) AS _rn
              FROM dq WHERE _dq_reason IS NULL),
quarantine AS (
  SELECT _kafka_partition, _kafka_offset, transaction_id, _dq_reason FROM dq WHERE _dq_reason IS NOT NULL
  UNION ALL
  SELECT _kafka_partition, _kafka_offset, transaction_id, 'duplicate_transaction_id' FROM dq_ranked WHERE _rn > 1),
conf_o AS (SELECT * REPLACE ({_ORPHANS}) FROM conf),
fact_o AS (SELECT * REPLACE ({_ORPHANS}) FROM fact_transactions),
staged AS (SELECT *, row_number() OVER (PARTITION BY transaction_id
                                        ORDER BY {_TOTAL_DESC}) AS _rn FROM conf_o),
validated AS (
  SELECT *, CASE
    WHEN transaction_id IS NULL OR trim(transaction_id) = '' THEN 'null_transaction_id'
    WHEN _rn > 1 THEN 'duplicate_transaction_id_in_staging'
    WHEN date_key IS NULL OR time_key IS NULL OR account_key IS NULL OR transaction_type_key IS NULL
      THEN 'missing_required_key'
    WHEN amount_minor IS NULL OR amount_egp IS NULL OR abs_amount_egp IS NULL THEN 'null_measure'
    WHEN NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = s.date_key) THEN 'fk_date_not_found'
    WHEN NOT EXISTS (SELECT 1 FROM dim_time t WHERE t.time_key = s.time_key) THEN 'fk_time_not_found'
    WHEN NOT EXISTS (SELECT 1 FROM dim_account a WHERE a.account_key = s.account_key) THEN 'fk_account_not_found'
    WHEN s.peer_account_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_account a WHERE a.account_key = s.peer_account_key)
      THEN 'fk_peer_account_not_found'
    WHEN NOT EXISTS (SELECT 1 FROM dim_transaction_type tt WHERE tt.transaction_type_key = s.transaction_type_key)
      THEN 'fk_txn_type_not_found'
    WHEN s.decline_reason_key IS NOT NULL
         AND NOT EXISTS (SELECT 1 FROM dim_decline_reason r WHERE r.decline_reason_key = s.decline_reason_key)
      THEN 'fk_decline_reason_not_found'
    WHEN s.merchant_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_merchant m WHERE m.merchant_key = s.merchant_key)
      THEN 'fk_merchant_not_found'
  END AS reject_reason FROM staged s),
mtarget AS (SELECT {', '.join(FACT_COLS)} FROM fact_transactions),
mbatch AS (
  SELECT {', '.join(
      "CAST(CASE WHEN right(transaction_id, 1) = '1' THEN amount_egp + 1 ELSE amount_egp END AS DECIMAL(18,2)) AS amount_egp"
      if c == 'amount_egp' else
      "CASE WHEN right(transaction_id, 1) = '1' THEN amount_minor + 100 ELSE amount_minor END AS amount_minor"
      if c == 'amount_minor' else
      "CASE WHEN right(transaction_id, 1) = '2' AND transaction_type_key = 3 THEN 'ACH-FIX' ELSE ach_transfer_id END "
      "AS ach_transfer_id" if c == 'ach_transfer_id' else _NEW_ID if c == 'transaction_id' else c
      for c in FACT_COLS)}
  FROM fact_transactions)"""


def _merge_sql(target: str, batch: str) -> str:
    differ = " OR ".join(f"t.{c} IS DISTINCT FROM b.{c}" for c in COMPARE_COLS)
    action = (f"CASE WHEN t.transaction_id IS NULL THEN 'INSERT' WHEN b.transaction_id IS NULL THEN 'KEEP' "
              f"WHEN {differ} THEN 'UPDATE' ELSE 'NOOP' END")
    cols = ", ".join(f"CASE WHEN _a IN ('INSERT', 'UPDATE') THEN b_{c} ELSE t_{c} END AS {c}" for c in FACT_COLS)
    inner = ", ".join([f"t.{c} AS t_{c}, b.{c} AS b_{c}" for c in FACT_COLS])
    return (f"(SELECT {cols}, _a AS _action FROM (SELECT {inner}, {action} AS _a FROM {target} t "
            f"FULL OUTER JOIN {batch} b ON t.transaction_id = b.transaction_id))")


def P(sql: str) -> str:
    return with_adapter(PIPE_CTES, sql)


# -- landing -----------------------------------------------------------------------
_ACCOUNT = [c.name for c in C.DIM_ACCOUNT.columns]
_SHORT = [c for c in _ACCOUNT if c != "age_band"]
_LANDED = ", ".join(f"CASE WHEN k % 3 <> 2 THEN age_band END AS {c}" if c == "age_band" else f"CAST({c} AS VARCHAR) AS {c}"
                    for c in _ACCOUNT)
ORACLE["land_by_header"] = with_adapter("accounts AS (SELECT *, account_key AS k FROM dim_account)", f"""
SELECT {_LANDED}, CASE WHEN k % 3 = 1 THEN 'no. ' || k END AS note, '2024-01-01T00:00:00.000Z' AS _ingested_at_utc,
       CAST(NULL AS VARCHAR) AS raw_record, CAST(NULL AS VARCHAR) AS error
FROM accounts WHERE NOT (k % 3 = 2 AND k % 10 = 0)
UNION ALL
SELECT {', '.join('NULL' for _ in _ACCOUNT)}, NULL, '2024-01-01T00:00:00.000Z',
       concat_ws(',', {', '.join(f'CAST({c} AS VARCHAR)' for c in _SHORT[:-1])}), 'wrong_number_of_fields'
FROM accounts WHERE k % 3 = 2 AND k % 10 = 0""")

# -- conform / dedupe ----------------------------------------------------------
ORACLE["conform_txn"] = P(f"SELECT {', '.join(FACT_COLS)} FROM conf")
ORACLE["conform_lineage"] = P("SELECT * FROM conf")
ORACLE["dedupe_earliest"] = with_adapter("""
SELECT transaction_id, _kafka_partition, _kafka_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _kafka_offset, _kafka_topic, _kafka_partition)
    AS rn FROM raw_txn) WHERE rn = 1""")
ORACLE["dedupe_natural_key"] = with_adapter("""
SELECT transaction_id, _kafka_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _kafka_offset DESC) AS rn FROM raw_txn)
WHERE rn = 1""")

# -- dimension builders ----------------------------------------------------------
ORACLE["date_dim"] = with_adapter("SELECT * FROM dim_date")
ORACLE["time_dim"] = with_adapter("""
SELECT event_id, CAST(h * 100 + m AS INTEGER) AS time_key, CAST(h AS INTEGER) AS hour_of_day,
       CASE WHEN h BETWEEN 5 AND 11 THEN 'Morning' WHEN h BETWEEN 12 AND 16 THEN 'Afternoon'
            WHEN h BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END AS time_bucket,
       CAST(CASE WHEN h BETWEEN 6 AND 18 THEN 1 ELSE 0 END AS INTEGER) AS is_daytime,
       lpad(CAST((h + 11) % 12 + 1 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0')
         || CASE WHEN h < 12 THEN ' AM' ELSE ' PM' END AS hour_label
FROM (SELECT event_id, hour(ts) AS h, minute(ts) AS m FROM events)""")
ORACLE["lookup_dim"] = with_adapter("""
SELECT CAST(row_number() OVER (ORDER BY acquisition_channel) AS INTEGER) AS channel_key, acquisition_channel
FROM (SELECT DISTINCT c_mktsegment AS acquisition_channel FROM customer WHERE c_mktsegment IS NOT NULL)""")
ORACLE["branch_names"] = with_adapter("""
SELECT m.merchant_key, m.merchant_category || ' - ' || l.city || ' #' ||
       CAST(row_number() OVER (PARTITION BY m.merchant_category, l.city ORDER BY m.merchant_key) AS VARCHAR)
       AS branch_name
FROM dim_merchant m JOIN dim_location l ON l.location_key = m.location_key""")
ORACLE["business_ids"] = with_adapter("""
SELECT transaction_id, 'ACC' || lpad(CAST(account_key AS VARCHAR), greatest(length(CAST(account_key AS VARCHAR)), 8)::INTEGER, '0') AS account_id,
       'MER' || lpad(CAST(merchant_key AS VARCHAR), greatest(length(CAST(merchant_key AS VARCHAR)), 6)::INTEGER, '0') AS merchant_id
FROM fact_transactions""")
ORACLE["derive_amounts"] = with_adapter("""
SELECT transaction_id, abs_amount_egp, is_outbound, exchange_rate_e6,
       CAST(CASE WHEN is_outbound = 1 THEN -abs_amount_egp ELSE abs_amount_egp END AS DECIMAL(18,2)) AS amount_egp,
       CAST(CAST(CASE WHEN is_outbound = 1 THEN -abs_amount_egp ELSE abs_amount_egp END AS DECIMAL(18,2)) * 100
            AS BIGINT) AS amount_minor,
       CASE WHEN exchange_rate_e6 IS NOT NULL THEN
         (2 * CAST(abs_amount_egp * 100 AS BIGINT) * 1000000 + exchange_rate_e6) // (2 * exchange_rate_e6) END
         AS fx_amount_minor
FROM fact_transactions""")


# -- quality gate ----------------------------------------------------------------
def _metric(table: str, check: str, column: str, violation: str, src: str, severity: str = "error") -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
            f"'{severity}' AS severity, count(*) FILTER (WHERE coalesce({violation}, false)) AS violations FROM {src}")


def _raw_type_sql(table: str, contract: C.TableContract, src: str, decimals: bool | None) -> list[str]:
    out = []
    for col in contract.columns:
        v = col.name
        present = f"({v} IS NOT NULL AND {v} <> '')"
        wt = col.wh_type
        if wt in INT_RANGES and decimals is not True:
            lo, hi = INT_RANGES[wt]
            ok = rf"regexp_matches({v}, '^\s*[-+]?[0-9]+\s*$')"
            out.append(_metric(table, "integer_parse", v, f"{present} AND NOT {ok}", src))
            out.append(_metric(table, "integer_range", v, f"{present} AND {ok} AND NOT "
                               f"(TRY_CAST({v} AS DECIMAL(38,0)) BETWEEN {lo} AND {hi})", src))
        elif wt == "bit" and decimals is not True:
            out.append(_metric(table, "bit_domain", v, f"{present} AND {v} NOT IN ('0', '1')", src))
        elif wt == "date" and decimals is not True:
            out.append(_metric(table, "iso_date", v, f"{present} AND (NOT regexp_matches({v}, '{DATE_PATTERN}') "
                               f"OR TRY_STRPTIME({v}, '%Y-%m-%d') IS NULL)", src))
        elif wt.startswith("decimal(") and decimals is not False:
            prec = int(wt.split("(")[1].split(",")[0])
            fmt = f"regexp_matches({v}, '{DECIMAL_PATTERN}')"
            digits = f"length(regexp_replace(regexp_replace({v}, '^-?0*', ''), '[.]', '', 'g'))"
            out.append(_metric(table, "decimal_format", v, f"{present} AND NOT {fmt}", src))
            out.append(_metric(table, "decimal_precision", v, f"{present} AND {fmt} AND {digits} > {prec}", src))
    return out


def _length_sql(table: str, contract: C.TableContract, src: str) -> list[str]:
    out = []
    for col in contract.columns:
        n = col.max_len
        if n is None:
            continue
        if col.exact_len:
            out.append(_metric(table, "exact_length", col.name,
                               f"{col.name} IS NOT NULL AND length({col.name}) <> {n}", src))
        else:
            out.append(_metric(table, "max_length", col.name, f"{col.name} IS NOT NULL AND length({col.name}) > {n}",
                               src))
    return out


def _strings(table: str) -> str:
    cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in C.STAR[table].names)
    return f"(SELECT {cols} FROM {table})"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _not_null_sql(table, contract, src, blank=False):
    return [_metric(table, "not_null", c,
                    f"{c} IS NULL OR CAST({c} AS VARCHAR) = ''" if blank else f"{c} IS NULL", src)
            for c in contract.required]


def _domain_sql(table, contract, src):
    out = []
    for col in contract.columns:
        if col.domain:
            vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in col.domain)
            out.append(_metric(table, "accepted_values", col.name,
                               f"{col.name} IS NOT NULL AND {col.name} NOT IN ({vals})", src))
    return out


def _unique_sql(table, column, src):
    return (f"SELECT '{table}' AS table_name, 'unique' AS check_name, '{column}' AS column_name, "
            f"'error' AS severity, count(*) AS violations FROM (SELECT {column} FROM {src} "
            f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)")


def _fk_sql(table, fk: C.FK, src, parent_src):
    return (f"SELECT '{table}' AS table_name, 'relationships' AS check_name, "
            f"'{fk.column}->{fk.parent}.{fk.parent_column}' AS column_name, 'error' AS severity, "
            f"count(*) AS violations FROM {src} c WHERE c.{fk.column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent_src} p WHERE p.{fk.parent_column} = c.{fk.column})")


ORACLE["raw_type_check"] = P(_union(_raw_type_sql("fact_transactions", FACT, "dirty", False)
                                    + _raw_type_sql("dim_date", C.DIM_DATE, _strings("dim_date"), None)))
ORACLE["raw_decimal_check"] = P(_union(_raw_type_sql("fact_transactions", FACT, "dirty", True)))
ORACLE["raw_length_check"] = P(_union(
    _length_sql("fact_transactions", FACT, "dirty")
    + [s for n in ("dim_account", "dim_merchant", "dim_time") for s in _length_sql(n, C.STAR[n], _strings(n))]))
def _rows_sql(metric: str, pk: str) -> str:
    """The offending rows of a count: check, column, example, weight."""
    found = re.fullmatch(r"SELECT '(\w+)' AS table_name, '(\w+)' AS check_name, '(\w+)' AS column_name, 'error' AS severity, "
                         r"count\(\*\) FILTER \(WHERE coalesce\((.*), false\)\) AS violations FROM (.*)", metric, re.S)
    table, check, column, rule, src = found.groups()
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
            f"concat_ws(': ', {pk}, coalesce({column}, '')) AS example, 1 AS w FROM {src} WHERE coalesce({rule}, false)")


def _plain_sql(c: str) -> str:
    return rf"NULLIF(regexp_replace(trim(CAST({c} AS VARCHAR)), '^\+?0*(\d)', '\1'), '')"


def _raw_report_sql() -> str:
    parts = []
    for name, contract in C.STAR.items():
        src = "raw_fact" if name == "fact_transactions" else _strings(name)
        pk = contract.primary_key[0]
        rules = [*_not_null_sql(name, contract, src, True), *_raw_type_sql(name, contract, src, None),
                 *_length_sql(name, contract, src)]
        nulls = [("primary_key_null", pk)] + [("foreign_key_null", fk.column) for fk in contract.foreign_keys
                                              if fk.column in contract.required]
        rules += [_metric(name, check, c, f"{c} IS NULL OR {c} = ''", src) for check, c in nulls]
        parts += [_rows_sql(r, pk) for r in rules]
        parts.append(f"SELECT '{name}', 'primary_key_duplicate', '{pk}', {pk}, count(*) - 1 FROM {src} "
                     f"WHERE {pk} <> '' GROUP BY {pk} HAVING count(*) > 1")
        parts += [f"SELECT '{name}', 'foreign_key_orphan', '{fk.column}', k, count(*) FROM (SELECT {_plain_sql(fk.column)} AS k "
                  f"FROM {src}) WHERE k IS NOT NULL AND k NOT IN (SELECT {_plain_sql(fk.parent_column)} FROM {fk.parent}) GROUP BY k"
                  for fk in contract.foreign_keys]
    tables = _union([f"SELECT '{n}', 'rows', '*', 'info', count(*), '' FROM {'raw_fact' if n == 'fact_transactions' else n}"
                     for n in C.STAR])
    notes = _union([f"SELECT 'fact_transactions', 'header_tolerated', '{c}', 'note', 1, ''"
                    for c in ("_kafka_topic", "_kafka_partition", "_kafka_offset")])
    lost = ("CASE WHEN TRY_CAST(merchant_key AS INTEGER) % 10 = 0 THEN '-' || merchant_key ELSE merchant_key END AS merchant_key")
    return P(f"""SELECT *, CASE WHEN count(*) FILTER (WHERE severity = 'error') OVER (PARTITION BY table_name) > 0
                   THEN 'FAIL' ELSE 'PASS' END AS status
FROM (
  WITH raw_fact AS (SELECT * REPLACE ({lost}) FROM dirty),
  found AS ({_union(parts)}),
  summed AS (SELECT table_name, check_name, column_name, example, sum(w) AS w FROM found GROUP BY ALL),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY table_name, check_name, column_name ORDER BY example) AS nth FROM summed)
  SELECT table_name, check_name, column_name, 'error' AS severity, CAST(sum(w) AS BIGINT) AS violations,
         coalesce(string_agg(example, '; ' ORDER BY example) FILTER (WHERE nth <= 5), '') AS examples
  FROM ranked GROUP BY ALL
  UNION ALL {notes}
  UNION ALL {tables})""")


ORACLE["raw_report"] = _raw_report_sql()
ORACLE["dq_not_null"] = P(_union(_not_null_sql("fact_transactions", FACT, "dirty", blank=True)))
ORACLE["dq_domain"] = with_adapter(_union(
    [s for n in ("dim_date", "dim_time", "dim_account", "dim_merchant", "fact_transactions")
     for s in _domain_sql(n, C.STAR[n], n)]))
ORACLE["dq_unique"] = with_adapter(_union(
    [_unique_sql("raw_txn", "transaction_id", "raw_txn")]
    + [_unique_sql(n, k, n) for n in ("dim_account", "dim_merchant", "dim_date", "dim_location")
       for k in [*C.STAR[n].primary_key, *C.STAR[n].unique]]))
_ORPHANED = {"fact_transactions": "fact_o"}
ORACLE["fk_orphans"] = P(_union(
    [_fk_sql(n, fk, _ORPHANED.get(n, n), fk.parent)
     for n in ("fact_transactions", "dim_account", "dim_merchant") for fk in C.STAR[n].foreign_keys]))


def _gate_sql() -> str:
    parts = []
    for name, contract in C.STAR.items():
        checks = _not_null_sql(name, contract, name) + _domain_sql(name, contract, name) \
            + _length_sql(name, contract, name)
        if name == "fact_transactions":
            parts.append("SELECT 'fact_transactions' AS table_name, 'not_empty' AS check_name, '*' AS column_name, "
                         "'error' AS severity, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations "
                         "FROM fact_transactions")
            checks += [
                _metric(name, "abs_amount_nonnegative", "abs_amount_egp", "abs_amount_egp < 0", name),
                _metric(name, "abs_amount_matches_amount", "abs_amount_egp", "abs_amount_egp <> abs(amount_egp)", name),
                _metric(name, "declined_have_reason", "decline_reason_key",
                        "is_declined = 1 AND decline_reason_key IS NULL", name, "warn"),
            ]
        parts += checks
        parts += [_unique_sql(name, k, name) for k in [*contract.primary_key, *contract.unique]]
        parts += [_fk_sql(name, fk, name, fk.parent) for fk in contract.foreign_keys]
    return _union(parts)


ORACLE["dq_summary"] = with_adapter(_gate_sql())
ORACLE["flag_fk_consistency"] = with_adapter(_union([
    _metric("fact_transactions", "declined_has_reason", "decline_reason_key",
            "(is_declined = 1) <> (decline_reason_key IS NOT NULL)", "ft", "warn"),
    _metric("fact_transactions", "fx_has_rate", "exchange_rate_e6",
            "(is_fx = 1) <> (exchange_rate_e6 IS NOT NULL)", "ft", "warn"),
    _metric("fact_transactions", "peer_is_transfer", "peer_account_key",
            "(peer_account_key IS NOT NULL) <> (transaction_group = 'Transfer')", "ft", "warn"),
]).replace("FROM ft", "FROM (SELECT f.*, tt.transaction_group FROM fact_transactions f JOIN dim_transaction_type tt "
                      "ON tt.transaction_type_key = f.transaction_type_key) ft"))
ORACLE["layer_counts"] = P("""
SELECT 'bronze' AS layer, count(*) AS rows FROM raw_txn
UNION ALL SELECT 'silver', count(*) FROM dq_ranked WHERE _rn = 1
UNION ALL SELECT 'gold', count(*) FROM fact_transactions""")
ORACLE["date_gaps"] = with_adapter("""
SELECT d.date_key, d.full_date FROM dim_date d
WHERE NOT EXISTS (SELECT 1 FROM fact_transactions f WHERE f.date_key = d.date_key)""")

# -- incremental event path --------------------------------------------------------
_MARKS = """marks AS (SELECT _kafka_topic, _kafka_partition, max(_kafka_offset) AS m FROM raw_txn
                  WHERE _kafka_offset < (SELECT floor((min(_kafka_offset) + max(_kafka_offset)) / 2) FROM raw_txn)
                  GROUP BY 1, 2),
newr AS (SELECT r.transaction_id, r._kafka_topic, r._kafka_partition, r._kafka_offset FROM raw_txn r
         LEFT JOIN marks k ON k._kafka_topic = r._kafka_topic AND k._kafka_partition = r._kafka_partition
         WHERE r._kafka_offset > coalesce(k.m, -1))"""
ORACLE["offset_filter"] = with_adapter(_MARKS, "SELECT transaction_id, _kafka_partition, _kafka_offset FROM newr")
ORACLE["offset_marks"] = with_adapter(_MARKS, """
SELECT _kafka_topic, _kafka_partition, max(o) AS _kafka_offset FROM (
  SELECT _kafka_topic, _kafka_partition, m AS o FROM marks
  UNION ALL SELECT _kafka_topic, _kafka_partition, _kafka_offset FROM newr) GROUP BY 1, 2""")
ORACLE["batch_id"] = with_adapter("""
SELECT _kafka_topic, _kafka_partition, min(_kafka_offset) AS lo, max(_kafka_offset) AS hi,
       printf('b_%09d_%09d', min(_kafka_offset), max(_kafka_offset)) AS batch_id
FROM raw_txn GROUP BY _kafka_topic, _kafka_partition""")
ORACLE["dlq_split"] = with_adapter("""
msgs AS (
  SELECT event_id, CASE
    WHEN event_id % 97 = 0 THEN '{"transaction_id": ' || CAST(event_id AS VARCHAR)
    WHEN event_id % 89 = 0 THEN '42'
    WHEN event_id % 83 = 0 THEN ''
    ELSE '{"transaction_id": "EVT' || CAST(event_id AS VARCHAR) || '", "amount_egp": "x"}' END AS v
  FROM events),
cls AS (SELECT event_id, v, CASE WHEN v IS NULL OR trim(v) = '' THEN 'empty_value'
                                 WHEN NOT json_valid(v) THEN 'invalid_json'
                                 WHEN json_type(v) <> 'OBJECT' THEN 'not_an_object' END AS error FROM msgs)""", """
SELECT event_id, CASE WHEN error IS NULL THEN json_extract_string(v, '$.transaction_id') END AS transaction_id, error
FROM cls""")
ORACLE["payload_flatten"] = with_adapter("""
SELECT transaction_id, CAST(date_key AS VARCHAR) AS date_key, CAST(amount_egp AS VARCHAR) AS amount_egp,
       _kafka_topic, _kafka_partition, _kafka_offset FROM raw_txn""")
ORACLE["dq_split"] = P("SELECT _kafka_partition, _kafka_offset, transaction_id, _dq_reason FROM dq")
ORACLE["quarantine_all"] = P("SELECT * FROM quarantine")
ORACLE["quarantine_reconcile"] = P("""
SELECT n AS new_rows, s AS silver_rows, q AS quarantine_rows, CAST(s + q = n AS INTEGER) AS reconciled FROM (
  SELECT (SELECT count(*) FROM conf) AS n, (SELECT count(*) FROM dq_ranked WHERE _rn = 1) AS s,
         (SELECT count(*) FROM quarantine) AS q)""")

ORACLE["published_batches"] = P("""
SELECT transaction_id, _kafka_partition, _kafka_offset, 'p' || _kafka_partition AS silver_batch_id FROM conf""")

ORACLE["offset_resume"] = """
WITH m AS (SELECT event_id AS o, CAST(event_id % 3 AS INTEGER) AS p FROM events),
early AS (SELECT o, p, o <= (SELECT max(o) FROM m) * 6 / 10 AND o % 50 <> 7 AS early FROM m),
marks AS (SELECT p, max(o) AS mark FROM early WHERE early GROUP BY p)
SELECT CAST(CASE WHEN early THEN 1 ELSE 2 END AS INTEGER) AS run, CAST(o AS VARCHAR) AS key, 'transactions_raw' AS topic,
       p AS partition, o AS "offset"
FROM early LEFT JOIN marks USING (p) WHERE early OR o > coalesce(mark, -1)"""

# -- validation and merge ------------------------------------------------------------
ORACLE["fk_reject"] = P("SELECT _kafka_partition, _kafka_offset, transaction_id, reject_reason FROM validated")
ORACLE["reject_counts"] = P(
    "SELECT reject_reason, count(*) AS rows FROM validated WHERE reject_reason IS NOT NULL GROUP BY 1")
ORACLE["merge_result"] = P(f"SELECT {', '.join(FACT_COLS)} FROM {_merge_sql('mtarget', 'mbatch')}")
ORACLE["merge_actions"] = P(
    f"SELECT _action AS action, count(*) AS rows FROM {_merge_sql('mtarget', 'mbatch')} WHERE _action <> 'KEEP' "
    f"GROUP BY 1")
ORACLE["key_index_lookup"] = with_adapter("""
SELECT transaction_id, CAST(date_key // 100 + CASE WHEN right(transaction_id, 1) = '1' THEN 100 ELSE 0 END AS INTEGER) AS month
FROM fact_transactions WHERE right(transaction_id, 1) IN ('1', '2')""")
_VALID_COLS = ", ".join(_NEW_ID if c == "transaction_id" else c for c in FACT_COLS)
ORACLE["merge_summary"] = P(f"""
SELECT (SELECT count(*) FROM validated) AS rows_staged,
       (SELECT count(*) FROM validated WHERE reject_reason IS NULL) AS rows_valid,
       (SELECT count(*) FROM validated WHERE reject_reason IS NOT NULL) AS rows_rejected,
       (SELECT count(*) FROM {_merge_sql('mtarget', f"(SELECT {_VALID_COLS} FROM validated WHERE reject_reason IS NULL)")} WHERE _action = 'INSERT') AS rows_inserted,
       (SELECT count(*) FROM {_merge_sql('mtarget', f"(SELECT {_VALID_COLS} FROM validated WHERE reject_reason IS NULL)")} WHERE _action = 'UPDATE') AS rows_updated""")
