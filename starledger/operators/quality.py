"""Contract-driven data-quality gate (Q1-Q24).

Every check yields metric rows ``(table_name, check_name, column_name,
severity, violations)``.  Row-level checks of one table (not-null, accepted
values, lengths, expressions, raw-text type checks) are folded into a single
aggregate pass per table; uniqueness is one grouped aggregate per key and
relationships are anti-joins whose parent key set is broadcast only when its
planned size is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import TableContract
from .star import broadcast_if_small, is_small

METRIC_COLS = ["table_name", "check_name", "column_name", "severity", "violations"]

# Fixed integer ranges of warehouse widths (tinyint is unsigned 0..255).
INT_RANGES = {
    "tinyint": (0, 255),
    "smallint": (-32768, 32767),
    "int": (-2147483648, 2147483647),
    "bigint": (-9223372036854775808, 9223372036854775807),
}
DECIMAL_PATTERN = r"^-?[0-9]+[.][0-9]{2}$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


@dataclass(frozen=True)
class RowCheck:
    check: str
    column: str
    violation: Column          # TRUE for an offending row
    severity: str = "error"


def _metrics(table: str, df: DataFrame, checks: list[RowCheck]) -> DataFrame:
    """One aggregate pass for all row checks, unpivoted to metric rows."""
    if not checks:
        return df.sparkSession.createDataFrame([], "table_name string, check_name string, column_name string, "
                                                   "severity string, violations bigint")
    agg = df.agg(*[F.count_if(F.coalesce(c.violation, F.lit(False))).alias(f"_c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(c.check).alias("check_name"),
                              F.lit(c.column).alias("column_name"), F.lit(c.severity).alias("severity"),
                              F.col(f"_c{i}").cast("bigint").alias("violations"))
                     for i, c in enumerate(checks)])
    return agg.select(F.inline(rows))


# -- row-level checks --------------------------------------------------------
def not_null_checks(columns: list[str], blank_is_null: bool = False) -> list[RowCheck]:
    """Q2 / Q15 (``blank_is_null`` for raw text: '' or NULL fails)."""
    out = []
    for c in columns:
        v = F.col(c).isNull()
        if blank_is_null:
            v = v | (F.col(c).cast("string") == "")
        out.append(RowCheck("not_null", c, v))
    return out


def domain_checks(domains: dict[str, tuple]) -> list[RowCheck]:
    """Q3: value outside the accepted set; NULL passes."""
    return [RowCheck("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(*vals))
            for c, vals in domains.items()]


def length_checks(contract: TableContract) -> list[RowCheck]:
    """Q13: CHAR exact / VARCHAR max length."""
    out = []
    for col in contract.columns:
        n = col.max_len
        if n is None:
            continue
        ln = F.length(F.col(col.name))
        if col.exact_len:
            out.append(RowCheck("exact_length", col.name, F.col(col.name).isNotNull() & (ln != n)))
        else:
            out.append(RowCheck("max_length", col.name, F.col(col.name).isNotNull() & (ln > n)))
    return out


def raw_type_checks(contract: TableContract) -> list[RowCheck]:
    """Q10-Q12, Q14 on all-string raw columns; empty values are skipped here
    (they are NOT NULL violations, Q15)."""
    out = []
    for col in contract.columns:
        v = F.col(col.name)
        present = v.isNotNull() & (v != "")
        wt = col.wh_type
        if wt in INT_RANGES:
            lo, hi = INT_RANGES[wt]
            as_int = v.try_cast("decimal(38,0)")
            bad_int = ~v.rlike(r"^\s*[-+]?[0-9]+\s*$")
            out.append(RowCheck("integer_parse", col.name, present & bad_int))
            out.append(RowCheck("integer_range", col.name, present & ~bad_int & ~as_int.between(lo, hi)))
        elif wt == "bit":
            out.append(RowCheck("bit_domain", col.name, present & ~v.isin("0", "1")))
        elif wt == "date":
            out.append(RowCheck("iso_date", col.name,
                                present & (~v.rlike(DATE_PATTERN) | F.try_to_date(v, "yyyy-MM-dd").isNull())))
        elif wt.startswith("decimal("):
            prec = int(wt.split("(")[1].split(",")[0])
            digits = F.length(F.regexp_replace(F.regexp_replace(v, r"^-?0*", ""), r"[.]", ""))
            out.append(RowCheck("decimal_format", col.name, present & ~v.rlike(DECIMAL_PATTERN)))
            out.append(RowCheck("decimal_precision", col.name, present & v.rlike(DECIMAL_PATTERN) & (digits > prec)))
    return out


def raw_types_plain(contract: TableContract) -> Column | None:
    """TRUE only for rows that break none of ``raw_type_checks``, by one pattern
    over all typed columns of the row; FALSE says nothing, the checks decide.
    Each part allows what is right whatever its digits, and never the separator,
    so a value that holds one can't shift the parts.  None without typed columns."""
    names, parts = [], []
    for col in contract.columns:
        wt = col.wh_type
        if wt in INT_RANGES:
            lo, hi = INT_RANGES[wt]
            part = f"{'-?' if lo < 0 else ''}[0-9]{{1,{len(str(hi)) - 1}}}"
        elif wt == "bit":
            part = "[01]"
        elif wt == "date":
            part = "[1-9][0-9]{3}-(?:0[1-9]|1[0-2])-(?:0[1-9]|1[0-9]|2[0-8])"
        elif wt.startswith("decimal("):
            part = f"-?[0-9]{{1,{int(wt.split('(')[1].split(',')[0]) - 2}}}[.][0-9]{{2}}"
        else:
            continue
        names.append(col.name)
        parts.append(f"(?:{part})?")
    if not names:
        return None
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    return text.rlike(r"\A" + r"\|".join(parts) + r"\z")


def row_checks(df: DataFrame, table: str, checks: list[RowCheck]) -> DataFrame:
    return _metrics(table, df, checks)


# -- keyed checks --------------------------------------------------------------
def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Q1/Q16: number of key values that occur more than once (NULLs ignored)."""
    dup = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
             .where("_n > 1"))
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("check_name"), F.lit(column).alias("column_name"),
        F.lit("error").alias("severity"), "violations")


def check_unique_many(checks: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Q1/Q16 for many (frame, table, column) at once: the keys are stacked as
    (number of the check, value) and counted in one shuffle; every check yields
    a metric row (0 when no value repeats)."""
    stacked = None
    names = list(dict.fromkeys((t, c) for _, t, c in checks))
    for df, table, column in checks:
        part = df.where(F.col(column).isNotNull()).select(
            F.lit(names.index((table, column))).alias("__i"), F.col(column).cast("string").alias("__v"))
        stacked = part if stacked is None else stacked.unionByName(part)
    dups = (stacked.groupBy("__i", "__v").agg(F.count(F.lit(1)).alias("__n"))
                   .where("__n > 1").groupBy("__i").agg(F.count(F.lit(1)).alias("__d")))
    expected = checks[0][0].sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(names.index((t, c))).alias("__i"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"))
        for _, t, c in checks])))
    return (expected.join(dups, "__i", "left")
                    .select("table_name", F.lit("unique").alias("check_name"), "column_name",
                            F.lit("error").alias("severity"),
                            F.coalesce(F.col("__d"), F.lit(0)).cast("bigint").alias("violations")))


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows with a non-null fk missing from the parent."""
    keys = broadcast_if_small(parent.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull()).distinct())
    return child.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def check_fk(child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str, parent_name: str = "") -> DataFrame:
    """Q4/Q17 count: broadcast anti-join for a bounded parent, eager
    aggregation for a data-sized one."""
    if not is_small(parent.select(pk)):
        return check_fk_eager(child, table, fk, parent, pk, parent_name)
    return orphan_rows(child, fk, parent, pk).agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("relationships").alias("check_name"),
        F.lit(f"{fk}->{parent_name}.{pk}" if parent_name else fk).alias("column_name"),
        F.lit("error").alias("severity"), "violations")


# -- singular assertions on the fact (Q5-Q8, Q20) -----------------------------
def fact_assertions(fact: DataFrame) -> list[RowCheck]:
    return [
        RowCheck("abs_amount_nonnegative", "abs_amount_egp", F.col("abs_amount_egp") < 0),
        RowCheck("abs_amount_matches_amount", "abs_amount_egp", F.col("abs_amount_egp") != F.abs("amount_egp")),
        RowCheck("declined_have_reason", "decline_reason_key",
                 (F.col("is_declined") == 1) & F.col("decline_reason_key").isNull(), "warn"),
    ]


def not_empty(df: DataFrame, table: str) -> DataFrame:
    """Q5: one violation when the table has no rows (stops at the first row)."""
    has = df.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    return has.select(F.lit(table).alias("table_name"), F.lit("not_empty").alias("check_name"),
                      F.lit("*").alias("column_name"), F.lit("error").alias("severity"),
                      F.when(F.col("_n") == 0, 1).otherwise(0).cast("bigint").alias("violations"))


def contract_checks(df: DataFrame, contract: TableContract) -> list[RowCheck]:
    domains = {c.name: c.domain for c in contract.columns if c.domain}
    return not_null_checks(contract.required) + domain_checks(domains) + length_checks(contract)


def check_fk_eager(child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str, parent_name: str = "",
                   severity: str = "error") -> DataFrame:
    """Q4 for a data-sized parent: count child rows per fk value first (partial
    aggregation), then match the distinct values against the parent's keys.
    Only one row per distinct key crosses the network, never the child rows."""
    per_key = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("__n"))
    keys = parent.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull()).distinct()
    orphans = per_key.join(keys, fk, "left_anti")
    return orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("relationships").alias("check_name"),
        F.lit(f"{fk}->{parent_name}.{pk}" if parent_name else fk).alias("column_name"),
        F.lit(severity).alias("severity"), "violations")


def check_fks(child: DataFrame, table: str, fks: list[tuple[str, DataFrame, str, str]],
              severity: str = "error") -> DataFrame:
    """Q4 for all relationships (fk, parent, pk, parent name) of a table in one
    pass: the child gives a count per (relationship, key value) - combined
    before the shuffle, so neither the rows nor a hot key cross the network -
    and the distinct values alone meet the parents' keys."""
    names = [f"{fk}->{parent_name}.{pk}" for fk, _, pk, parent_name in fks]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(fk).cast("string").alias("k"))
                               for i, (fk, _, _, _) in enumerate(fks)]))
    counts = (child.select(keys.alias("x")).select("x.i", "x.k").where(F.col("k").isNotNull())
              .groupBy("i", "k").agg(F.count(F.lit(1)).alias("n")))
    known = None
    for i, (_, parent, pk, _) in enumerate(fks):
        part = parent.select(F.lit(i).alias("i"), F.col(pk).cast("string").alias("k"))
        known = part if known is None else known.unionByName(part)
    lost = counts.join(known, ["i", "k"], "left_anti").groupBy("i").agg(F.sum("n").alias("n"))
    listed = child.sparkSession.createDataFrame(list(enumerate(names)), "i int, column_name string")
    return listed.join(lost, "i", "left").select(
        F.lit(table).alias("table_name"), F.lit("relationships").alias("check_name"), "column_name",
        F.lit(severity).alias("severity"), F.coalesce("n", F.lit(0)).cast("bigint").alias("violations"))


def fk_hits(df: DataFrame, fks: list[tuple[str, DataFrame, str]]) -> tuple[DataFrame, list[str]]:
    """Attach one ``hit`` flag per relationship (left join to the parent's
    distinct keys, broadcast when small) so all FK checks of a table share the
    table's single aggregate pass instead of one anti-join scan each."""
    flags = []
    for i, (fk, parent, pk) in enumerate(fks):
        hit = f"__fk_hit{i}"
        keys = broadcast_if_small(parent.select(F.col(pk).alias(f"__fk{i}")).where(F.col(f"__fk{i}").isNotNull())
                                  .distinct().withColumn(hit, F.lit(True)))
        df = df.join(keys, df[fk] == keys[f"__fk{i}"], "left").drop(f"__fk{i}")
        flags.append(hit)
    return df, flags


def gate_parts(tables: dict[str, DataFrame], contracts: dict[str, TableContract],
               fact_table: str = "fact_transactions") -> list[DataFrame]:
    """The gate as independent metric frames (one row-check pass per table,
    one shuffle for all unique keys together)."""
    parts, uniques = [], []
    for name, contract in contracts.items():
        if name not in tables:
            continue
        df = tables[name]
        checks = contract_checks(df, contract)
        if name == fact_table:
            checks += fact_assertions(df)
            parts.append(not_empty(df, name))
        fks = [fk for fk in contract.foreign_keys if fk.parent in tables]
        # bounded parents: broadcast hit flags inside this table's single pass;
        # data-sized parents: eager-aggregated check (no shuffle of the rows)
        small = [fk for fk in fks if is_small(tables[fk.parent].select(fk.parent_column))]
        for fk in fks:
            if fk not in small:
                parts.append(check_fk_eager(df, name, fk.column, tables[fk.parent], fk.parent_column, fk.parent))
        joined, flags = fk_hits(df, [(fk.column, tables[fk.parent], fk.parent_column) for fk in small])
        checks += [RowCheck("relationships", f"{fk.column}->{fk.parent}.{fk.parent_column}",
                            F.col(fk.column).isNotNull() & F.col(flag).isNull())
                   for fk, flag in zip(small, flags)]
        parts.append(row_checks(joined, name, checks))
        uniques += [(df, name, key) for key in [*contract.primary_key, *contract.unique]]
    if uniques:
        parts.append(check_unique_many(uniques))
    return parts


def run_gate(tables: dict[str, DataFrame], contracts: dict[str, TableContract],
             fact_table: str = "fact_transactions") -> DataFrame:
    """Q23 + Q1-Q8: every contract check of every table as metric rows.

    Per table: one aggregate pass for not-null / domain / length / assertion
    and relationship checks, plus one grouped aggregate per unique key."""
    parts = gate_parts(tables, contracts, fact_table)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def collect_gate(tables: dict[str, DataFrame], contracts: dict[str, TableContract], threads: int = 8) -> list:
    """Evaluate the gate parts as concurrent Spark jobs (the scheduler runs
    them side by side); each part returns a handful of metric rows."""
    from concurrent.futures import ThreadPoolExecutor
    parts = gate_parts(tables, contracts)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        results = list(pool.map(lambda p: p.collect(), parts))
    return [r for rows in results for r in rows]


def gate_summary(metrics: DataFrame) -> DataFrame:
    """Q18: pass/fail per table; warnings never fail."""
    return metrics.groupBy("table_name").agg(
        F.sum(F.when(F.col("severity") == "error", F.col("violations")).otherwise(0)).cast("bigint").alias("errors"),
        F.sum(F.when(F.col("severity") == "warn", F.col("violations")).otherwise(0)).cast("bigint").alias("warnings"),
    ).withColumn("status", F.when(F.col("errors") == 0, "PASS").otherwise("FAIL"))


def sample_violations(df: DataFrame, violation: Column, order_by: list[str], n: int = 5) -> DataFrame:
    """Q18: up to ``n`` example rows of one check (a bounded top-n)."""
    return df.where(violation).orderBy(*order_by).limit(n)


def column_set_check(df: DataFrame, contract: TableContract, tolerated: tuple[str, ...] = ()) -> dict:
    """Q9: missing and unexpected columns against the contract (schema only)."""
    have, want = list(df.columns), contract.names
    missing = [c for c in want if c not in have]
    unexpected = [c for c in have if c not in want and c not in tolerated]
    return {"missing": missing, "unexpected": unexpected, "ok": not missing and not unexpected}


def raw_key_checks(contract: TableContract) -> list[RowCheck]:
    """Q16/Q17 on the raw text: a key or a required foreign key that is NULL or
    blank."""
    required = [*contract.primary_key, *[fk.column for fk in contract.foreign_keys if fk.column in contract.required]]
    return [RowCheck("raw_key_missing", c, F.col(c).isNull() | (F.trim(F.col(c)) == "")) for c in dict.fromkeys(required)]


def raw_orphans(child: DataFrame, table: str, fks: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Q17 on the raw text: values that are no parent's key, trimmed and without
    leading zeros or a plus sign, so that text forms of one number agree."""
    def plain(c: str) -> Column:
        return F.nullif(F.regexp_replace(F.trim(F.col(c).cast("string")), r"^\+?0*(?=\d)", ""), F.lit(""))
    text = child.select(*[plain(fk).alias(fk) for fk in dict.fromkeys(f[0] for f in fks)])
    return check_fks(text, table, fks)


@dataclass
class GateReport:
    """Q18: the metric rows, up to ``n`` sample rows of every failing row check,
    and the overall status (warnings never fail)."""
    metrics: list
    samples: dict[tuple[str, str, str], list]
    status: str


def gate_report(tables: dict[str, DataFrame], contracts: dict[str, TableContract], n: int = 5) -> GateReport:
    """Run the gate; then fetch samples for the row checks that failed, one
    bounded top-n per failing check and none when all pass."""
    metrics = collect_gate(tables, contracts)
    failing = {(r.table_name, r.check_name, r.column_name) for r in metrics if r.violations > 0}
    samples: dict[tuple[str, str, str], list] = {}
    for name, contract in contracts.items():
        if name not in tables:
            continue
        checks = contract_checks(tables[name], contract)
        if name == "fact_transactions":
            checks += fact_assertions(tables[name])
        for c in checks:
            if (key := (name, c.check, c.column)) in failing:
                samples[key] = sample_violations(tables[name], c.violation, list(contract.primary_key), n).collect()
        for fk in contract.foreign_keys:
            key = (name, "relationships", f"{fk.column}->{fk.parent}.{fk.parent_column}")
            if key in failing:
                samples[key] = orphan_rows(tables[name], fk.column, tables[fk.parent], fk.parent_column).orderBy(
                    *contract.primary_key).limit(n).collect()
    errors = any(r.severity == "error" and r.violations > 0 for r in metrics)
    return GateReport(metrics, samples, "FAIL" if errors else "PASS")


class GateFailed(AssertionError):
    pass


def assert_contracts(tables: dict[str, DataFrame], contracts: dict[str, TableContract]) -> None:
    """Run the gate and raise when an error-severity check has violations."""
    bad = [r for r in collect_gate(tables, contracts)      # metric rows only: bounded by the number of checks
           if r.severity == "error" and r.violations > 0]
    if bad:
        raise GateFailed("; ".join(f"{r.table_name}.{r.check_name}({r.column_name})={r.violations}" for r in bad))


def reconcile_kpis(actual: DataFrame, expected: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """Q21: compare measure values with expected benchmark values.

    ``actual`` / ``expected`` are long frames ``(*keys, measure, value)``; the
    result has one row per (keys, measure) with both values and ``status``
    OK / MISMATCH / MISSING (relative tolerance, exact when 0)."""
    a = actual.withColumnRenamed("value", "actual")
    e = expected.withColumnRenamed("value", "expected")
    j = e.join(a, [*keys, "measure"], "left")
    diff = F.abs(F.col("actual").cast("double") - F.col("expected").cast("double"))
    bound = F.abs(F.col("expected").cast("double")) * F.lit(tolerance)
    return j.withColumn("status", F.when(F.col("actual").isNull(), "MISSING")
                        .when(diff <= bound, "OK").otherwise("MISMATCH"))


def measures_long(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Unpivot measure columns to (keys, measure, value) for reconciliation."""
    return df.unpivot(keys, measures, "measure", "value") if keys else \
        df.withColumn("__k", F.lit(1)).unpivot(["__k"], measures, "measure", "value").drop("__k")
