"""Validation report over the raw tables (Q9-Q18): per table the violations of
every check, up to ``n`` examples of each, and a status.

The rules read a raw table once: a row that breaks any gives a (check, column,
example) each.  One pattern over the typed columns passes the plain rows, so the
costly checks run on few.  Keys and foreign keys are read as columns of their own, counted
per value, and weigh as many rows as they stand for.  The examples of a check are
dealt into ``SHARES`` shares, so a check that a third of all rows break is summed
and sorted in many tasks; a share passes on its sum and its first ``n`` examples.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import FK, TableContract
from .quality import RowCheck, column_set_check, length_checks, not_null_checks, raw_type_checks, raw_types_plain
from .star import is_small

#: examples of a check, and the columns that a load generates itself
EXAMPLES = 5
SHARES = 1024
TOLERATED = ("transaction_sk",)
COLUMNS = ["table_name", "check_name", "column_name", "severity", "violations", "examples"]
ROWS = "rows"


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def _plain(c: str) -> Column:
    """The text forms of one number agree: trimmed, no plus sign, no leading zeros."""
    text = F.trim(F.col(c).cast("string"))
    cut = F.when(F.substring(text, 1, 1).isin("+", "0"), F.regexp_replace(text, r"^\+?0*(?=\d)", "")).otherwise(text)
    return F.nullif(cut, F.lit(""))


def _plain_rules(contract: TableContract) -> list[RowCheck]:
    """The rules that compare lengths and blanks only."""
    keys = [RowCheck("primary_key_null", c, _blank(c)) for c in contract.primary_key]
    keys += [RowCheck("foreign_key_null", fk.column, _blank(fk.column)) for fk in contract.foreign_keys
             if fk.column in contract.required]
    return [*not_null_checks(contract.required, blank_is_null=True), *length_checks(contract), *keys]


def row_rules(contract: TableContract) -> list[RowCheck]:
    return [*_plain_rules(contract), *raw_type_checks(contract)]


def _suspects(df: DataFrame, contract: TableContract) -> DataFrame:
    """The rows that may break a rule: all that break one, and few others."""
    suspect = F.lit(False) if (plain := raw_types_plain(contract)) is None else ~plain
    for r in _plain_rules(contract):
        suspect = suspect | F.coalesce(r.violation, F.lit(False))
    return df.where(suspect)


def _broken_rows(df: DataFrame, contract: TableContract) -> DataFrame:
    rules = row_rules(contract)
    bad = [F.coalesce(r.violation, F.lit(False)) for r in rules]
    which = F.concat_ws("|", *[F.col(c) for c in contract.primary_key])
    hits = [F.when(b, F.struct(F.lit(r.check).alias("check_name"), F.lit(r.column).alias("column_name"),
                               F.concat_ws(": ", which, F.coalesce(r.column, F.lit(""))).alias("example")))
            for r, b in zip(rules, bad, strict=True)]
    return (_suspects(df, contract).select(F.inline(F.array_compact(F.array(*hits))))
            .groupBy("check_name", "column_name", "example").agg(F.count(F.lit(1)).alias("weight")))


def _repeated_keys(df: DataFrame, contract: TableContract) -> DataFrame:
    key = list(contract.primary_key)
    whole = df
    for c in key:
        whole = whole.where(~_blank(c))
    return (whole.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.lit("primary_key_duplicate").alias("check_name"), F.lit(",".join(key)).alias("column_name"),
                    F.concat_ws("|", *key).alias("example"), (F.col("n") - 1).alias("weight")))


def _orphans(df: DataFrame, contract: TableContract, tables: dict[str, DataFrame]) -> DataFrame | None:
    fks = [fk for fk in contract.foreign_keys if fk.parent in tables]
    # keys of small parents are met where the rows are; those of large ones are counted first
    small = [fk for fk in fks if is_small(tables[fk.parent].select(_plain(fk.parent_column).alias("k")))]
    parts = [_lost(df, some, tables) for some in (small, [fk for fk in fks if fk not in small]) if some]
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _lost(df: DataFrame, fks: list[FK], tables: dict[str, DataFrame]) -> DataFrame:
    values = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), _plain(fk.column).alias("k")) for i, fk in enumerate(fks)]))
    counted = df.select(values).where(F.col("k").isNotNull()).groupBy("i", "k").agg(F.count(F.lit(1)).alias("weight"))
    known = None
    for i, fk in enumerate(fks):
        part = tables[fk.parent].select(F.lit(i).alias("i"), _plain(fk.parent_column).alias("k"))
        known = part if known is None else known.unionByName(part)
    column = F.element_at(F.array(*[F.lit(fk.column) for fk in fks]), F.col("i") + 1)
    return (counted.join(known, ["i", "k"], "left_anti")
            .select(F.lit("foreign_key_orphan").alias("check_name"), column.alias("column_name"), F.col("k").alias("example"), "weight"))


def table_report(name: str, df: DataFrame, contract: TableContract, tables: dict[str, DataFrame], n: int = EXAMPLES,
                 tolerated: tuple[str, ...] = TOLERATED) -> DataFrame:
    """Report rows of one raw table: the broken checks, notes on tolerated extra
    columns (severity 'note'), and its number of rows (check 'rows', 'info').
    A header that doesn't fit the contract is reported instead of its rows."""
    spark = df.sparkSession
    header = column_set_check(df, contract, tolerated)
    fixed = [("header_missing", c, "error", 1) for c in header["missing"]]
    fixed += [("header_unexpected", c, "error", 1) for c in header["unexpected"]]
    fixed += [("header_tolerated", c, "note", 1) for c in df.columns if c in tolerated and c not in contract.names]
    said = spark.createDataFrame([(*f, []) for f in fixed],
                                 "check_name string, column_name string, severity string, violations long, examples array<string>")
    if header["ok"]:
        parts = [_broken_rows(df, contract), _repeated_keys(df, contract)]
        if (lost := _orphans(df, contract, tables)) is not None:
            parts.append(lost)
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
        # first within a share of a check's examples, then over the shares' firsts
        share = Window.partitionBy("check_name", "column_name", F.pmod(F.xxhash64("example"), F.lit(SHARES)))
        nth, all_of = F.row_number().over(share.orderBy("example")), F.sum("weight").over(share)
        firsts = (found.select("*", nth.alias("nth"), all_of.alias("all_of")).where(F.col("nth") <= n)
                  .withColumn("weight", F.when(F.col("nth") == 1, F.col("all_of")).otherwise(0)))
        broken = firsts.groupBy("check_name", "column_name").agg(
            F.sum("weight").cast("long").alias("violations"),
            F.slice(F.sort_array(F.collect_list("example")), 1, n).alias("examples")).withColumn("severity", F.lit("error"))
        said = said.unionByName(broken)
    rows = df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(ROWS).alias("check_name"), F.lit("*").alias("column_name"), F.lit("info").alias("severity"), "violations",
        F.array().cast("array<string>").alias("examples"))
    return said.unionByName(rows).select(F.lit(name).alias("table_name"), *COLUMNS[1:])


def with_status(report: DataFrame) -> DataFrame:
    """Adds each table's status: FAIL with any broken check; notes don't fail."""
    errors = F.count_if(F.col("severity") == "error").over(Window.partitionBy("table_name"))     # one row per check
    return report.withColumn("status", F.when(errors > 0, "FAIL").otherwise("PASS"))


@dataclass
class RawReport:
    rows: list
    status: dict[str, str]

    @property
    def passed(self) -> bool:
        return all(s == "PASS" for s in self.status.values())


def validate_raw(tables: dict[str, DataFrame], contracts: dict[str, TableContract], n: int = EXAMPLES,
                 tolerated: tuple[str, ...] = TOLERATED, threads: int = 8) -> RawReport:
    """Q18: one job per table, side by side; a table that is missing fails."""
    present = {name: c for name, c in contracts.items() if name in tables}
    reports = {name: table_report(name, tables[name], c, tables, n, tolerated) for name, c in present.items()}
    with ThreadPoolExecutor(max_workers=threads) as pool:          # metric rows: checks x n examples at most
        rows = dict(zip(reports, pool.map(lambda r: r.collect(), reports.values()), strict=True))
    status = {name: "FAIL" if name not in rows or any(r["severity"] == "error" for r in rows[name]) else "PASS"
              for name in contracts}
    return RawReport([r for part in rows.values() for r in part], status)
