"""Idempotent upsert of a validated batch into the fact.

One full outer join on the business key classifies every row:

* ``INSERT``  batch row whose key is new
* ``UPDATE``  key exists and at least one compared column differs (NULL-safe)
* ``NOOP``    key exists and nothing differs (a replay)
* ``KEEP``    target row the batch does not touch

Rows are never deleted.  The surrogate key is not compared; inserted rows get
new contiguous keys after the current maximum (I17).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .surrogate import assign_surrogate


def differs(cols: list[str], left: str = "t", right: str = "b") -> Column:
    """any column differs, NULL-safe (NULL vs value counts as a change)."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def merge_rows(target: DataFrame, batch: DataFrame, key: str, compare_cols: list[str],
               carry_cols: list[str] = ()) -> DataFrame:
    """The merged table with an ``_action`` column.  ``carry_cols`` are
    target-only columns (e.g. the surrogate key) kept for existing rows."""
    t, b = target.alias("t"), batch.alias("b")
    j = t.join(b, F.col(f"t.{key}") == F.col(f"b.{key}"), "full_outer")
    t_present, b_present = F.col(f"t.{key}").isNotNull(), F.col(f"b.{key}").isNotNull()
    action = (F.when(~t_present, F.lit("INSERT"))
              .when(~b_present, F.lit("KEEP"))
              .when(differs(compare_cols), F.lit("UPDATE"))
              .otherwise(F.lit("NOOP")))
    take_b = action.isin("INSERT", "UPDATE")
    cols = [F.when(take_b, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in [key, *compare_cols]]
    cols += [F.col(f"t.{c}").alias(c) for c in carry_cols]
    return j.select(*cols, action.alias("_action"))


def action_counts(merged: DataFrame) -> DataFrame:
    """One row per action with its count (batch rows only)."""
    return (merged.where(F.col("_action") != "KEEP").groupBy("_action")
                  .agg(F.count(F.lit(1)).alias("rows")))


def merge_fact(target: DataFrame, batch: DataFrame, key: str, compare_cols: list[str],
               sk: str = "transaction_sk") -> tuple[DataFrame, DataFrame]:
    """I13 + I17: (new fact with surrogate keys, merged rows with actions).
    New keys start after the target's current maximum (one scalar aggregate)."""
    merged = merge_rows(target, batch, key, compare_cols, [sk])
    current_max = target.agg(F.coalesce(F.max(sk), F.lit(0)).alias("m")).collect()[0]["m"]
    inserts = merged.where(F.col("_action") == "INSERT").drop(sk)
    inserts = assign_surrogate(inserts, key, sk, int(current_max) + 1)
    rest = merged.where(F.col("_action") != "INSERT")
    fact = rest.unionByName(inserts).drop("_action")
    return fact, merged
