"""Operator 6: mixing sources to target weights by capped water-filling.

Targets: every source asks for its weight's share of the budget and stops at
``max_epochs`` times its own size; what the stopped sources leave is shared
again by weight until no source is above its cap.  That fixed point is one
water level L with target = min(cap, weight * L); with the sources ordered by
cap / weight, L is the largest (budget - caps before) / (weights from here on),
so a window over the source totals gives it without a loop.

Sampling: a source with target t and size s takes every document floor(t / s)
times, and once more the documents that come first in a seeded order until the
rest of the target is filled (a document at the edge is taken when at least
half of it fits).  The order is that of md5(seed, id); its first digits deal
every source into ``CELLS`` cells, so a source with a third of all rows is
spread over thousands of window groups, and the cells' sums place each of them.
Rows without an id share one place in that order, where they follow by size:
each size of theirs is a cell of its own.

DataFrame functions only.  Cases: a null text has size 0; the null source is a
source of its own and comes last; a null id sorts as the text "null"; a source
of size 0 has target 0 and takes nothing, and a document of size 0 is never
taken to fill up (it is repeated as often as its whole source); identical rows are interchangeable;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 17
#: hex digits of a cell's name
CELL_DIGITS = 3


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size -> and target.  One row per source: the windows run
    over the source totals alone."""
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy("per_weight", "place").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("per_weight", "place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    level = ((F.col("budget") - F.coalesce(F.sum("cap").over(fill), F.lit(0))) / F.sum("weight").over(rest))
    return (totals.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight)
            .withColumn("cap", F.col("source_size") * max_epochs)
            .withColumn("per_weight", F.col("cap") / F.col("weight"))
            .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
            .withColumn("level", level).withColumn("water", F.max("level").over(every))
            .select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.col("weight") * F.col("water")).alias("target")))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, repetitions, taken."""
    return mixed(docs, weights=weights, share=share, max_epochs=max_epochs, seed=seed, id_col=id_col,
                 text_col=text_col, source_col=source_col).drop("same")


def mixed(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
          seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """As ``mix``, and same (the text's xxhash64)."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
                               key.alias("key"), F.xxhash64(F.col(text_col)).alias("same")), "mix-rows")
    unnamed = F.md5(F.lit(f"{seed}|null"))
    rows = rows.withColumn("cell", F.concat(
        F.substring("key", 1, CELL_DIGITS),
        F.when(F.col("key") < unnamed, "0").when(F.col("doc_id").isNull(), F.concat(F.lit("1"), F.lpad(F.col("size").cast("string"), 19, "0")))
        .otherwise("2")))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    aims = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    aims = aims.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("cells_before", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
    c, a = placed.alias("c"), aims.alias("a")
    cut = (c.join(a, F.col("c.source").eqNullSafe(F.col("a.source")))
           .select(F.col("c.source").alias("cut_source"), F.col("c.cell").alias("cut_cell"), "cells_before",
                   "source_size", "target", "whole", "rest"))
    inside = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size", "same").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = rows.withColumn("words_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    fits = F.col("cells_before") + F.col("words_before") + F.col("size") / 2 <= F.col("rest")
    more = (fits & (F.col("size") > 0) & (F.col("rest") > 0)).cast("long")
    return (ranked.join(cut, F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("cell") == F.col("cut_cell")))
            .withColumn("repetitions", F.col("whole") + more)
            .select("doc_id", "source", "size", "source_size", "target", "repetitions",
                    (F.col("size") * F.col("repetitions")).alias("taken"), "same"))
