"""Deterministic de-duplication.

``keep_first`` keeps one row per business key with a *total* order (the given
order columns, then every column), so the survivor never depends on task
scheduling.  It is an aggregate, not a window: Spark combines rows map-side
before the shuffle, so a key holding a third of all rows is reduced per task
instead of being sorted in one task.

``flag_duplicates`` marks every row that is not its key's survivor, exact
replays included.  It runs as aggregate + join back on the key; rows without a
key are dealt out by a salt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_struct(order_by: list[str | Column]) -> list[Column]:
    out = []
    for i, c in enumerate(order_by):
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.alias(f"_o{i}"))
    return out


def keep_first(df: DataFrame, keys: list[str], order_by: list[str | Column], latest: bool = False,
               order_unique: bool = False) -> DataFrame:
    """One row per key, the smallest (``latest=False``) or largest row by
    ``order_by`` then by all columns.  Rows with a NULL key are dropped here:
    route them to quarantine first (X4).

    ``order_unique=True`` declares that a single order column is unique within
    a key (e.g. a Kafka offset within one id); then the survivor is found with
    a hash aggregate of that column and a semi join back on (key, value), which
    is cheaper than the struct minimum and still skew-safe (partial aggregate;
    AQE splits a skewed semi-join partition)."""
    if order_unique and len(order_by) == 1 and isinstance(order_by[0], str):
        o = order_by[0]
        nn = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
        best = nn.groupBy(*keys).agg((F.max(o) if latest else F.min(o)).alias(o))
        return nn.join(best, [*keys, o], "left_semi").select(*df.columns)
    # an order column rides in the rank only: within a tie it decides nothing more
    ranked = {c: f"_o{i}" for i, c in enumerate(order_by) if isinstance(c, str)}
    payload = [c for c in df.columns if c not in keys and c not in ranked]
    agg = F.max if latest else F.min
    row = [F.struct(*payload).alias("_row")] if payload else []
    pick = agg(F.struct(*_order_struct(order_by), *row)).alias("_w")
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    kept = df.where(cond).groupBy(*keys).agg(pick)
    return kept.select(*keys, *[F.col(f"_w._row.{c}").alias(c) for c in payload],
                       *[F.col(f"_w.{o}").alias(c) for c, o in ranked.items() if c not in keys]).select(*df.columns)


def null_salt(keys: list[str], spread: list[str], cells: int = 1024) -> Column:
    """0 for rows with all keys; a hash of ``spread`` for rows with a NULL key.
    As a further join key it deals out rows that can't match anyway, instead of
    hashing them all to one task."""
    missing = None
    for k in keys:
        missing = F.col(k).isNull() if missing is None else missing | F.col(k).isNull()
    return F.when(missing, F.pmod(F.xxhash64(*spread), F.lit(cells))).otherwise(F.lit(0)).cast("int")


def _may_hold(few: DataFrame, keys: list[str]) -> Column:
    """False only for rows whose key is not in ``few``: one bit for each of
    32,768 hash values, so rows of other keys needn't be moved to be told apart."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(32768))
    bits = few.agg(F.bitmap_construct_agg(slot).alias("bits")).scalar()
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(slot, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (slot % 8).cast("int"))) != 0


def flag_duplicates(df: DataFrame, keys: list[str], order_by: list[str | Column], identity: list[str],
                    latest: bool = False, flag: str = "_is_duplicate",
                    attach: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Add ``flag`` (boolean) = row is not the survivor of its key.  The
    survivor is first (or last) by ``order_by``, ``identity``, then every other
    column; of rows equal in all of them (an at-least-once replay of one event)
    exactly one survives.  Rows with a NULL key get ``flag`` = False.
    ``attach`` adds columns (lookups, checks of a row by itself) before rows are
    moved, so what only they read stays where it is; they don't rank."""
    ranks = _order_struct([*order_by, *[c for c in identity if c not in order_by]])
    rank, names = F.struct(*ranks), [f"_o{i}" for i in range(len(ranks))]
    whole = df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    # the rank alone names the survivor of most keys: only the columns of the rank are moved
    each = whole.select(*keys, *ranks).groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("_n"))
    first = (each.groupBy(*keys).agg((F.max if latest else F.min)(F.struct(*names, "_n")).alias("_w"), F.sum("_n").alias("_all"))
             .where("_all > 1").select(*keys, F.struct(*[F.col(f"_w.{c}").alias(c) for c in names]).alias("_first"),
                                       (F.col("_w._n") > 1).alias("_tied"), F.lit(0).alias("_salt")))
    salted = attach(df).withColumn("_salt", null_salt(keys, identity))
    at_first = F.col("_first").isNotNull() & (rank == F.col("_first"))
    open_ = F.coalesce(at_first & F.col("_tied"), F.lit(False))
    settled = (salted.join(first, [*keys, "_salt"], "left").where(~open_)
               .withColumn(flag, F.col("_first").isNotNull() & ~F.coalesce(at_first, F.lit(False))))
    # rows that share the first rank: every other column decides, and of rows equal in all the number
    rest = [c for c in df.columns if c not in {*keys, *identity}]
    whole_rank = F.struct(*rest) if rest else F.lit(0)
    tied = first.where("_tied").select(*keys, "_first")
    rivals = (whole.where(_may_hold(tied, keys)).join(tied, keys).where(rank == F.col("_first")).drop("_first"))
    winners = rivals.groupBy(*keys).agg((F.max if latest else F.min)(whole_rank).alias("_winner"))
    judged = rivals.join(winners, keys).withColumn("_best", whole_rank == F.col("_winner"))
    # replays of the winner are numbered; other rows are spread by their hash
    copies = Window.partitionBy(*keys, "_best", F.when(~F.col("_best"), F.xxhash64(*identity, *rest))).orderBy(F.lit(1))
    judged = judged.withColumn(flag, ~F.col("_best") | (F.row_number().over(copies) > 1))
    judged = attach(judged.select(*df.columns, flag))
    return settled.select(*[c for c in judged.columns if c != flag], flag).unionByName(judged)
