"""Operator 7: exact top-k inner products by a three-phase uniform threshold.

A vector's dimensions are cut into ``LISTS`` score lists: a candidate's score is
the sum of its partial products over the lists.

1. Every cell (a block of candidates) reports for each query the ``k`` best
   entries of every list, with their full scores, and the smallest partial
   product of every list.
2. The k-th best of the full scores met so far is a safe cutoff: no answer is
   below it.  With list minima L a candidate that reaches the cutoff must reach
   (cutoff - sum of L) / LISTS above L in some list.  The cutoffs go out with the
   queries and every cell collects all entries at or above that uniform
   threshold; entries whose seen lists plus threshold for the unseen ones stay
   below the cutoff are dropped.
3. The missing partial products of what is left are resolved, and the k best
   full scores per query remain.

Queries and candidates meet block by block: a candidate block is sent once per
block of queries, a query block once per block of candidates, and every pair of
blocks is one group of bounded size.

Components are floor(1024 * x) with x as double; scores are exact integers (those
that a long holds).

Cases: vectors that are null or hold a null or non-finite component take no
part; vectors of unequal length are padded with zeros; rows that share an id
count once, with the smallest vector; ids that are null take no part (an answer
names its row); ties go to the smaller id; fewer than k candidates give all of
them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import ship_package, written

LISTS = 4
QUERY_BLOCK, ROW_BLOCK = 4096, 4096
#: queries whose scores against a row block are held at once
STRIP = 256


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_numpy(zero_copy_only=False)
    out = np.zeros((len(rows), max([1, *map(len, rows)])), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _partials(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """(LISTS, queries, rows) exact partial products."""
    width = max(q.shape[1], v.shape[1])
    q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
    v = np.pad(v, ((0, 0), (0, width - v.shape[1])))
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * width
    kind = np.float64 if top < 2.0**53 else np.int64
    q, v = q.astype(kind), v.astype(kind)
    return np.stack([q[:, c] @ v[:, c].T for c in np.array_split(np.arange(width), LISTS)]).astype(np.int64)


def _strips(cell_q: pa.Table, cell_v: pa.Table):
    v, ids = _matrix(cell_v["vector"].combine_chunks()), cell_v["vec_id"].to_numpy()
    for s in range(0, cell_q.num_rows, STRIP):
        part = cell_q.slice(s, STRIP)
        yield part, ids, _partials(_matrix(part["query"].combine_chunks()), v)


def _gather(k: int):
    """Phase 1: per query the k best entries of every list and the list minima."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            for part, ids, lists in _strips(left, right):
                total = lists.sum(axis=0)
                for i, qid in enumerate(part["query_id"].to_pylist()):
                    other = np.flatnonzero(ids != qid)
                    if len(other):
                        near = {int(j) for one in lists[:, i, other] for j in other[np.argsort(-one, kind="stable")[:k]]}
                        best = sorted(((int(total[i, j]), -int(ids[j])) for j in near), reverse=True)
                        out.append((qid, [b[0] for b in best], [-b[1] for b in best], lists[:, i, other].min(axis=1).tolist()))
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.int64())),
                         pa.array(cols[2], pa.list_(pa.int64())), pa.array(cols[3], pa.list_(pa.int64()))],
                        names=["query_id", "scores", "ids", "least"])
    return run


def _resolve(k: int):
    """Phases 2 and 3 within a cell."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            for part, ids, lists in _strips(left, right):
                cutoff = part["cutoff"].to_numpy()
                least = np.stack(part["least"].combine_chunks().to_numpy(zero_copy_only=False)).T[:, :, None]
                above = lists - least                       # non-negative but for the query itself
                need = (cutoff - least[:, :, 0].sum(axis=0))[:, None]
                seen = above * LISTS >= need                # at or above the uniform threshold
                bound = np.where(seen, above * LISTS, need).sum(axis=0)
                # an unseen list adds less than the threshold
                keep = seen.any(axis=0) & (bound >= need * LISTS)
                for i, qid in enumerate(part["query_id"].to_pylist()):
                    j = np.flatnonzero(keep[i] & (ids != qid))
                    full = lists[:, i, j].sum(axis=0)
                    j, full = j[full >= cutoff[i]], full[full >= cutoff[i]]
                    order = np.lexsort((ids[j], -full))[:k]
                    out += [(qid, int(ids[x]), int(s)) for x, s in zip(j[order], full[order], strict=True)]
        cols = list(zip(*out, strict=True)) if out else [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query, k: int = 10, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score.  ``is_query``: a condition on the
    column vec_id."""
    ship_package(vectors.sparkSession)
    x = F.col(vector_col)
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * 1024).cast("long"))
    rows = written(vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & whole)
                   .select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("vector"))
                   .groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    queries = rows.where(is_query)
    n, nq = rows.count(), queries.count()
    cells, parts = -(-n // ROW_BLOCK) or 1, -(-nq // QUERY_BLOCK) or 1
    deal = lambda salt, m: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(m)).cast("int")
    numbers = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = rows.select("vec_id", "vector", deal(1, cells).alias("cell"), numbers(parts).alias("part"))
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"),
                           deal(2, parts).alias("part")).select("*", numbers(cells).alias("cell"))

    gathered = (asked.groupBy("cell", "part").cogroup(candidates.groupBy("cell", "part"))
                .applyInArrow(_gather(k), "query_id long, scores array<long>, ids array<long>, least array<long>"))
    entries = gathered.select("query_id", F.explode("scores").alias("score"))
    nth = (entries.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"))))
           .where(F.col("rank") <= k).groupBy("query_id").agg(F.min("score").alias("kth"), F.count("score").alias("met")))
    least = gathered.groupBy("query_id").agg(*[F.min(F.get("least", F.lit(i))).alias(f"l{i}") for i in range(LISTS)])
    cutoffs = written(
        nth.join(least, "query_id").select(
            "query_id",
            # fewer than k entries met: nothing may be cut off
            F.when(F.col("met") >= k, F.col("kth")).otherwise(sum(F.col(f"l{i}") for i in range(LISTS))).alias("cutoff"),
            F.array(*[f"l{i}" for i in range(LISTS)]).alias("least")), "cutoffs")
    found = (asked.join(cutoffs, "query_id").groupBy("cell", "part").cogroup(candidates.groupBy("cell", "part"))
             .applyInArrow(_resolve(k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
