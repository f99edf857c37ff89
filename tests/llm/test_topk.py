import numpy as np
import pytest
from pyspark.sql import functions as F

from starledger.llm import topk
from starledger.llm.common import table
from starledger.llm.topk import top_k


def brute(rows, every, k):
    v = {}
    for i, x in rows:
        if i is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        x = tuple(int(np.floor(1024 * float(c))) for c in x)
        v[i] = min(x, v.get(i, x))
    out = []
    for q in sorted(v):
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], v[i])), i) for i in v if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, 1, 2.0) for i, x in rows], "vec_id long, embedding array<float>, score int, rank double")


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_ties_nulls_and_repeats(spark):
    rows = [(i, [float(i % 3), 1.0, -0.5]) for i in range(40)]
    rows += [(40, None), (41, [1.0, None, 1.0]), (42, [float("nan"), 1.0, 1.0]), (43, [float("inf"), 0.0, 0.0]),
             (None, [9.0, 9.0, 9.0]), (7, [1.0, 1.0, -0.5]), (7, [1.0, 1.0, -0.5]), (44, []), (45, [0.1]), (50, [-9.0, -9.0, -9.0])]
    assert got(top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, 5)) == brute(rows, 10, 5)


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_and_thresholds(spark, seed, monkeypatch):
    monkeypatch.setattr(topk, "ROW_BLOCK", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    r = np.random.default_rng(seed)
    rows = [(i, r.normal(0, 1, 7).astype(np.float32).tolist()) for i in range(400)]
    assert got(top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, 10)) == brute(rows, 20, 10)


def test_threshold_prunes(spark):
    """Phase 2 resolves fewer entries than there are pairs."""
    import pyarrow as pa
    r = np.random.default_rng(0)
    v = np.floor(1024 * r.normal(0, 0.1, (2000, 64))).astype(np.int64)
    right = pa.table({"vec_id": np.arange(2000), "vector": list(v)})
    left = pa.table({"query_id": np.arange(5), "query": list(v[:5])})
    g = topk._gather(10)(None, left, right)
    cut = [sorted(s, reverse=True)[9] for s in g["scores"].to_pylist()]
    asked = left.append_column("cutoff", pa.array(cut)).append_column("least", g["least"])
    out = topk._resolve(10)(None, asked, right).to_pylist()
    want = v[:5] @ v.T
    for q in range(5):
        best = sorted(((-want[q, i], i) for i in range(2000) if i != q))[:10]
        assert [(-o["score"], o["vec_id"]) for o in out if o["query_id"] == q] == best


def test_few_candidates_and_empty(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [3.0])]
    assert got(top_k(vectors(spark, rows), F.col("vec_id") == 0, 10)) == [(0, 1, 2, 3 * 1024**2), (0, 2, 1, 2 * 1024**2)]
    assert top_k(vectors(spark, rows[:1]), F.col("vec_id") == 0, 10).count() == 0
    assert top_k(vectors(spark, rows).limit(0), F.col("vec_id") == 0, 10).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [2e5, -3.0]), (2, [2e5, 3.0])]
    assert got(top_k(vectors(spark, rows), F.col("vec_id") == 0, 2)) == brute(rows, 10, 2)


def test_production_sample(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert got(top_k(df, F.col("vec_id") % 100 == 0, 10)) == brute(rows, 100, 10)
