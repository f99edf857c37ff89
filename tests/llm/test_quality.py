import zlib

import numpy as np
import pyarrow as pa
from helpers import ODD, docs_of

from starledger.llm import quality
from starledger.llm.common import table, utf8_buffers
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    score = quality.scorer(quality.fit(docs, labels))
    rows = docs.join(labels, "doc_id").select("doc_id", "quality", quality.held_out("doc_id").alias("h"), score("text").alias("s")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["h"]]
    good = [r["s"] for r in held if r["quality"] == 1]
    junk = [r["s"] for r in held if r["quality"] == 0]
    assert all(0 <= r["s"] <= 1 for r in rows)
    assert np.mean(np.array(good) >= quality.THRESHOLD) > 0.99 and np.mean(np.array(junk) >= quality.THRESHOLD) < 0.05
    # calibrated: the mean score is near the share of label 1
    assert abs(np.mean([r["s"] for r in held]) - len(good) / len(held)) < 0.03


def test_learning_ignores_held_out_labels(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    a = quality.fit(docs, labels)
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    b = quality.fit(docs, turned)
    assert np.array_equal(a.weights, b.weights) and (a.a, a.b, a.bias) == (b.a, b.b, b.bias)


def by_definition(text):
    w = text.encode().split()
    low = [x.lower() for x in w]
    return {"words": len(set(low)), "again": sum(a == b for a, b in zip(low[1:], low[:-1]))}


def test_indicators_are_distinct_and_do_not_cross_rows():
    rows = ["One one two", "", "two THREE!! 4", "one"]
    r, f = quality.features(*utf8_buffers(pa.array(rows)))
    assert len(set(zip(r.tolist(), f.tolist()))) == len(r) and f.max() < quality.SIZE
    for i, t in enumerate(rows):
        alone = quality.features(*utf8_buffers(pa.array([t])))[1]
        assert f[r == i].tolist() == alone.tolist()
        assert sum(x < 1 << 15 for x in alone) == by_definition(t)["words"]


def test_dual_coordinate_descent_separates():
    sets = [np.array([1, 5]), np.array([2, 5]), np.array([3, 5]), np.array([4, 5])] * 10
    labels = np.array([1, 1, 0, 0] * 10)
    mixed = np.random.default_rng(0).permutation(40)            # folds are dealt by place
    m = quality.fit_sets([sets[i] for i in mixed], labels[mixed])
    p = [m.scores(np.zeros(2, np.int64), s, 1)[0] for s in sets[:4]]
    assert min(p[:2]) > 0.8 and max(p[2:]) < 0.2


def test_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(4, 60)] + [(1, None, None), (None, 1, None)],
                                   "doc_id long, quality int, text string")
    docs = docs_of(spark, ODD + [(i, "good plain words here" if i % 2 else "BAD!! BAD!! BAD!!") for i in range(20, 60)])
    score = quality.scorer(quality.fit(docs, labels))
    out = docs.select("doc_id", score("text").alias("s")).collect()
    assert len(out) == docs.count() and all(0 <= r["s"] <= 1 for r in out)
    by = {r["doc_id"]: r["s"] for r in out}
    assert by[1] == by[2] and by[21] > by[20]
    none = quality.scorer(quality.fit(docs, labels.limit(0)))
    assert {r["s"] for r in docs.select(none("text").alias("s")).collect()} == {0.5}
    one = quality.scorer(quality.fit(docs, labels.where("quality = 1")))
    assert min(r["s"] for r in docs.select(one("text").alias("s")).collect()) > 0.99
    assert docs.limit(0).select(score("text")).count() == 0


def test_rows_under_one_id_stay_within_the_sample(spark, monkeypatch):
    docs = docs_of(spark, [(7, f"text number {i}") for i in range(500)] + [(i, f"other {i}") for i in range(8, 40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(7, 40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit_sets", lambda sets, y: seen.append(len(sets)))
    quality.fit(docs, labels, sample=10)
    quality.fit(docs, labels, sample=1000)
    assert seen[0] == 10 and 500 < seen[1] <= 532


def test_scoring_holds_a_batch_of_texts_once():
    import tracemalloc

    score = quality.scorer(quality.Model(np.ones((2, quality.SIZE)), 0.0))
    texts = pa.array([f"{i} Some words, with marks! And NUMBERS {i * 7} again again. " * 20 for i in range(4000)] + [None, ""])
    tracemalloc.start()
    got = [s for a in score.func(iter([texts, texts[:0]])) for s in a.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == len(texts) and all(0 <= s <= 1 for s in got) and got[-1] == got[-2]
    assert peak < 60e6, peak     # of a piece's arrays, not of the 4.5 MB of text
