import hashlib
from collections import defaultdict

import pytest
from helpers import MEDIUM, ODD, docs_of, words
from hypothesis import given, settings
from hypothesis import strategies as st

from starledger.llm.common import table
from starledger.llm.mixing import mix, targets


def poured(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Targets by reshare after reshare."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    budget, open_, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weight[i] for i in open_)
        over = [i for i in open_ if budget * weight[i] / total > epochs * sizes[i]]
        if not over:
            for i in open_:
                out[i] = budget * weight[i] / total
            break
        for i in over:
            out[i] = float(epochs * sizes[i])
            open_.discard(i)
            budget -= out[i]
    return out


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_water_level_equals_resharing(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = [r["target"] for r in targets(df).orderBy("source").collect()]
    assert got == pytest.approx(poured(sizes))


def test_taken_words_come_near_the_targets(spark):
    by = defaultdict(list)
    for r in mix(table(spark, MEDIUM, "documents")).collect():
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["size"] * r["repetitions"]
        by[r["source"]].append(r)
    for rows in by.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= max(r["size"] for r in rows)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = table(spark, MEDIUM, "documents")
    a = sorted(map(tuple, mix(docs.repartition(1)).collect()))
    assert a == sorted(map(tuple, mix(docs.repartition(11)).collect()))
    assert a != sorted(map(tuple, mix(docs, seed=18).collect()))


def test_native_plan(spark):
    plan = mix(table(spark, MEDIUM, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_odd_and_empty_tables(spark):
    rows = mix(docs_of(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    size = {(r["doc_id"], r["source"]): r["size"] for r in rows}
    for d, t, *rest in ODD:
        assert size[d, rest[1] if len(rest) > 1 else "src0"] == len(words(t))
    assert {r["source"] for r in rows} == {None, "src0", "src1", "src2"}
    # the null source comes last: weight 5, 2, 1, 5
    totals = {r["source"]: (r["source_size"], r["target"]) for r in rows}
    names = ["src0", "src1", "src2", None]
    assert [totals[n][1] for n in names] == pytest.approx(poured([totals[n][0] for n in names]))
    assert mix(docs_of(spark, ODD).limit(0)).count() == 0
    assert [r["taken"] for r in mix(docs_of(spark, [(1, None), (2, "")])).collect()] == [0, 0]


def test_empty_documents_fill_nothing_up(spark):
    """A capped source repeats every document twice, empty ones no more often."""
    rows = [(i, "" if i % 3 == 0 else "one two three", "en", "src0") for i in range(30)]
    rows += [(100 + i, "word " * 500, "en", "src1") for i in range(30)]
    got = {r["doc_id"]: (r["repetitions"], r["target"] / r["source_size"]) for r in mix(docs_of(spark, rows)).collect()}
    assert {got[i] for i in range(30)} == {(2, 2.0)} and max(r for r, _ in got.values()) == 2


def test_a_third_of_the_rows_without_an_id(spark):
    """They follow by size where their common key stands; no cell holds all of them."""
    rows = [(None if i % 3 == 0 else i, "w " * (i % 50), "en", f"src{i % 2}") for i in range(3000)]
    by = defaultdict(list)
    for r in mix(docs_of(spark, rows)).collect():
        by[r["source"]].append(r)
    for s, got in by.items():
        rest = got[0]["target"] - got[0]["target"] // got[0]["source_size"] * got[0]["source_size"]
        whole = int(got[0]["target"] // got[0]["source_size"])
        order = sorted(got, key=lambda r: (hashlib.md5(f"17|{'null' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest(),
                                           r["doc_id"] or -1, r["size"]))
        before = 0
        for r in order:
            more = r["size"] > 0 and rest > 0 and before + r["size"] / 2 <= rest
            assert r["repetitions"] == whole + more, (s, r)
            before += r["size"]
