import random

import numpy as np
import pytest
from helpers import MEDIUM, ODD, docs_of, edit_distance_inside, texts

from starledger.llm import decontaminate
from starledger.llm.common import table
from starledger.llm.decontaminate import RATE, Index, aligned, budget, codes, leaks, normal


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, distance string")


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(n))


def edited(text, edits, seed):
    r, out = random.Random(seed), list(text)
    for _ in range(edits):
        i = r.randrange(len(out))
        match r.randrange(3):
            case 0: out[i] = r.choice("xyz")
            case 1: out.insert(i, r.choice("xyz"))
            case _: del out[i]
    return "".join(out)


def test_finds_all_within_the_budget_and_nothing_beyond(spark):
    items = [(i, prose(25, i)) for i in range(6)]
    rows = [(100, prose(80, 77))]
    for i, t in items:
        k = budget(len(normal(t)))
        for n, e in enumerate((0, 1, k // 2, k, 2 * k, 4 * k)):
            rows.append((i * 10 + n, prose(30, 1000 + i) + " " + edited(t, e, n).upper() + "\n\t" + prose(30, 2000 + i)))
    got = {(r["doc_id"], r["item_id"]): r for r in leaks(docs_of(spark, rows), items_of(spark, items)).collect()}
    for d, t in rows:
        for i, x in items:
            x = normal(x)
            distance = edit_distance_inside(x, normal(t))
            assert ((d, i) in got) == (distance <= budget(len(x))), (d, i, distance)
            if (d, i) in got:
                r = got[d, i]
                assert r["distance"] == distance
                assert edit_distance_inside(normal(t)[r["start"]:r["end"]], x) <= distance + abs(r["end"] - r["start"] - len(x))


def test_whole_table_contains_every_exact_passage(spark):
    items = [(r["item_id"], normal(r["text"])) for r in table(spark, MEDIUM, "benchmark").collect()]
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in leaks(
        table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "benchmark")).collect()}
    exact = {(d, i) for d, t in texts(MEDIUM) for i, x in items if x in normal(t)}
    assert exact <= set(got) and all(got[p] == 0 for p in exact)
    text = dict(texts(MEDIUM))
    item = dict(items)
    for d, i in set(got) - exact:
        assert edit_distance_inside(item[i], normal(text[d])) == got[d, i] <= RATE * len(item[i])


@pytest.mark.parametrize("seed", range(5))
def test_banded_alignment_equals_the_full_table(seed):
    r = random.Random(seed)
    item = prose(12, seed)
    text = prose(10, seed + 50) + edited(item, r.randint(0, 6), seed) + prose(10, seed + 90)
    k = 8
    low = max(0, text.find(item[:3]) - 15)
    got = aligned(codes(item), codes(text), 0, len(text) - len(item), k)
    want = edit_distance_inside(item, text)
    assert (got is None) == (want > k) and (got is None or got[0] == want)
    assert low >= 0


def test_lemma_keeps_a_stretch_with_a_full_budget_of_spread_edits():
    item = normal(prose(40, 3))
    k = budget(len(item))
    text = list(item)
    for n in range(k):
        text[int((n + 0.5) * len(item) / k)] = "#"
    assert Index([(1, item)]).matches(["lead " + "".join(text) + " tail"])[0][:3] == (0, 0, k)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    items = [(i, prose(20, i)) for i in range(7)]
    rows = [(i, prose(10, 50 + i) + " " + t) for i, t in items]
    a = sorted(map(tuple, leaks(docs_of(spark, rows), items_of(spark, items)).collect()))
    real = decontaminate.blocks
    monkeypatch.setattr(decontaminate, "blocks", lambda b, i, t: real(b, i, t, 200))
    assert a == sorted(map(tuple, leaks(docs_of(spark, rows), items_of(spark, items)).collect())) and len(a) == 7


def test_odd_and_empty_tables(spark):
    items = items_of(spark, [(1, None), (2, " \n"), (3, "one two three four five six"), (3, "one two three four five six"),
                             (4, "cat"), (None, "Same text in two sources.")])
    got = sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in leaks(docs_of(spark, ODD), items).collect())
    assert got == [(6, 3), (6, 3)] + [(7, 3)] * 4 + [(14, 0), (15, 0)]
    assert leaks(docs_of(spark, ODD).limit(0), items).count() == 0
    assert leaks(docs_of(spark, ODD), items.limit(0)).count() == 0


def test_short_items_are_looked_up_whole(spark):
    got = leaks(docs_of(spark, [(1, "a Cat sat"), (2, "a dog")]), items_of(spark, [(1, "cat")])).collect()
    assert [(r["doc_id"], r["start"], r["end"]) for r in got] == [(1, 2, 5)]
    assert np.array_equal(codes("aé"), [97, 233])


def test_hits_scattered_over_the_text_reach_no_band():
    item = normal(prose(30, 8))
    words = item.split(" ")
    pieces = [" ".join(words[i:i + 3]) + " " + "#" * 300 for i in range(0, 28, 3)]
    assert Index([(1, item)]).matches([" ".join(reversed(pieces))]) == []


def test_pieces_give_what_all_hits_at_once_give(monkeypatch):
    r = random.Random(4)
    items = [(0, "-" * 60), (1, "ab" * 40), (2, prose(20, 1)), (3, "-" * 30 + "x" + "-" * 30), (4, "=-" * 25)]
    rows = ["-" * 300, "ab" * 100 + "-" * 100, prose(30, 2) + " " + prose(20, 1), "", "".join(r.choice("-=x") for _ in range(400)),
            "-" * 40 + "y" + "-" * 40, "=-" * 60 + prose(10, 3)]
    index = Index([(i, normal(t)) for i, t in items])
    whole = sorted(index.matches(rows))
    for hits in (1, 50, 1000):
        monkeypatch.setattr(decontaminate, "HITS", hits)
        assert sorted(index.matches(rows)) == whole
    for t, i, distance, _, _ in whole:
        assert edit_distance_inside(normal(items[i][1]), normal(rows[t])) == distance
    missing = {(t, i) for t in range(len(rows)) for i in range(len(items))} - {m[:2] for m in whole}
    assert all(edit_distance_inside(normal(items[i][1]), normal(rows[t])) > budget(len(normal(items[i][1]))) for t, i in missing)


def test_a_megabyte_of_one_sign_stays_in_bounded_memory():
    import tracemalloc
    index = Index([(0, "-" * 400), (1, "-" * 200 + "x" + "-" * 199)])
    tracemalloc.start()
    found = index.matches(["-" * 1_000_000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [m[:3] for m in sorted(found)] == [(0, 0, 0), (0, 1, 1)] and found[0][3:] == (0, 400)
    assert peak < 500 << 20, peak


def test_search_needs_no_second_kind_of_python_workers(spark, monkeypatch):
    from pyspark import SparkContext

    item = prose(12, 3)
    docs = docs_of(spark, [(1, f"{prose(5, 4)} {item} {prose(5, 5)}"), (2, prose(30, 6)), (None, item), (3, None)])
    items, none = items_of(spark, [(5, item)]), items_of(spark, [])

    def refused(*_, **__):
        raise AssertionError("rows made by an RDD of Python objects")

    monkeypatch.setattr(SparkContext, "parallelize", refused)
    got = leaks(docs, items)
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got.collect()} == {(1, 5, 0), (None, 5, 0)}
    empty = leaks(docs, none)
    assert empty.collect() == [] and empty.dtypes == got.dtypes


def test_a_worker_holds_few_arrays_of_a_batch(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    held = {}

    class Rows:
        """What leaks gives to mapInArrow, kept."""

        def __init__(self, real):
            self.real = real

        def __getattr__(self, name):
            return getattr(self.real, name)

        def mapInArrow(self, search, schema):
            held["search"] = search
            return self.real.mapInArrow(search, schema)

    docs = docs_of(spark, [(1, "x")])
    real = type(docs).select
    monkeypatch.setattr(type(docs), "select", lambda self, *c: Rows(real(self, *c)))
    leaks(docs, items_of(spark, [(5, prose(12, 3))]))
    monkeypatch.undo()
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000), pa.int64()), pa.array([prose(150, 7)] * 4000)], ["doc_id", "text"])
    tracemalloc.start()
    for _ in held["search"](iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6, peak
