"""Every stage of the corpus pipeline on its own input, against brute force."""
from collections import Counter

import pytest
from helpers import ODD, docs_of, near_duplicate_classes

import corpus_pipeline as P
from starledger.llm.common import table, written
from starledger.llm.decontaminate import normal
from starledger.llm.mixing import mix

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        after = written(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return {name: (a, b) for name, a, b in out}


def ids(df):
    return [r["doc_id"] for r in df.select("doc_id").collect()]


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns and after.schema == before.schema, name


def test_quality_keeps_clean_documents(spark, stages):
    before, after = stages["quality"]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    kept, seen = set(ids(after)), set(ids(before))
    good, junk = [d for d, q in labels.items() if q == 1 and d in seen], [d for d, q in labels.items() if q == 0 and d in seen]
    assert sum(d in kept for d in good) >= 0.99 * len(good) and sum(d in kept for d in junk) <= 0.05 * len(junk)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert sorted(ids(after)) == sorted({c for _, c in near_duplicate_classes(rows).values()})


def test_leaks_go_and_others_stay(spark, stages):
    before, after = stages["decontamination"]
    items = [normal(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    leaked = {r["doc_id"] for r in before.collect() if any(i in normal(r["text"]) for i in items)}
    kept = set(ids(after))
    assert leaked and not leaked & kept
    assert len(kept) >= before.count() - len(leaked) - 2        # at most a near copy or two of a passage


def test_mix_repeats_rows_as_the_operator_says(stages):
    before, after = stages["mixing"]
    want = {r["doc_id"]: r["repetitions"] for r in mix(before).collect() if r["repetitions"]}
    assert Counter(ids(after)) == Counter(want)
    text = {r["doc_id"]: r["text"] for r in before.collect()}
    assert all(text[r["doc_id"]] == r["text"] for r in after.collect())


def test_every_row_gets_a_shard(stages):
    before, after = stages["sharding"]
    assert Counter(ids(after)) == Counter(ids(before))
    count = Counter(r["shard"] for r in after.collect())
    assert max(count.values()) - min(count.values()) <= 1


def test_run_equals_the_stages(spark, stages):
    got = P.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["sharding"][1].collect()))


def test_odd_rows_and_extra_columns_pass_through(spark):
    docs = docs_of(spark, ODD)
    for _, stage in P.STAGES[:-1]:
        after = written(stage(spark, docs, SF), "test-odd")
        assert after.columns == docs.columns
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0 and empty.columns == docs.columns
    assert P.assign_shards(spark, docs, SF).count() == len(ODD)
    assert P.assign_shards(spark, docs.limit(0), SF).count() == 0


def test_unlike_texts_under_a_null_or_repeated_id_are_judged_apart(spark):
    leak = table(spark, SF, "benchmark").first()["text"]
    text = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdefg"]
    rows = [(None, t) for t in text[:3]] + [(4, text[3]), (4, text[4]), (5, text[5]), (5, text[5]), (6, text[0] + " end")]
    found = P.drop_near_duplicates(spark, docs_of(spark, rows), SF).collect()
    assert sorted(r["text"] for r in found) == sorted([text[1], text[2], text[3], text[4], text[5], text[0] + " end"])
    rows = [(None, text[0]), (None, leak), (4, text[1]), (4, leak + " " + text[2])]
    assert sorted(r["text"] for r in P.drop_leaks(spark, docs_of(spark, rows), SF).collect()) == sorted(text[:2])
    rows = [(None if i % 2 else 1, f"{t} {'more ' * i}", "en", f"src{i % 3}") for i, t in enumerate(text * 3)]
    rows += rows[:5]
    docs = docs_of(spark, rows)
    want = Counter()
    for r in mix(docs).collect():
        want[r["doc_id"], r["source"], r["size"]] += r["repetitions"]
    size = {(r[0], r[3], r[1]): len(r[1].split()) for r in rows}
    got = Counter((r["doc_id"], r["source"], size[r["doc_id"], r["source"], r["text"]])
                  for r in P.mix_sources(spark, docs, SF).collect())
    assert got == +want
