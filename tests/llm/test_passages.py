import numpy as np
from helpers import MEDIUM, ODD, docs_of, repeats_removed, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from starledger.llm import passages
from starledger.llm.common import table
from starledger.llm.passages import GRAM, LENGTH, STRIDE, cover, gram_hashes, remove_repeats, window_least


def got(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def test_whole_table_against_brute_force(spark):
    assert got(remove_repeats(table(spark, MEDIUM, "documents"))) == repeats_removed(texts(MEDIUM))


def passage(n, seed):
    return "".join(np.random.default_rng(seed).choice(list("abcdefghij kl"), n))


def test_edges_of_matches(spark):
    p = passage(400, 1)
    rows = [(1, p), (2, "x" + p[50:150] + "y"), (3, "x" + p[50:149] + "y"), (4, p[:100]), (5, p[300:] + p[:100]),
            (6, passage(30, 2) + p[120:300] + passage(30, 3)), (7, passage(30, 2) + p[120:299] + passage(31, 4)),
            (8, p[:200] + "!" + p[200:]), (9, p[:250] + "?" + p[250:]), (10, p)]
    assert got(remove_repeats(docs_of(spark, rows))) == repeats_removed(rows)


def test_repeats_within_one_text_and_periodic_texts(spark):
    p = passage(150, 5)
    rows = [(1, p + p + p), (2, "ab" * 300), (3, "a" * 99), (4, "a" * 100), (5, "a" * 250), (6, "ab" * 49 + "a"),
            (7, "Und " * 200 + p), (8, "é" * 120)]
    assert got(remove_repeats(docs_of(spark, rows))) == repeats_removed(rows)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 260), st.integers(0, 260), st.integers(0, 3)),
                min_size=1, max_size=12))
def test_random_cuts_of_shared_passages(spark, cuts):
    pool = [passage(260, s) for s in range(4)]
    rows = [(i, pool[a][min(s, e):max(s, e)] + pool[b][:e] + ("#" * (a - b) if a > b else ""))
            for i, (a, s, e, b) in enumerate(cuts)]
    assert got(remove_repeats(docs_of(spark, rows, extra=False))) == repeats_removed(rows)


def test_long_texts_in_pieces(spark, monkeypatch):
    offsets, raw = np.array([0, 5, 5 + 40_000, 5 + 40_000 + 150]), np.random.default_rng(0).integers(97, 105, 40_155).astype(np.uint8)
    whole = set()
    for r, base, off, part in passages.pieces(offsets, raw):
        row, _, lo, hi, _ = cover(off, part)
        whole |= {(int(row[i]) + r, int(lo[i] - off[row[i]]) + base + k) for i in range(len(lo)) for k in range(hi[i] - lo[i] + 1)}
    monkeypatch.setattr(passages, "PIECE", 3_000)
    cut = set()
    for r, base, off, part in passages.pieces(offsets, raw):
        row, _, lo, hi, _ = cover(off, part)
        cut |= {(int(row[i]) + r, int(lo[i] - off[row[i]]) + base + k) for i in range(len(lo)) for k in range(hi[i] - lo[i] + 1)}
    every = {(1, i) for i in range(40_000 - 99)} | {(2, i) for i in range(51)}
    assert whole == cut == every


def test_cover_samples_equal_strings_at_the_same_offset():
    rng = np.random.default_rng(3)
    s = rng.integers(0, 4, LENGTH).astype(np.uint8)
    offsets = set()
    for _ in range(20):
        raw = np.concatenate([rng.integers(0, 4, 80).astype(np.uint8), s, rng.integers(0, 4, 80).astype(np.uint8)])
        _, place, lo, hi, _ = cover(np.array([0, len(raw)]), raw)
        i = int(np.flatnonzero((lo <= 80) & (hi >= 80))[0])
        offsets.add(int(place[i]) - 80)
    assert len(offsets) == 1 and 0 <= offsets.pop() < STRIDE


def test_gram_hashes_and_least():
    raw = np.frombuffer(b"abcabcabcabcabcabcabcabcabcabcabcabcabcabc", np.uint8)
    h = gram_hashes(raw)
    assert len(h) == len(raw) - GRAM + 1 and h[0] == h[3] != h[1]
    v = np.array([5, 3, 3, 9, 1, 7], np.uint64)
    least, place = window_least(v, 3)
    assert least.tolist() == [3, 3, 1, 1] and place.tolist() == [1, 1, 4, 4]


def test_odd_rows(spark):
    out = remove_repeats(docs_of(spark, ODD)).collect()
    assert len(out) == len(ODD)
    by = {r["doc_id"]: r for r in out}
    assert by[1]["n_bytes"] == by[2]["n_bytes"] == 0 and by[1]["kept_sha256"] == by[2]["kept_sha256"]
    assert by[11]["n_removed"] == by[11]["n_bytes"] and by[11]["n_spans"] == 1      # the copy of 10
    assert by[12]["n_removed"] == 300_000 - 1 and by[12]["n_spans"] == 1            # one letter over and over
    unique = [(r[0], r[1]) for r in ODD if r[0] is not None and r[0] != 7]
    want = repeats_removed(unique)
    assert {d: tuple(by[d])[1:] for d in want} == want
    assert remove_repeats(docs_of(spark, ODD).limit(0)).count() == 0


def test_rows_that_share_an_id_and_place_do_not_remove_each_other(spark):
    p = passage(300, 9)
    rows = [(1, p), (1, p), (2, p[100:])]
    out = sorted(tuple(r) for r in remove_repeats(docs_of(spark, rows)).collect())
    assert [r[2] for r in out] == [0, 0, 200]


def test_unlike_texts_under_one_id_are_documents_of_their_own(spark):
    p, q = passage(300, 9), passage(150, 10)
    # the long text of id 5 repeats beyond the end of the short one; the null-id texts are equal at the same place
    rows = [(1, p), (5, passage(400, 11) + p), (5, q), (None, passage(200, 12)), (None, passage(200, 12) + passage(90, 13))]
    out = {r["n_bytes"]: (r["doc_id"], r["n_removed"], r["n_spans"]) for r in remove_repeats(docs_of(spark, rows)).collect()}
    removed = {n: out[n] for n in (300, 700, 150)}
    assert removed == {300: (1, 0, 0), 700: (5, 300, 1), 150: (5, 0, 0)}
    assert out[200][0] is None and sorted([out[200][1], out[290][1]]) == [0, 200]
