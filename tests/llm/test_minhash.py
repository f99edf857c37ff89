import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import MEDIUM, ODD, docs_of, near_duplicate_classes, shingles, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from starledger.llm import minhash
from starledger.llm.common import table, utf8_buffers
from starledger.llm.components import components
from starledger.llm.minhash import BANDS, BINS, ROWS, band_keys, densified, near_duplicates
from starledger.llm.shingles import shingle_sets


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_whole_table_against_all_pairs(spark):
    out = near_duplicates(table(spark, MEDIUM, "documents")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == near_duplicate_classes(texts(MEDIUM))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def variants(n, edits, seed, size=120):
    r = random.Random(seed)
    base = [f"w{r.randrange(5000)}" for _ in range(size)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(edits):
            w[r.randrange(size)] = f"z{r.randrange(10**6)}"
        rows.append((seed * 10_000 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("edits", [1, 2, 3, 4])
def test_families_whose_members_are_not_all_alike(spark, edits):
    rows = variants(60, edits, edits)
    assert got(near_duplicates(docs_of(spark, rows))) == near_duplicate_classes(rows)


def test_chains_link_through_their_middle(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(100 - i, " ".join(words[10 * i:10 * i + 100])) for i in range(9)] + [(500, "other text here of six words")]
    assert got(near_duplicates(docs_of(spark, rows))) == near_duplicate_classes(rows)


def test_the_threshold_is_exact(spark):
    # 3 of 4 and 6 of 8 shingles shared: linked; 2 of 3: not
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "q r s t u v"), (4, "q r s t u v w")]
    assert got(near_duplicates(docs_of(spark, rows))) == {1: (3, 1), 2: (4, 1), 3: (2, 3), 4: (3, 4)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbB \n\té 1."), max_size=40), min_size=1, max_size=5))
def test_shingle_sets(rows):
    sets = shingle_sets(*utf8_buffers(pa.array(rows, pa.large_string())))
    want = [shingles(t) for t in rows]
    assert [len(s) for s in sets] == [len(w) for w in want]
    for i in range(len(rows)):
        for j in range(i):
            assert len(np.intersect1d(sets[i], sets[j])) == len(want[i] & want[j])


def test_densified_bins_match_at_the_rate_of_the_similarity():
    r = np.random.default_rng(1)
    share = []
    for size in (4, 20, 400):
        pool = r.integers(0, 2**63, (300, 2 * size)).astype(np.uint64)
        a = [np.unique(p[:size]) for p in pool]
        b = [np.unique(np.r_[p[:size * 3 // 4], p[size:size + size // 4]]) for p in pool]
        x, y = densified(a), densified(b)
        share.append((x == y).mean())
        assert x.shape == (300, BINS) and (x != 0).all()
        assert band_keys(x).shape == (300, BANDS) and ROWS * BANDS == BINS
    # intersection 3/4 of a set, union 5/4
    assert all(abs(s - 0.6) < 0.05 for s in share)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components(spark, edges):
    root = {n: n for e in edges for n in e}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {n: find(n) for a, b in edges if a != b for n in (a, b)}
    df = spark.createDataFrame(edges, "u long, v long")
    rows = components(df).collect()
    assert {r["node"]: r["component"] for r in rows} == want and len(rows) == len(want)


def test_odd_and_empty_tables(spark):
    out = near_duplicates(docs_of(spark, ODD)).collect()
    assert len(out) == len(ODD)
    by = {r["doc_id"]: r for r in out}
    for d in (1, 2, 3):
        assert (by[d]["n_shingles"], by[d]["component_id"], by[d]["kept"]) == (0, d, True)
    assert by[7]["component_id"] == 6 and by[11]["component_id"] == 10 and by[15]["component_id"] == 14
    assert by[4]["n_shingles"] == 1 and by[None]["kept"] and by[None]["component_id"] is None
    assert near_duplicates(docs_of(spark, ODD).limit(0)).count() == 0


def form_letters(n, mates, seed=0):
    """Texts of 100 shingles, 82 of them shared by all (similarity 0.695);
    ``mates`` share four more with the next (86 of 114: 0.754)."""
    r = random.Random(seed)
    form = " ".join(f"form{i}" for i in range(86))
    rows = []
    for i in range(n):
        pair = i // 2 if i < 2 * mates else None
        four = [f"pair{pair}x{j}" if pair is not None else f"own{i}x{j}" for j in range(4)]
        rows.append((i, " ".join([form, *four, *(f"tail{i}x{j}" for j in range(14))])))
    ids = r.sample(range(100_000), n)
    want = {ids[i]: (100, min(ids[i], ids[i ^ 1]) if i < 2 * mates else ids[i]) for i in range(n)}
    return [(ids[i], t) for i, t in rows], want


def test_form_letters_unlike_the_centre_find_their_mates(spark):
    rows, want = form_letters(2000, 400)
    assert got(near_duplicates(docs_of(spark, rows, extra=False))) == want


def test_form_letters_are_what_they_say():
    rows, want = form_letters(60, 20)
    assert near_duplicate_classes(rows) == want


def test_first_shingles_of_linked_sets_meet():
    for a in [*range(1, 90), 150, 333, 1000]:
        own = dict(minhash.prefixes(a))
        for b in range(-(-3 * a // 4), 4 * a // 3 + 1):
            o = -(-3 * (a + b) // 7)
            assert own[minhash.size_class(b)] >= a - o + 1
            assert dict(minhash.prefixes(b))[minhash.size_class(a)] >= b - o + 1


def test_unlike_texts_under_one_id_are_judged_apart(spark):
    a, b = [" ".join(f"{c}{i}" for i in range(60)) for c in "ab"]
    rows = [(1, a), (None, a + " more"), (None, b), (2, b + " more"), (3, "c d e f g h"), (3, "i j k l m n")]
    out = near_duplicates(docs_of(spark, rows)).collect()
    assert Counter((r["doc_id"], r["component_id"], r["kept"]) for r in out) == Counter(
        [(1, 1, True), (None, 1, False), (None, 2, False), (2, 2, True), (3, 3, True), (3, 3, True)])


def test_small_sets_that_link_share_a_bucket():
    """Of every size up to 64 and every partner that just links, whatever the hashes."""
    r = np.random.default_rng(5)
    for n in range(3, 65):
        for m in range(n, 100 * n // 75 + 1):
            shared = -(-75 * (n + m) // 175)
            if shared > n:
                continue
            for _ in range(12):
                h = r.integers(0, 2**64, n + m - shared, np.uint64)
                a, b = np.sort(h[:n]), np.sort(np.r_[h[:shared], h[n:]])
                assert len(b) == m and np.intersect1d(minhash.short_keys(a), minhash.short_keys(b)).size


def test_links_that_no_band_holds(spark):
    """Pairs of 3 and 4 shingles that share no band (found by trial) are linked."""
    r, rows = random.Random(11), []
    while len(rows) < 8:
        w = [f"w{r.randrange(10**6)}" for _ in range(4 * 4000 * 2)]
        pair = [(" ".join(w[8 * i:8 * i + 7]), " ".join(w[8 * i:8 * i + 8])) for i in range(4000)]
        flat = pa.array([t for p in pair for t in p])
        keys = band_keys(densified(shingle_sets(*utf8_buffers(flat))))
        none = ~(keys[0::2] == keys[1::2]).any(axis=1)
        rows += [(len(rows) + i, t) for i, t in enumerate(t for p, x in zip(pair, none, strict=True) if x for t in p)]
    assert got(near_duplicates(docs_of(spark, rows))) == near_duplicate_classes(rows)


def test_signatures_differ_in_no_more_bits_than_sets_in_shingles():
    r = np.random.default_rng(3)
    for n in (0, 1, 40, 300, 5000):
        for d in (0, 1, 17, 400):
            pool = np.unique(r.integers(0, 2**64, n + 2 * d, np.uint64))
            a, b = pool[:n + d], np.r_[pool[:n], pool[n + d:]]
            x, y = minhash.signature(a), minhash.signature(b)
            bits = int(np.unpackbits((x ^ y).view(np.uint8)).sum())
            assert len(x) == minhash.SIGN and bits <= len(np.setxor1d(a, b)) and bits % 2 == len(np.setxor1d(a, b)) % 2


def test_rounds_compare_no_texts_that_cannot_link(spark, monkeypatch):
    """A group whose members are all unlike each other but share buckets: only
    the stars' pairs reach the texts."""
    seen, whole = [], minhash._links
    monkeypatch.setattr(minhash, "_links", lambda pairs, texts: (seen.append(pairs.count()), whole(pairs, texts))[1])
    rows, want = form_letters(300, 40)
    assert got(near_duplicates(docs_of(spark, rows, extra=False))) == want
    assert sum(seen[2:]) <= 40
