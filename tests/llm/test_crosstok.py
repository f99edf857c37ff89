import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from helpers import MEDIUM, ODD, docs_of, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starledger.llm import crosstok
from starledger.llm.catalog import QUERIES
from starledger.llm.crosstok import align, aligned, alignment, last_of_component, side

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DIRECT_A = Tokenizer.from_file(PATH_A)
DIRECT_A.encode_special_tokens = True
DIRECT_B = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _signs():
    keep = list(range(ord("!"), ord("~") + 1)) + list(range(0xA1, 0xAD)) + list(range(0xAE, 0x100))
    out, extra = {}, 0
    for b in range(256):
        out[chr(b if b in keep else 256 + extra)] = b
        extra += b not in keep
    return out


SIGNS = _signs()


def tokens(text):
    """[(id, bytes)] of both sides, or two empty lists."""
    if not text:
        return [], []
    a = [(i, bytes(SIGNS[c] for c in DIRECT_A.id_to_token(i))) for i in DIRECT_A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in DIRECT_B.encode(text):
        p = DIRECT_B.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def groups_of(text):
    a, b = tokens(text)
    ends = [np.cumsum([len(x) for _, x in s]).tolist() for s in (a, b)]
    out, s, t = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        i, j = ends[0].index(cut, s) + 1, ends[1].index(cut, t) + 1
        out.append(([x for x, _ in a[s:i]], [x for x, _ in b[t:j]]))
        s, t = i, j
    return out


def expected(rows):
    each = [(d, groups_of(t)) for d, t in rows]
    linked = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for _, g in each]
    held = Counter(p for c in linked for p in c)
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (d, g), c in zip(each, linked, strict=True):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((d, sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if held[p] == best[p[0]]), sum(held[p] * n for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def got(df):
    return sorted((tuple(r[c] for c in NAMES) for r in df.collect()), key=repr)


def test_whole_table(spark):
    assert got(QUERIES["op11_pointer_alignment"](spark, MEDIUM)) == sorted(expected(texts(MEDIUM)), key=repr)


SPECIAL = [(20, "a<|endoftext|>b <s> </s> <unk> <0x41>"), (21, "▁low line"), (22, "tab\there  two\n\n\nlines   "), (23, " "),
           (24, "ﬁ ligature ½ ℌ é"), (25, "​﻿zero"), (26, "İstanbul ΑΣ 　wide"), (20, "another text of id 20")]


def test_odd_rows(spark):
    rows = [r[:2] for r in ODD if r[0] != 12] + SPECIAL
    docs = docs_of(spark, ODD + SPECIAL).where("doc_id IS NULL OR doc_id <> 12")
    assert got(alignment(docs, PATH_A, PATH_B)) == sorted(expected(rows), key=repr)
    assert got(alignment(docs.repartition(5), PATH_A, PATH_B)) == sorted(expected(rows), key=repr)
    assert alignment(docs.limit(0), PATH_A, PATH_B).count() == 0


def test_a_text_whose_tokens_rarely_end_together():
    a, b = side(PATH_A), side(PATH_B)
    x = align(["ab" * 150_000], a, b)
    keys, times = crosstok.links(x, a, b)
    p, q = np.bincount(x.a_group), np.bincount(x.b_group)
    assert times.sum() == (p * q).sum() and len(keys) < 10_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbZ'stre \n\t\r.,!<|▁éß你12\U0001f600"), max_size=40), min_size=1, max_size=5))
def test_groups_are_cut_where_both_end(rows):
    x = align(rows, side(PATH_A), side(PATH_B))
    for d, t in enumerate(rows):
        g = groups_of(t)
        a, b = slice(*x.a_at[d:d + 2]), slice(*x.b_at[d:d + 2])
        assert x.a[a].tolist() == [i for ga, _ in g for i in ga] and x.b[b].tolist() == [i for _, gb in g for i in gb]
        base = x.group_at[d]
        assert (x.a_group[a] - base).tolist() == [k for k, (ga, _) in enumerate(g) for _ in ga]
        assert (x.b_group[b] - base).tolist() == [k for k, (_, gb) in enumerate(g) for _ in gb]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(1, 12), st.integers(1, 300))
def test_dense_groups_and_small_blocks(cut_a, cut_b, ids, block):
    """Links by the blocks and by distinct ids equal those of all pairs."""
    end = 61
    a_end, b_end = np.array(sorted(cut_a | {end})), np.array(sorted(cut_b | {end}))
    last = last_of_component(a_end, b_end) - len(a_end)
    number = np.cumsum(last[len(a_end):] == np.arange(len(b_end))) - 1
    ga, gb = number[last[:len(a_end)]], number[last[len(a_end):]]
    a, b = side(PATH_A), side(PATH_B)
    x = crosstok.Aligned(np.arange(len(a_end)) % ids, np.arange(len(b_end)) * 7 % ids, np.array([0, len(a_end)]),
                         np.array([0, len(b_end)]), ga, gb, np.array([0, number[-1] + 1]))
    want = Counter(int(i) * b.size + int(j) for i, g in zip(x.a, ga, strict=True) for j, h in zip(x.b, gb, strict=True) if g == h)
    kept = crosstok.DENSE, crosstok.BLOCK
    try:
        crosstok.DENSE, crosstok.BLOCK = 4, block
        keys, times = crosstok.links(x, a, b)
    finally:
        crosstok.DENSE, crosstok.BLOCK = kept
    assert dict(zip(keys.tolist(), times.tolist(), strict=True)) == want


def test_tokens_and_groups_as_rows(spark):
    r = aligned(docs_of(spark, [(1, "tokens here"), (2, None)]), PATH_A, PATH_B).orderBy("doc_id").collect()
    g = groups_of("tokens here")
    assert r[0]["a_ids"] == [i for ga, _ in g for i in ga] and r[0]["b_groups"] == [k for k, (_, gb) in enumerate(g) for _ in gb]
    assert r[1]["a_ids"] == [] and r[1]["b_groups"] == []
