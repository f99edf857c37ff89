import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import MEDIUM, ODD, docs_of, texts
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starledger.llm.catalog import QUERIES
from starledger.llm.packing import borders, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
DIRECT = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*DIRECT.encode(text or "", add_special_tokens=False).ids, 1]


def held(rows, pieces, length=2048):
    """Every id in one piece, sequences without gaps, none to be padded."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == {d for d, _ in rows}
    want = defaultdict(list)
    for d, t in rows:
        ids = np.array(ids_of(t), "<u4")
        want[d].append(ids)
    for d, ps in by_doc.items():
        # documents that share an id: one piece list for each that starts at 0
        assert sum(p["length"] for p in ps) == sum(len(i) for i in want[d])
        if len(want[d]) == 1:
            at = 0
            for p in sorted(ps, key=lambda p: p["start"]):
                ids = want[d][0][p["start"]:p["start"] + p["length"]]
                assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(want[d][0])
                assert p["ids_crc32"] == zlib.crc32(ids.tobytes())
                at += p["length"]
            assert at == len(want[d][0])
    for s, ps in by_sequence.items():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= length and (at == length or at & (at - 1) == 0)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    total = sum(p["length"] for p in pieces)
    assert len(by_sequence) == total // length + bin(total % length).count("1")


def test_whole_table(spark):
    held(texts(MEDIUM), QUERIES["op12_cut_packing"](spark, MEDIUM).collect())


@pytest.mark.parametrize("n", [1, 4])
def test_odd_rows(spark, n):
    docs = docs_of(spark, ODD).repartition(n)
    packed = pack(docs, PATH)
    held([r[:2] for r in ODD], packed.boundaries().collect())
    one = {r["sequence_id"]: r for r in packed.sequences().collect()}
    flat = [i for s in sorted(one) for i in one[s]["ids"]]
    assert sorted(flat) == sorted(i for r in ODD for i in ids_of(r[1]))
    pieces = packed.pieces().collect()
    assert all(zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"] and len(p["ids"]) == p["length"] for p in pieces)
    for p in pieces:
        assert one[p["sequence_id"]]["ids"][p["offset"]:p["offset"] + p["length"]] == p["ids"]
        assert p["doc_id"] in one[p["sequence_id"]]["doc_ids"] and p["offset"] in one[p["sequence_id"]]["offsets"]


@pytest.mark.parametrize("length", [1, 4, 7])
def test_other_lengths(spark, length):
    rows = [(i, f"word {i} " * (i % 5)) for i in range(30)]
    pieces = pack(docs_of(spark, rows).repartition(3), PATH, length=length).boundaries().collect()
    assert sum(p["length"] for p in pieces) == sum(len(ids_of(t)) for _, t in rows)
    assert all(p["offset"] + p["length"] <= length for p in pieces)


def test_empty_table(spark):
    packed = pack(docs_of(spark, ODD).limit(0), PATH)
    assert packed.total == 0 and packed.boundaries().count() == 0 and packed.sequences().count() == 0


@given(st.integers(0, 10**6), st.integers(1, 5000))
def test_borders(total, length):
    b = borders(total, length)
    sizes = np.diff(b)
    assert b[0] == total - total % length and b[-1] == total
    assert all(s & (s - 1) == 0 and s < length for s in sizes.tolist()) and len(sizes) <= length.bit_length()


def test_plan_has_no_shuffle_of_ids(spark):
    plan = QUERIES["op12_cut_packing"](spark, MEDIUM)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
