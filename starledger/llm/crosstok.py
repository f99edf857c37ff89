"""Operator 11: aligning the tokens of two tokenizers over one text.

Tokens of both sides cover the same bytes (a space and the text).  Every token
points to the token that overlaps it and reaches farthest to the right; taking
the successor of the successor, for all tokens at once, doubles the steps until
every token points to the last token of its connected component.  Those last
tokens label the groups: between two of them both sides end on the same byte.

Within a group every token of one side is linked with every token of the other.
How many documents hold a pair of ids linked is counted over the whole corpus:
a task reduces the documents of a slice of text to distinct pairs, these are
summed per pair, and each slice gets back the counts of its own pairs.  What is
shuffled is a slice's distinct pairs and, per document, two or four bytes a
distinct pair; texts and tokens stay where they were read, and nothing is
broadcast.

Cases: null and empty texts, and texts that a tokenizer does not give back byte
by byte (one with U+2581 in it), have no tokens; special strings are plain text;
a long text is a slice of its own, and a group of many tokens is reduced to its
distinct ids before they are paired, in blocks; rows with a null or repeated id
are documents of their own; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import ship_package, slices, written

#: bytes of text whose documents share one table of distinct pairs
SLICE = 4 << 20
#: a group of more links than this is reduced to distinct ids first
DENSE = 256
#: links paired at a time
BLOCK = 4 << 20


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write a byte as the sign of its own number if
    that is printable, else as the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """A tokenizer as arrays: the bytes and the decimal digits of each id."""

    def __init__(self, entries: list[bytes]):
        self.size = len(entries)
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]]
        self.raw = np.frombuffer(b"".join(entries), np.uint8)
        # digits in a word of 8 bytes, with room for a mark after them
        digits = [str(i).encode() for i in range(self.size)]
        self.digits = np.frombuffer(b"".join(d.ljust(8, b"\0") for d in digits), "<u8")
        self.n_digits = np.array([len(d) for d in digits], np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths[ids]
        ends = np.cumsum(n)
        return self.raw[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - n), n)]


class ByteBPE(Side):
    """A byte-level BPE of the tokenizers library's format.  Its ids are ranks
    of merges, so the rank-based encoder gives the same ids, several times
    faster; ids of special tokens are never given."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = _byte_of_sign()
        special = {t["id"] for t in spec["added_tokens"]}
        entries = {i: bytes(byte[c] for c in token) for token, i in spec["model"]["vocab"].items() if i not in special}
        super().__init__([entries.get(i, b"") for i in range(max([*entries, *special]) + 1)])
        self.encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                          mergeable_ranks={e: i for i, e in entries.items()})

    def encode(self, texts: list[str]) -> list:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class PieceBPE(Side):
    """A sentencepiece model; it puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        hexes = re.compile(r"<0x([0-9A-F]{2})>")
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__([bytes([int(m[1], 16)]) if (m := hexes.fullmatch(p)) else p.replace("▁", " ").encode()
                          for p in pieces])

    def encode(self, texts: list[str]) -> list:
        return self.model.encode(texts, num_threads=1) if texts else []


def load(path: str) -> Side:
    return ByteBPE(path) if path.endswith(".json") else PieceBPE(path)


_SIDES: dict[str, Side] = {}


def side(path: str) -> Side:
    if path not in _SIDES:
        _SIDES[path] = load(path)
    return _SIDES[path]


@dataclass
class Aligned:
    """Documents' tokens: ids flat, ``*_at[d]:*_at[d + 1]`` those of document d;
    ``*_group`` numbers the groups through all documents, ``group_at`` per
    document."""
    a: np.ndarray
    b: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_at: np.ndarray


def _ended_before(ends: np.ndarray, size: int) -> np.ndarray:
    """For every byte border: how many of ``ends`` lie before it."""
    mark = np.zeros(size + 2, np.int32)
    mark[ends + 1] = 1
    return np.cumsum(mark, out=mark)


def last_of_component(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For the tokens of A, then of B, given by their ends over the same bytes:
    the token (of B, numbered after A) that ends the token's component."""
    n, m = len(a_end), len(b_end)
    if not n:
        return np.zeros(0, np.int64)
    size = int(a_end[-1])
    # the first token to end there or later holds the last byte before the end
    over_a = n + _ended_before(b_end, size)[a_end]
    at = _ended_before(a_end, size)[b_end]
    over_b = np.where(a_end[at] == b_end, n + np.arange(m), at)
    follow = np.concatenate([over_a, over_b])
    while True:
        further = follow[follow]
        if np.array_equal(further, follow):
            return follow
        follow = further


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.r_[0, np.cumsum(lengths)], np.fromiter(chain.from_iterable(lists), np.int64, int(lengths.sum()))


def _only(at: np.ndarray, ids: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(at)
    return np.r_[0, np.cumsum(np.where(keep, n, 0))], ids[np.repeat(keep, n)]


def align(texts: list[str | None], a: Side, b: Side) -> Aligned:
    plain = [t or "" for t in texts]
    (a_at, a_ids), (b_at, b_ids) = _flat(a.encode(plain)), _flat(b.encode(plain))
    spaced = [(" " + t).encode() for t in plain]
    size = np.fromiter(map(len, spaced), np.int64, len(spaced))

    def total(s: Side, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(s.lengths[ids])][at])

    keep = (size > 1) & (total(a, a_at, a_ids) == size) & (total(b, b_at, b_ids) == size)
    (a_at, a_ids), (b_at, b_ids) = _only(a_at, a_ids, keep), _only(b_at, b_ids, keep)
    raw = np.frombuffer(b"".join(s for s, k in zip(spaced, keep, strict=True) if k), np.uint8)
    odd = np.flatnonzero((raw != a.bytes_of(a_ids)) | (raw != b.bytes_of(b_ids)))
    if len(odd):
        ends = np.cumsum(np.where(keep, size, 0))
        keep[np.searchsorted(ends, odd, side="right")] = False
        (a_at, a_ids), (b_at, b_ids) = _only(a_at, a_ids, keep), _only(b_at, b_ids, keep)
    last = last_of_component(np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids])) - len(a_ids)
    ending = last[len(a_ids):] == np.arange(len(b_ids))
    number = np.cumsum(ending) - 1
    return Aligned(a_ids, b_ids, a_at, b_at, number[last[:len(a_ids)]], number[last[len(a_ids):]],
                   np.r_[0, np.cumsum(ending)][b_at])


def group_text(x: Aligned, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends per document) of ``a1,a2|b1;a3|b2,b3``."""
    n, m = len(x.a), len(x.b)
    groups = int(x.group_at[-1])
    p, q = np.bincount(x.a_group, minlength=groups), np.bincount(x.b_group, minlength=groups)
    cells, used, mark = np.zeros(n + m, "<u8"), np.zeros(n + m, np.uint8), np.full(n + m, ord(","), np.uint64)
    for s, ids, place in ((a, x.a, np.arange(n) + (np.cumsum(q) - q)[x.a_group]),
                          (b, x.b, np.arange(m) + np.cumsum(p)[x.b_group])):
        cells[place] = s.digits[ids]
        used[place] = s.n_digits[ids]
    closed = np.cumsum(p + q)
    mark[closed - q - 1], mark[closed - 1] = ord("|"), ord(";")
    cells |= mark << (used.astype(np.uint64) * np.uint64(8))
    ends = (x.a_at + x.b_at)[1:]
    used += 1
    used[ends[np.diff(x.a_at) > 0] - 1] -= 1                   # no mark after a document's last group
    text = cells.view(np.uint8).reshape(-1, 8)[np.arange(8, dtype=np.uint8) < used[:, None]]
    return text, np.r_[0, np.cumsum(used, dtype=np.int64)][ends]


def _sums(keys: np.ndarray, times: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their times (None: 1 each)."""
    if len(keys) == 0:
        return keys, np.zeros(0, np.int64)
    if times is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sums = np.diff(np.r_[first, len(keys)]) if times is None else np.add.reduceat(times, first)
    return keys[first], sums


def links(x: Aligned, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """(keys, times): document * pairs + a's id * b's size + b's id, in order,
    with the number of occurrence pairs linked."""
    groups = int(x.group_at[-1])
    p, q = np.bincount(x.a_group, minlength=groups), np.bincount(x.b_group, minlength=groups)
    dense = p * q > DENSE

    def entries(group: np.ndarray, ids: np.ndarray, size: int):
        big = dense[group] if dense.any() else None
        if big is None:
            return group, ids, np.ones(len(ids), np.int64)
        keys, n = _sums(group[big] * size + ids[big], None)
        g = np.r_[group[~big], keys // size]
        order = np.argsort(g, kind="stable")
        return g[order], np.r_[ids[~big], keys % size][order], np.r_[np.ones(int((~big).sum()), np.int64), n][order]

    ga, ia, na = entries(x.a_group, x.a, a.size)
    gb, ib, nb = entries(x.b_group, x.b, b.size)
    held = np.bincount(gb, minlength=groups)
    first = np.cumsum(held) - held
    doc = np.searchsorted(x.group_at, ga, side="right") - 1
    reps = held[ga]
    upto = np.r_[0, np.cumsum(reps)]
    found, at = [], 0
    while at < len(ga):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + BLOCK, side="right")) - 1)
        r = reps[at:to]
        mate = np.arange(upto[to] - upto[at]) - np.repeat(upto[at:to] - upto[at] - first[ga[at:to]], r)
        key = np.repeat((doc[at:to] * a.size + ia[at:to]) * b.size, r) + ib[mate]
        found.append(_sums(key, np.repeat(na[at:to], r) * nb[mate] if dense.any() else None))
        at = to
    if len(found) < 2:
        return found[0] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return _sums(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))


def aligned(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a_ids, b_ids and each token's group within its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = side(path_a), side(path_b)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                x = align(part.column("text").to_pylist(), a, b)
                columns = [part.column("doc_id")]
                for at, values in ((x.a_at, x.a), (x.b_at, x.b),
                                   (x.a_at, x.a_group - np.repeat(x.group_at[:-1], np.diff(x.a_at))),
                                   (x.b_at, x.b_group - np.repeat(x.group_at[:-1], np.diff(x.b_at)))):
                    columns.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a_ids", "b_ids", "a_groups", "b_groups"])

    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, a_groups array<int>, b_groups array<int>")


_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def _least(values: np.ndarray) -> np.ndarray:
    return values.astype("<u1" if values.max(initial=0) < 256 else "<u2" if values.max(initial=0) < 65536 else "<u4")


def _cut(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """``values`` cut at ``at`` as one binary value per document."""
    w = values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * w).astype(np.int32)), pa.py_buffer(values)])


def _scan(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document, and per slice of text one row of its distinct
    pairs (``pairs``, and ``docs``: documents of the slice that hold each).  A
    document names its pairs by their places there: ``places`` and ``times``,
    of one width within a slice."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["slice", "doc_id", *_FIGURES, "groups_sha256", "n_pairs", "places", "times", "pairs", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = side(path_a), side(path_b)
        pairs, number = a.size * b.size, TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                n = part.num_rows
                x = align(part.column("text").to_pylist(), a, b)
                text, ends = group_text(x, a, b)
                shas = [hashlib.sha256(text[s:e]).hexdigest() if e > s else ""
                        for s, e in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)]
                keys, times = links(x, a, b)
                at = np.searchsorted(keys, np.arange(n + 1) * pairs)
                known, place, held = np.unique(keys % pairs, return_inverse=True, return_counts=True)
                n_links = np.diff(np.r_[0, np.cumsum(times)][at])
                figures = [np.diff(x.a_at), np.diff(x.b_at), np.diff(x.group_at), n_links]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, number)), part.column("doc_id"), *[pa.array(f.astype(np.int64)) for f in figures],
                     pa.array(shas, pa.string()), pa.array(np.diff(at).astype(np.int32)), _cut(_least(place), at),
                     _cut(_least(times), at), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))], names)
                one = pa.array([0, len(known)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.nulls(1, part.column("doc_id").type),
                     *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()),
                     pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                     pa.ListArray.from_arrays(one, pa.array(known.astype(np.int64))),
                     pa.ListArray.from_arrays(one, pa.array(held.astype(np.int32)))], names)
                number += 1

    return docs.mapInArrow(run, f"slice long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
                                "groups_sha256 string, n_pairs int, places binary, times binary, "
                                "pairs array<long>, docs array<int>")


def alignment(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256."""
    ship_package(docs.sparkSession)
    scanned = written(_scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), path_a, path_b),
                      "alignment")
    size_b = side(path_b).size
    pairs = (scanned.where("pairs IS NOT NULL").select("slice", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "p"))
             .select("slice", "place", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs")))
    # an A id's window holds one row per id of B at most: the vocabularies bound it
    per_a = Window.partitionBy(F.floor(F.col("pair") / size_b))
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("best", F.col("n") == F.max("n").over(per_a))
    known = pairs.select("slice", "place", "pair").join(counts, "pair").select(F.col("slice").alias("of"), "place", "n", "best")
    rows = scanned.where("pairs IS NULL").select("slice", "doc_id", *_FIGURES, "groups_sha256", "n_pairs", "places", "times")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        n[place], best[place] = right.column("n").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        at = np.r_[0, np.cumsum(left.column("n_pairs").to_numpy().astype(np.int64))]

        def joined(name: str) -> np.ndarray:
            raw = b"".join(left.column(name).to_pylist())
            return np.frombuffer(raw, f"<u{len(raw) // at[-1]}").astype(np.int64) if at[-1] else np.zeros(0, np.int64)

        places, times = joined("places"), joined("times")
        sums = [np.diff(np.r_[0, np.cumsum(v[places] * times)][at]) for v in (best, n)]
        return pa.Table.from_arrays(
            [left.column("doc_id"), *[left.column(c) for c in _FIGURES], *[pa.array(s) for s in sums],
             left.column("groups_sha256")], ["doc_id", *_FIGURES, "n_best", "count_sum", "groups_sha256"])

    return rows.groupBy("slice").cogroup(known.groupBy("of")).applyInArrow(
        judge, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
