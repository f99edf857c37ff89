"""Operator 2: token ids in ORC files, sorted by document id.

Texts are range-partitioned and sorted by document id (the shuffle moves text,
which compresses better than ids), encoded in Arrow batches, and written as ORC
with light-weight integer run-length encoding, row indexes and a Bloom filter
on the document id.  Readers split files at stripes; an id filter is pushed to
the stripe statistics, the row index and the Bloom filter.

The tokenizer normalises and splits at white space without looking across it,
so a text's ids are the ids of its chunks between spaces and line feeds, in
order; nor does it join an ASCII letter with an ASCII mark after it.  Each
worker keeps the ids of chunks it has met in a bounded table, so that a frequent
word is encoded once.

Cases: a null or empty text holds the end id alone; a null id sorts first; rows
with equal ids are ordered by text; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starledger.llm.common import LOWER, shared_path, ship_package, slices, utf8_buffers, written

END_ID = 1
#: chunks kept by a worker and their bytes; beyond either only the first
#: CACHE_FIRST stay, among which are the frequent ones
CACHE_CHUNKS, CACHE_BYTES, CACHE_FIRST = 600_000, 24 << 20, 200_000
ORC = {"orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
       "orc.row.index.stride": "10000", "orc.stripe.size": str(64 << 20), "compression": "lz4"}

#: ASCII marks, before which a space may stand after a letter
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True
_MARK &= ~_ALPHA
_MARK[48:58] = False
_FLAT = np.arange(256, dtype=np.uint8)
_FLAT[10] = 32
#: stands alone between chunks while they are encoded together
_RULE = b"\x01"


#: words of a-z and the lower-case letters of Latin-1: normalising and splitting
#: leave them as they are, so the vocabulary's merges alone give their ids
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: the sign that stands for a byte in a byte-level vocabulary: itself if it is
#: printable, else the next one from 256 on
_SIGN = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _KEPT)}


class Encoder:
    """A tokenizer with the ids of the chunks met so far, as one flat array."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rule = self._ids(_RULE.decode())
        self.rule = rule[0] if len(rule) == 1 else None
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self._keep([])

    def _keep(self, chunks: list[bytes]) -> None:
        self.known: defaultdict[bytes, int] = defaultdict(None, zip(chunks, range(len(chunks))))
        self.known.default_factory = self.known.__len__
        self.ends = self.ends[:len(chunks) + 1].copy()
        self.flat, self.held = self.flat[:self.ends[-1]].copy(), sum(map(len, chunks))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, chunks: list[bytes]) -> None:
        plain = [_PLAIN.fullmatch(c) is not None for c in chunks]
        merge = self.tokenizer.model.tokenize
        ids = [[t.id for t in merge(c.decode() if c.isascii() else c.decode("latin-1").translate(_SIGN))] if p else None
               for c, p in zip(chunks, plain, strict=True)]
        if rest := [c for c, p in zip(chunks, plain, strict=True) if not p]:
            each = self._separate(rest)
            for i in (i for i, p in enumerate(plain) if not p):
                ids[i] = next(each)
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(i) for i in ids])])
        self.held += sum(map(len, chunks))

    def _separate(self, chunks: list[bytes]) -> Iterator[list[int]]:
        """The ids of each chunk, by encoding them together."""
        if self.rule is None or any(_RULE in c for c in chunks):
            yield from (self._ids(c.decode()) for c in chunks)
            return
        ids = np.asarray(self._ids((b" " + _RULE + b" ").join(chunks).decode()), np.int32)
        cuts = np.flatnonzero(ids == self.rule)
        for s, e in zip(np.r_[0, cuts + 1], np.r_[cuts, len(ids)], strict=True):
            yield ids[s:e].tolist()

    def encode(self, offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per row, all ids) of rows of UTF-8."""
        if len(self.known) > CACHE_CHUNKS or self.held > CACHE_BYTES:
            first = list(islice(self.known, CACHE_FIRST))
            self._keep(first if sum(map(len, first)) <= CACHE_BYTES // 2 else [])
        n = len(offsets) - 1
        special = bool(((raw[:-1] == 60) & (raw[1:] == 124)).any())  # "<|" may begin a special token: leave it whole
        # lower-casing A-Z early is safe unless a combining mark may follow
        raw = _FLAT[raw] if special or ((raw == 0xCC) | (raw == 0xCD)).any() else LOWER[_FLAT[raw]]
        gap = np.zeros(len(raw) + 1, np.int32)
        gap[1:-1] = _ALPHA[raw[:-1]] & _MARK[raw[1:]] & (not special)
        gap[offsets[1:-1]] = 0
        np.add.at(gap, offsets[1:-1], 1)                        # one space between rows
        shift = np.cumsum(gap, dtype=np.int32)
        text = np.full(len(raw) + shift[-1], 32, np.uint8)
        text[np.arange(len(raw), dtype=np.int32) + shift[:-1]] = raw
        begins = np.r_[0, offsets[1:-1] + shift[offsets[1:-1]]] if n else np.zeros(0, np.int64)
        spaces = np.zeros(len(text) + 1, np.int32)
        np.cumsum(text == 32, out=spaces[1:])
        # spaces inside a row; the one before the next row is the border
        last = np.r_[begins[1:] - 1, len(text)][:n]
        words = spaces[last] - spaces[begins] + 1
        before = len(self.known)
        chunks = text.tobytes().split(b" ")
        codes = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        if fresh := len(self.known) - before:
            self._learn(list(islice(reversed(self.known), fresh))[::-1])
        lengths = self.ends[codes + 1] - self.ends[codes]
        total = np.r_[0, np.cumsum(lengths)]
        ids = self.flat[np.arange(total[-1]) + np.repeat(self.ends[codes] - total[:-1], lengths)]
        return np.diff(total[np.r_[0, np.cumsum(words)]]), ids


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write (doc_id, ids) as ORC below ``path`` in ascending doc_id order:
    file after file, row after row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                lengths, ids = own.encode(*utf8_buffers(part.column("text")))
                ends = np.cumsum(lengths + 1)
                flat = np.full(int(ends[-1]), end_id, np.int32)
                inside = np.ones(len(flat), bool)
                inside[ends - 1] = False
                flat[inside] = ids
                column = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), column], ["doc_id", "ids"])

    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    (narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(encode, f"doc_id {kind}, ids array<int>").write.options(**ORC).orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ids; filters on doc_id are pushed into the ORC reader."""
    return spark.read.orc(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: start, n_tokens, ids_crc32, file.

    Start = ids in earlier splits + ids of earlier documents in the same split;
    one total per split comes to the driver (files are counted, not rows)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(ends[:-1], ends[1:], strict=True)]
            rest = [batch.column(c) for c in ("doc_id", "file", "block", "nr")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                                             ["doc_id", "file", "block", "nr", "n_tokens", "ids_crc32"])

    ship_package(spark)
    stored = read_tokens(spark, path)
    kind = stored.schema["doc_id"].dataType.simpleString()
    rows = written(
        stored.select("doc_id", F.col("_metadata.file_name").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nr"), "ids")
        .mapInArrow(digest, f"doc_id {kind}, file string, block long, nr long, n_tokens long, ids_crc32 long"),
        "token-index")
    # a split (file, block) is read by one task in file order, so nr orders its rows
    pieces = rows.groupBy("file", "block").agg(F.sum("n_tokens").alias("n")).collect()
    start, bases = 0, []
    for r in sorted(pieces, key=lambda r: (int(r["file"].split("-")[1]), r["file"], r["block"])):
        bases.append((r["file"], r["block"], start))
        start += r["n"]
    offsets = spark.createDataFrame(bases, "file string, block long, base long")
    order = Window.partitionBy("file", "block").orderBy("nr").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
            .join(offsets, ["file", "block"])
            .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "file"))


def tokenize(docs: DataFrame, tokenizer: str, *, path: str | None = None, **kw) -> DataFrame:
    spark = docs.sparkSession
    path = path or shared_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, **kw)
    return token_index(spark, path)
