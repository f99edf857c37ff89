"""Operator 12: packing documents into sequences by concatenating and cutting.

Pass one encodes every document where it was read, closes it with the end id and
writes the ids with the number of ids before them in the same task.  The tasks'
totals (one row a task) are summed to global offsets.  Pass two cuts the one long
string of ids at every ``length``-th place and gives a boundary record for each
piece of a document.  Nothing is shuffled: texts and ids stay in their task, and
what is broadcast is one row for each task of pass one.

What is left after the last full sequence is cut at the powers of two of its
binary digits.  A sequence of such a length needs no padding, so no sequence is
padded at all.

Cases: a null or empty text holds the end id alone; a text longer than a
sequence spans several; rows with a null or repeated id are documents of their
own; an empty table gives no rows; other columns are ignored.  Documents are
packed in the order of their partitions: another partitioning of the input gives
another packing, with the same pieces' contents when joined.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm.common import shared_path, ship_package, slices, utf8_buffers
from starledger.llm.tokenfiles import END_ID, encoder

LENGTH = 2048


def encoded(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = END_ID, id_col: str = "doc_id",
            text_col: str = "text") -> None:
    """Pass one: task, before (ids of earlier documents of the task), n, doc_id,
    ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                lengths, ids = own.encode(*utf8_buffers(part.column("text")))
                at = np.r_[0, np.cumsum(lengths + 1)]
                flat = np.full(int(at[-1]), end_id, np.int32)
                inside = np.ones(len(flat), bool)
                inside[at[1:] - 1] = False
                flat[inside] = ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(part.num_rows, task, np.int32)), pa.array(before + at[:-1]),
                     pa.array(lengths.astype(np.int64) + 1), part.column("doc_id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat))],
                    ["task", "before", "n", "doc_id", "ids"])
                before += int(at[-1])

    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    ids = narrow.mapInArrow(run, f"task int, before long, n long, doc_id {kind}, ids array<int>")
    ids.write.option("compression", "lz4").orc(path)


def borders(total: int, length: int) -> list[int]:
    """First places of the sequences behind the last full one, and the end."""
    out, left = [total - total % length], total % length
    while left:
        out.append(out[-1] + (1 << (left.bit_length() - 1)))
        left = total - out[-1]
    return out


@dataclass
class Packed:
    """A packed corpus: the ids in files, and where its sequences begin."""
    spark: SparkSession
    path: str
    bases: list[tuple[int, int]]      # of each task of pass one: the ids of all tasks before it
    total: int
    length: int

    def _cut(self, with_ids: bool) -> DataFrame:
        length, rest = self.length, np.array(borders(self.total, self.length))
        full = int(rest[0]) // length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column("ids")
                at, flat = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy(zero_copy_only=False)
                first = batch.column("base").to_numpy() + batch.column("before").to_numpy()
                n = np.diff(at)
                last = first + n - 1
                # the sequence of a place: by division, or behind the last full one by its border
                of = [np.where(p < rest[0], p // length, full - 1 + np.searchsorted(rest, p, side="right")) for p in (first, last)]
                pieces = of[1] - of[0] + 1
                row = np.repeat(np.arange(len(n)), pieces)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                sequence = np.repeat(of[0], pieces) + nth
                opens = np.where(sequence < full, sequence * length, rest[np.clip(sequence - full, 0, len(rest) - 1)])
                closes = np.where(sequence < full, opens + length, rest[np.clip(sequence - full + 1, 0, len(rest) - 1)])
                begin, end = np.maximum(opens, first[row]), np.minimum(closes, last[row] + 1)
                cut = at[row] + begin - first[row]
                raw = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(cut.tolist(), (cut + end - begin).tolist(), strict=True)]
                columns = [batch.column("doc_id").take(pa.array(row)), pa.array(begin - first[row]), pa.array(end - begin),
                           pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(sequence), pa.array(begin - opens)]
                if with_ids:     # a batch's pieces follow each other without a gap
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[cut, at[-1]].astype(np.int32)), column.values))
                yield pa.RecordBatch.from_arrays(columns, names)

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
        stored = self.spark.read.orc(self.path)
        kind = stored.schema["doc_id"].dataType.simpleString()
        placed = stored.join(F.broadcast(self.spark.createDataFrame(self.bases, "task int, base long")), "task")
        ship_package(self.spark)
        return placed.select("doc_id", "base", "before", "ids").mapInArrow(
            run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
                 + (", ids array<int>" if with_ids else ""))

    def boundaries(self) -> DataFrame:
        """A record for each piece of a document: doc_id, start, length,
        ids_crc32, doc_tokens, sequence_id, offset."""
        return self._cut(False)

    def pieces(self) -> DataFrame:
        """The boundary records with their ids."""
        return self._cut(True)

    def sequences(self) -> DataFrame:
        """sequence_id, ids, doc_ids and the offsets where their pieces begin."""
        parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))        # at most ``length`` of them
        return (self.pieces().groupBy("sequence_id").agg(parts.alias("p"))
                .select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"),
                        F.col("p.offset").alias("offsets")))


def pack(docs: DataFrame, tokenizer: str, *, length: int = LENGTH, path: str | None = None, **kw) -> Packed:
    spark = docs.sparkSession
    path = path or shared_path(spark, "packed")
    encoded(docs, path, tokenizer, **kw)
    bases, total = [], 0
    # one row for each task of pass one, 16 bytes each: the input's splits bound them
    for r in spark.read.orc(path).groupBy("task").agg(F.sum("n").alias("n")).orderBy("task").collect():
        bases.append((r["task"], total))
        total += r["n"]
    return Packed(spark, path, bases, total, length)
