"""Operator 4: removal of repeated passages by a distributed suffix sort on a
difference cover.

Every byte covered by a LENGTH-byte string that also starts earlier (in a
document of smaller id, or earlier in the same one) is removed; strings are
judged on the input, overlaps count, and matches never cross documents.

Suffixes need an order by their first LENGTH bytes only.  As in the
difference-cover algorithms, a cover of sampled positions is sorted by triples
first, names are refined level by level, the remaining suffixes are merged in
through the sampled one they run into, and neighbours in the order are compared.

* The cover.  A position is sampled when the hash of the GRAM bytes from there is
  the smallest (leftmost on ties) of some STRIDE consecutive ones; GRAM + STRIDE
  - 1 = LENGTH.  Two equal strings so have a sampled position at the same offset,
  which is what a difference cover gives; but the cover is taken from content, not
  from the position modulo a period, which samples 2.6 % of the positions instead
  of 12.3 % (9 of 73) and lets copies at any distance share their names.
* Triples.  A sampled position stands for the suffixes that run into it: a triple
  of what they have on the left, the gram, and what follows on the right.
  Positions are sorted by gram, triple and place.  A gram met once can't repeat;
  a triple met before is removed as a whole.
* Recursion on names.  Where one gram has several triples, the first of each goes
  to the next level: its suffixes in cells of CELL neighbours, again sorted as
  triples of left bytes, the LENGTH - CELL + 1 bytes they share, and right bytes.
* Merge.  Where a cell's name has several triples, the first of each puts its
  single suffixes into one order of LENGTH-byte names, and of neighbours with
  equal names all but the first are removed.

Every level is one shuffle and sort of narrow rows; a text moves only to where
its own rows are.  A hot gram or name is streamed in sorted order, not held.
Names are 64-bit hashes of the strings.

Cases: a null text is empty; texts shorter than LENGTH lose nothing; a null id
counts as the largest; texts that share an id are documents of their own, in the
order of their hashes; rows equal in both are one document, so neither is earlier
than the other, and get equal results; very long texts are worked through in pieces; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import mix64, powers, ship_package, slices, span_hashes, utf8_buffers, written

LENGTH, GRAM = 100, 28
STRIDE = LENGTH - GRAM + 1
CELL = 9
CORE = LENGTH - CELL + 1
#: at 16 bytes each, what a broadcast of ids may hold
BROADCAST_IDS = 2_000_000
#: bytes of text worked on at once
PIECE = 1 << 20
LAST_ID = (1 << 63) - 1
#: a text is named by its id and hash
OWNER = ["rid", "same"]
PLACE = [*OWNER, "at"]
_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD))


def gram_hashes(raw: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hashes of the ``size`` bytes from every position, put together from
    hashes of runs whose lengths are powers of two."""
    n = len(raw) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run, length, out, at = mix64(raw.astype(np.uint64) + _MUL[0]), 1, None, 0
    while True:
        if size & length:
            part = run[at:at + n]
            out = part.copy() if out is None else out * _MUL[1] + part
            at += length
        if at == size:
            return mix64(out)
        run = run[:-length] * _MUL[2] + run[length:]
        run ^= run >> np.uint64(32)
        length *= 2


def window_least(h: np.ndarray, width: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Smallest value of every ``width`` neighbours, and its leftmost place."""
    value, place, length = h, np.arange(len(h), dtype=np.int32), 1
    while length < width:
        step = min(length, width - length)
        n = len(value) - step
        left = value[:n] <= value[step:]
        place = np.where(left, place[:n], place[step:])
        value = np.where(left, value[:n], value[step:])
        length += step
    return value, place


def pieces(offsets: np.ndarray, raw: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, place of the first byte in that row, offsets, bytes) of whole
    rows together, or of a long row's overlapping parts."""
    if len(raw) <= 2 * PIECE:
        yield 0, 0, offsets, raw
        return
    for r, (s, e) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        for a in range(s, max(s + 1, e - LENGTH + 1), PIECE):
            part = raw[a:min(e, a + PIECE + LENGTH - 1)]
            yield r, int(a - s), np.array([0, len(part)]), part


def cover(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """The sampled positions of some rows: row, place, first and last suffix
    that run into it (places in ``raw``), gram hash."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    if len(raw) < LENGTH:
        return none
    value, place = window_least(gram_hashes(raw))
    starts = np.arange(len(value))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(value)]
    whole = starts + LENGTH <= offsets[1:][row]
    new = np.r_[True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])]
    # a run of suffixes ends where the place changes or the row's last whole one stands
    at = np.flatnonzero(new & whole)
    if not len(at):
        return none
    upto = np.r_[np.flatnonzero(new)[1:], len(value)][np.cumsum(new)[at] - 1] - 1
    last = np.minimum(upto, offsets[1:][row[at]] - LENGTH)
    return row[at], place[at].astype(np.int64), at, last, value[at]


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """name (the gram's), triple, rid, same (the text's hash), at (first suffix * 128 + number of
    suffixes), known: the triple stands earlier in the same piece of the batch.
    Known ones need no comparison, so they get names of their own and don't
    crowd the gram's task."""
    for batch in batches:
        for part in slices(batch, "text", PIECE):
            ids, hashes = part.column("rid").to_numpy(), part.column("same").to_numpy()
            for first, base, offsets, raw in pieces(*utf8_buffers(part.column("text"))):
                row, place, lo, hi, gram = cover(offsets, raw)
                # the triple's name also says where the gram stands in it
                triple = mix64(span_hashes(raw, lo, hi + LENGTH) + (place - lo).astype(np.uint64))
                rid, same, at = ids[row + first], hashes[row + first], (lo - offsets[row] + base) * 128 + (hi - lo + 1)
                order = np.lexsort((at, same, rid, triple, gram))
                new = np.r_[True, (gram[order][1:] != gram[order][:-1]) | (triple[order][1:] != triple[order][:-1])][:len(order)]
                head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
                known = np.zeros(len(order), bool)
                known[order] = (rid[order] != rid[head]) | (same[order] != same[head]) | (at[order] != at[head])
                own = mix64(rid.astype(np.uint64) + mix64(at.astype(np.uint64) + mix64(same.astype(np.uint64))))
                name = np.where(known, own, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array(triple.view(np.int64)), pa.array(rid), pa.array(same),
                     pa.array(at), pa.array(known)], ["name", "triple", "rid", "same", "at", "known"])


def _packed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, high: bool) -> np.ndarray:
    """Up to 8 bytes [start, end) as a long: the last byte lowest, or with
    ``high`` the first byte highest."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(CELL - 1):
        at = starts + i if high else ends - 1 - i
        inside = (at >= starts) & (at < ends)
        byte = raw[np.clip(at, 0, len(raw) - 1)].astype(np.uint64)
        out |= np.where(inside, byte, np.uint64(0)) << np.uint64(56 - 8 * i if high else 8 * i)
    return out.view(np.int64)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the wanted sampled positions, their suffixes in cells: name (of the
    CORE bytes shared), left and right bytes, rid, same, at (core's start * 256 +
    16 * fewest + most bytes to the left)."""
    for batch in batches:
        for part in slices(batch, "text", PIECE):
            rid, same, wanted = part.column("rid").to_numpy(), part.column("same").to_numpy(), part.column("wanted")
            ends, flat = wanted.offsets.to_numpy(), wanted.values.to_numpy()
            for first, base, offsets, raw in pieces(*utf8_buffers(part.column("text"))):
                row, place, lo, hi, _ = cover(offsets, raw)
                at = (lo - offsets[row] + base) * 128 + hi - lo + 1
                ask = [flat[ends[r + first]:ends[r + first + 1]] for r in range(len(offsets) - 1)]
                owner = np.repeat(np.arange(len(ask)), [len(a) for a in ask])
                key = np.stack([np.r_[row, owner], np.r_[at, np.concatenate(ask) if ask else []].astype(np.int64)])
                _, code = np.unique(key, axis=1, return_inverse=True)
                code = code.reshape(-1)
                keep = np.isin(code[:len(row)], code[len(row):])
                row, place, lo, hi = row[keep], place[keep], lo[keep], hi[keep]
                near, far = place - hi, place - lo                    # least and most bytes before the gram
                low, high = near // CELL, far // CELL
                n = high - low + 1
                of = np.repeat(np.arange(len(row)), n)
                cell = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                start = place[of] - CELL * cell
                fewest, most = np.maximum(near[of] - CELL * cell, 0), np.minimum(far[of] - CELL * cell, CELL - 1)
                name = mix64(span_hashes(raw, start, start + CORE) + cell.astype(np.uint64))
                left = _packed(raw, start - most, start, False)
                right = _packed(raw, start + CORE, start + LENGTH - fewest, True)
                own = (start - offsets[row[of]] + base) * 256 + 16 * fewest + most
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array(left), pa.array(right), pa.array(rid[row[of] + first]),
                     pa.array(same[row[of] + first]), pa.array(own)], ["name", "left", "right", "rid", "same", "at"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n_removed, n_spans and kept_sha256 of texts with their removed runs."""
    for batch in batches:
        for part in slices(batch, "text", PIECE):
            offsets, raw = utf8_buffers(part.column("text"))
            runs = part.column("runs")
            ends, flat = runs.offsets.to_numpy(), runs.values
            s, e = flat.field("s").to_numpy(), flat.field("e").to_numpy()
            removed, spans, digest = [], [], []
            for r in range(part.num_rows):
                text = raw[offsets[r]:offsets[r + 1]]
                change = np.zeros(len(text) + 1, np.int32)
                np.add.at(change, s[ends[r]:ends[r + 1]], 1)
                np.add.at(change, e[ends[r]:ends[r + 1]], -1)
                gone = np.cumsum(change)[:-1] > 0
                removed.append(int(gone.sum()))
                spans.append(int((gone & ~np.r_[False, gone[:-1]]).sum()))
                digest.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("rid"), part.column("same"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digest, pa.string())], ["rid", "same", "n_removed", "n_spans", "kept_sha256"])


def _compared(rows: DataFrame, triple: list[str]) -> DataFrame:
    """Rows sorted by name, triple and place, and compared with their
    neighbours: ``again`` (the triple was met before) and ``several`` (the name
    has more than one triple)."""
    same = Window.partitionBy("name", *triple).orderBy(*PLACE)
    name = Window.partitionBy("name")
    whole = F.struct(*triple)
    return (rows.repartition("name").withColumn("head", F.first(F.struct(*PLACE)).over(same))
            .withColumn("again", F.col("head") != F.struct(*PLACE))
            .withColumn("several", F.min(whole).over(name) != F.max(whole).over(name)).drop("head"))


def _own_texts(texts: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (one per rid and text) with their texts.  Where the ids are few enough to
    be broadcast, texts that have no row are left out before the shuffle."""
    rows = written(rows, name)
    if rows.count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(rows.select(*OWNER)), OWNER, "left_semi")
    return texts.join(rows, OWNER)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("rid"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
                            "rid", F.xxhash64("text").alias("same"), "text")
    grams = _compared(texts.mapInArrow(_triples, "name long, triple long, rid long, same long, at long, known boolean"),
                      ["triple"]).withColumn("again", F.col("again") | F.col("known"))
    grams = written(grams.where("again OR several").select(*PLACE, "again"), "grams")
    start, number = F.shiftright("at", 7), F.col("at").bitwiseAND(127)
    by_gram = grams.where("again").select(*OWNER, start.alias("s"), (start + number + LENGTH - 1).alias("e"))

    wanted = grams.where("NOT again").groupBy(*OWNER).agg(F.collect_list("at").alias("wanted"))
    cells = _compared(_own_texts(texts, wanted, "wanted").mapInArrow(
        _cells, "name long, left long, right long, rid long, same long, at long")
        .withColumn("edge", F.col("at").bitwiseAND(255)), ["left", "right", "edge"])
    cells = written(cells.where("again OR several"), "cells")
    core, fewest, most = F.shiftright("at", 8), F.shiftright(F.col("edge"), 4), F.col("edge").bitwiseAND(15)
    by_cell = cells.where("again").select(*OWNER, (core - most).alias("s"), (core + LENGTH - fewest).alias("e"))

    # single suffixes: k bytes on the left of the core, CELL - 1 - k on its right
    k = F.col("k")
    bits = lambda n: F.when(n >= 64, F.lit(-1).cast("long")).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("long"), n) - 1)
    lefts = F.col("left").bitwiseAND(bits(8 * k))
    rights = F.when(8 * k >= 64, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftrightunsigned", F.col("right"), 8 * k))
    singles = (cells.where("NOT again").withColumn("k", F.explode(F.sequence(fewest, most)))
               .select(F.xxhash64("name", "k", lefts, rights).alias("name"), *OWNER, (core - k).alias("at")))
    first = Window.partitionBy("name").orderBy(*PLACE)
    singles = (singles.withColumn("head", F.first(F.struct(*PLACE)).over(first))
               .where(F.col("head") != F.struct(*PLACE)))
    by_single = singles.select(*OWNER, F.col("at").alias("s"), (F.col("at") + LENGTH).alias("e"))

    runs = by_gram.unionByName(by_cell).unionByName(by_single).groupBy(*OWNER).agg(
        F.collect_list(F.struct("s", "e")).alias("runs"))
    cut = (_own_texts(texts, runs, "runs")
           .mapInArrow(_kept, "rid long, same long, n_removed long, n_spans long, kept_sha256 string").distinct())
    whole = texts.select(*OWNER, F.octet_length("text").cast("long").alias("n_bytes"),
                         F.sha2("text", 256).alias("whole"))
    return whole.join(cut, OWNER, "left").select(
        F.when(F.col("rid") != LAST_ID, F.col("rid")).alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
