"""Operator 9: benchmark decontamination by q-gram lemma filtering.

A text leaks a benchmark item when some stretch of it is within the item's edit
budget k = RATE * length (edits: insert, delete, replace a character).  Both
sides are compared lower-cased, with runs of white space as one space.

1. Filter: such a stretch shares at least m - Q + 1 - k * Q of the item's
   character q-grams (m its length), on diagonals (text position - item
   position) at most k apart.  Hits are counted in bands of 2 * (k + 1)
   diagonals that start every k + 1, so every k + 1 neighbouring diagonals lie
   within one band; bands that reach the bound are kept.
2. Verification: a banded semi-global alignment of the item with the stretch of
   text around the band, which yields the smallest distance.

The documents are scanned once per block of benchmark items and never
shuffled.  A block holds at most ``BLOCK_CHARS`` characters, which bounds what
is sent to the executors; a larger benchmark takes more scans.

Where k * Q + Q > m the budget is lowered to what the lemma can prove,
floor((m - Q) / Q); an item shorter than Q is looked up as a plain substring.

Cases: periodic texts (rules, dotted lines) share each q-gram with many places of
an item: beyond ``HITS`` such hits of a slice they are counted in pieces, so memory
is bounded whatever a text's length; null or blank items match nothing; repeated items each report; null and
empty texts match nothing; ties between bands go to the smallest start; a null
doc_id or item_id is carried as null; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import ship_package, slices

Q = 8
RATE = 0.1
BLOCK_CHARS = 4_000_000
_FILTER_BITS = 22
#: pairs of text and item counted at once
_CELLS = 1 << 22
#: bytes of text searched at once
PART = 1 << 18
#: shared q-grams (text position, item position) held at once
HITS = 1 << 22


#: white space of ``str.isspace``, and NUL
_BLANK = np.array([c == 0 or chr(c).isspace() for c in range(0x3001)])


def normal(text: str | None) -> str:
    return re.sub(r"[\s\0]+", " ", text.lower()).strip(" ") if text else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def normal_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ends, code points) of the normalised texts, a NUL after each."""
    joined = codes("\0".join([t.replace("\0", " ") if "\0" in t else t for t in texts]).lower() + "\0")
    blank = _BLANK[np.minimum(joined, 0x3000)] & (joined <= 0x3000)
    border = joined == 0
    plain = np.where(blank & ~border, np.uint32(32), joined)
    # blanks after a blank or a border go, and so does one before a border
    keep = ~blank | border
    keep[1:] |= ~blank[:-1]
    keep[0] |= not blank[0]
    plain = plain[keep]
    end = plain == 0
    plain = plain[~((plain == 32) & np.r_[end[1:], True])]
    return np.flatnonzero(plain == 0), plain


def grams(c: np.ndarray, q: int = Q) -> np.ndarray:
    """32-bit hashes of the q-grams that start at every position."""
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    run, length, out, at = c * np.uint32(0x9E3779B1), 1, None, 0
    while at < q:
        if q & length:
            part = run[at:at + n]
            out = part.copy() if out is None else out * np.uint32(0x85EBCA6B) + part
            at += length
        if at < q:
            run = run[:-length] * np.uint32(0xC2B2AE35) + run[length:]
            run ^= run >> np.uint32(15)
            length *= 2
    out *= np.uint32(0x27D4EB2F)
    return out ^ (out >> np.uint32(16))


def budget(m: int, rate: float = RATE, q: int = Q) -> int:
    return max(0, min(int(rate * m), (m - q) // q))


def _swept(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int] | None:
    """(distance, end) of the best alignment of the whole item that starts
    anywhere in ``text`` and stays on the diagonals low .. high; the first end on
    ties.  Outside the text stand characters that equal none, which costs as much
    as leaving out the item's."""
    m, n, width = len(item), len(text), high - low + 1
    held = np.zeros(m + width, np.uint32)
    first, last = max(0, low), min(n, m + high)
    if last > first:
        held[first - low:last - low] = text[first:last]
    slope = np.arange(width)
    cost = np.zeros(width, np.int64)
    for i in range(m):
        step = cost + (held[i:i + width] != item[i])          # match or replace: the same diagonal
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)       # leave out the item's: from the next diagonal
        cost = np.minimum.accumulate(step - slope) + slope    # skip the text's: from any diagonal before
        if not i & 15 and cost.min() > k:
            return None
    best = int(cost.argmin())
    return (int(cost[best]), min(max(m + low + best, 0), n)) if cost[best] <= k else None


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the best banded alignment of the whole item
    inside ``text`` on the diagonals low - k .. high + k, if its distance is at
    most k."""
    if (found := _swept(item, text, low - k, high + k, k)) is None:
        return None
    distance, end = found
    # the same alignment backwards, from its end: the longest start on ties
    back = text[max(0, end - len(item) - k):end][::-1]
    m, cost = len(item), np.arange(len(back) + 1)
    slope = cost.copy()
    for i in range(m):
        step = cost + 1
        step[1:] = np.minimum(step[1:], cost[:-1] + (back != item[m - 1 - i]))
        cost = np.minimum.accumulate(step - slope) + slope
    return distance, end - int(cost.argmin()), end


class _Counts:
    """How often each key was added; what is held grows with distinct keys."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        if len(self.parts) > 8:
            self.parts = [self.all()]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        keys, where = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([n for _, n in self.parts]), len(keys)).astype(np.int64)


class Index:
    """The q-grams of one block of items, with a bit filter in front."""

    def __init__(self, items: list[tuple[object, str]]):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.codes = [codes(t) for t in self.texts]
        self.bytes = [c.tobytes() for c in self.codes]
        self.budgets = np.array([budget(len(c)) for c in self.codes], np.int64)
        lengths = np.array([len(c) for c in self.codes], np.int64)
        self.least = lengths - Q + 1 - self.budgets * Q
        self.short = [i for i, n in enumerate(lengths) if n < Q]
        h = [grams(c) for c in self.codes]
        item = np.repeat(np.arange(len(items)), [len(x) for x in h])
        at = np.concatenate([np.arange(len(x)) for x in h]) if h else np.zeros(0, np.int64)
        flat = np.concatenate(h) if h else np.zeros(0, np.uint32)
        order = np.argsort(flat, kind="stable")
        self.hash, self.item, self.at = flat[order], item[order], at[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.hash >> np.uint32(32 - _FILTER_BITS)] = True

    def ranges(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text positions whose q-gram some item holds: (position, first place
        among the items' q-grams, number of places)."""
        p = np.flatnonzero(self.filter[h >> np.uint32(32 - _FILTER_BITS)])
        lo = np.searchsorted(self.hash, h[p], "left")
        found = self.hash[np.minimum(lo, len(self.hash) - 1)] == h[p] if len(self.hash) else np.zeros(0, bool)
        p, lo = p[found], lo[found]
        return p, lo, np.searchsorted(self.hash, h[p], "right") - lo

    def hits(self, p: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text position, item, item position) of every shared q-gram."""
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return np.repeat(p, n), self.item[k], self.at[k]

    def bands_by_pieces(self, p: np.ndarray, lo: np.ndarray, n: np.ndarray, ends: np.ndarray, begin: np.ndarray,
                        size: int) -> np.ndarray:
        """(text, item, band) that reach the bound, for texts so periodic that
        their hits don't fit: each piece of them is reduced to counts, first per
        (text, item), then per band of the pairs that can reach it."""
        upto, cuts = np.cumsum(n), [0]
        while cuts[-1] < len(p):
            done = upto[cuts[-1] - 1] if cuts[-1] else 0
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(upto, done + HITS, side="right"))))
        items, pairs, bands = len(self.ids), _Counts(), _Counts()
        for a, b in pairwise(cuts):
            pos, item, _ = self.hits(p[a:b], lo[a:b], n[a:b])
            pairs.add(np.searchsorted(ends, pos) * items + item)
        pair, count = pairs.all()
        pair = pair[count >= self.least[pair % items]]
        if not len(pair):
            return np.zeros((3, 0), np.int64)
        # a band's number lies within the texts' length and the longest item's on either side
        shift = max(map(len, self.codes)) + 2
        most = 2 * (size + shift) + 4
        for a, b in pairwise(cuts):
            pos, item, at = self.hits(p[a:b], lo[a:b], n[a:b])
            text = np.searchsorted(ends, pos)
            place = np.minimum(np.searchsorted(pair, text * items + item), len(pair) - 1)
            ok = pair[place] == text * items + item
            band = ((pos - begin[text] - at + size + 1) // (self.budgets[item] + 1))[ok]
            bands.add(place[ok] * most + band + shift)
            bands.add(place[ok] * most + band + shift - 1)
        key, count = bands.all()
        place, band = key // most, key % most - shift
        keep = count >= self.least[pair[place] % items]
        return np.stack([pair[place] // items, pair[place] % items, band])[:, keep]

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, distance, start, end), one per pair."""
        found = []
        ends, joined = normal_codes(texts)
        begin = np.r_[0, ends[:-1] + 1]
        p, lo, n = self.ranges(grams(joined))
        bands = np.zeros((3, 0), np.int64)
        if n.sum() > HITS:
            bands = self.bands_by_pieces(p, lo, n, ends, begin, len(joined))
            p, lo, n = p[:0], lo[:0], n[:0]
        pos, item, at = self.hits(p, lo, n)
        if len(pos):
            text = np.searchsorted(ends, pos)
            # pairs with too few hits on all diagonals together can't reach the bound on one band
            size, most = len(self.ids), max(1, _CELLS // len(self.ids))
            enough = np.zeros(len(pos), bool)
            for t in range(0, len(texts), most):
                a, b = np.searchsorted(text, [t, t + most])
                pair = (text[a:b] - t) * size + item[a:b]
                enough[a:b] = np.bincount(pair)[pair] >= self.least[item[a:b]] if b > a else enough[a:b]
            pos, item, at, text = pos[enough], item[enough], at[enough], text[enough]
        if len(pos):
            width = self.budgets[item] + 1
            # diagonals made positive within a text; a gram is in two bands
            diagonal = pos - begin[text] - at + len(joined) + 1
            band = diagonal // width
            keys = np.concatenate([np.stack([text, item, band]), np.stack([text, item, band - 1])], axis=1)
            keys = keys[:, np.lexsort(keys[::-1])]
            first = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            count = np.diff(np.r_[first, keys.shape[1]])
            kept = count >= self.least[keys[1, first]]
            bands = keys[:, first[kept]]
        if bands.shape[1]:
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            # neighbouring bands of a pair are aligned as one
            new = np.r_[True, (bands[:2, 1:] != bands[:2, :-1]).any(axis=0) | (np.diff(bands[2]) > 1)]
            cuts = [*np.flatnonzero(new[:bands.shape[1]]), bands.shape[1]]
            for a, b in pairwise(cuts):
                t, i, low = bands[:, a].tolist()
                if best.get((t, i), (1,))[0] == 0:
                    continue
                own = joined[begin[t]:ends[t]]
                if (s := own.tobytes().find(self.bytes[i])) >= 0 and not s & 3:
                    best[t, i] = (0, s >> 2, (s >> 2) + len(self.codes[i]))
                    continue
                k, base = int(self.budgets[i]), len(joined) + 1
                low, high = low * (k + 1) - base, (int(bands[2, b - 1]) + 2) * (k + 1) - 1 - base
                if (got := aligned(self.codes[i], own, low, high, k)) and got < best.get((t, i), (1 << 30, 0, 0)):
                    best[t, i] = got
            found += [(*pair, *got) for pair, got in best.items()]
        if self.short:
            plain = [normal(t) for t in texts]
            found += [(t, i, 0, s, s + len(self.texts[i])) for i in self.short for t, x in enumerate(plain)
                      if (s := x.find(self.texts[i])) >= 0]
        return found


def blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int = BLOCK_CHARS) -> Iterator[list[tuple[object, str]]]:
    """Benchmark items in blocks of at most ``most`` characters (or one item),
    streamed to the driver partition by partition."""
    block, size = [], 0
    for r in benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        if text := normal(r["t"]):
            if block and size + len(text) > most:
                yield block
                block, size = [], 0
            block.append((r["i"], text))
            size += len(text)
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, start, end): every leaked pair with its best
    alignment, in characters of the normalised text."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, distance int, start long, end long"
    arrow_item = benchmark.select(F.col(item_col).alias("i")).limit(0).toArrow().schema.field("i").type
    out = None
    for block in blocks(benchmark, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value)
            for batch in batches:
                for part in slices(batch, "text", PART):
                    got = index.matches([t or "" for t in part.column("text").to_pylist()])
                    cols = list(zip(*got, strict=True)) if got else [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(cols[0], pa.int64())),
                         pa.array([index.ids[i] for i in cols[1]], arrow_item), pa.array(cols[2], pa.int32()),
                         pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                        ["doc_id", "item_id", "distance", "start", "end"])

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    if out is not None:
        return out
    return rows.limit(0).select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("item_id", item_kind), ("distance", "int"), ("start", "long"), ("end", "long"))])
