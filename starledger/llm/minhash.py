"""Operator 10: near-duplicates by one-permutation hashing with optimal
densification, banded buckets and star-shaped candidate edges.

1. Every text becomes its set of 5-word shingles; rows with equal sets collapse
   to their smallest id before anything is compared.
2. One permutation: a shingle hash's high bits name one of ``BINS`` bins, the
   smallest hash of a bin is its value.  An empty bin copies the bin that a
   hash sequence of its own number reaches first (optimal densification).
   ``BANDS`` bands of ``ROWS`` bins give the bucket keys: a pair of similarity
   0.75 shares none with a probability of (1 - 0.75**4)**28 = 2.4e-5, which
   densification raises for small sets.  So sets of up to ``SHORT`` shingles have
   further bucket keys: two sets that link share at least 0.75 of either, hence
   one of the n - ceil(0.75 * n) + 1 smallest hashes of each.  Every link of a set
   of up to 64 shingles shares a bucket for certain.
3. Candidate edges are stars: every bucket member meets the bucket's smallest
   id, so a bucket of n members gives n - 1 edges, never n * (n - 1) / 2.
   First each document is compared with the centre it meets in most buckets,
   then with its other centres while they are in another component.
4. Stars may miss a link between two members that are both unlike the centre.
   So rounds follow for the buckets that are still in several components: their
   members are sorted by the keys of ``DEPTH`` other bands, other ones for every
   band and round, which brings the likest together, and meet the next ``NEXT``
   of other components, until a round finds no link.  Buckets of up to NEXT + 1
   members are thus compared completely; buckets of more than CELL members are
   sorted in cells of equal first keys.  A pair meets on its texts only when
   its signatures allow a link: of each remainder of the hashes a signature
   tells whether the set has an odd number, so two sets differ in at least as
   many shingles as their signatures in bits, and no link is lost.
5. The members of larger buckets that are still in several components go through
   an exact set-similarity join.  Shingles are ordered from rare to common; two
   sets of a and b shingles that link share at least o = 3 / 7 * (a + b) of them,
   so their first common one is among the first a - o + 1 and b - o + 1.  Sets
   meet by (shingle, both size classes) there, when their components differ and
   what follows that shingle can still make up o.  A family whose common part is
   too small for a link has it behind those first ones, and doesn't meet by it.
6. Links are confirmed on the full sets: 100 * intersection >= 75 * union.

A vertex is an (id, text hash), numbered in the order of the ids.  Cases: a null
id counts as the largest id and is returned as null; rows that share an id are
judged by their own texts, of which each is a vertex; a null or empty text, or
one of white space, has an empty set and links with nothing; a text of fewer than five words is one
shingle; a very long text is one set in one task, of 8 bytes a shingle; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import mix64, ship_package, slices, utf8_buffers, written
from starledger.llm.components import components
from starledger.llm.shingles import shingle_sets

ROWS, BANDS = 4, 28
BINS = ROWS * BANDS
PERCENT = 75
NEXT = 6
#: sets of up to so many shingles (64 / 0.75) have their smallest hashes as bucket keys too
SHORT = 85
#: further band keys that order a bucket's members
DEPTH = 4
#: members of a bucket that are put in order together
CELL = 1000
#: 64-bit words of a set's signature
SIGN = 16
#: shingle counts are kept in 2**COUNT_BITS slots; any order of the shingles is exact, this one puts common ones last
COUNT_BITS = 18
#: sizes from here on share a class with those up to STEP times as large
FINE, STEP = 64, 1.03


#: what tells rows apart: the id (0 for null), whether it is null, and the text's hash
ROW = ["id", "none", "same"]


def densified(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, BINS) one-permutation values; rows of empty sets are zeros."""
    values = np.zeros((len(sets), BINS), np.uint64)
    filled = np.zeros((len(sets), BINS), bool)
    for i, s in enumerate(sets):
        if len(s):
            at = ((s >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
            new = np.r_[True, at[1:] != at[:-1]]
            values[i, at[new]] = s[new]
            filled[i, at[new]] = True
    row, hole = np.nonzero(~filled & filled.any(axis=1)[:, None])
    step = 1
    while len(row):
        tried = (mix64(hole.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(step)) % np.uint64(BINS)).astype(np.int64)
        hit = filled[row, tried]
        values[row[hit], hole[hit]] = values[row[hit], tried[hit]]
        row, hole = row[~hit], hole[~hit]
        step += 1
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    """(sets, BANDS) bucket keys; a key holds its band's number."""
    keys = np.zeros((len(values), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        keys = mix64(keys + values[:, r::ROWS])
    return keys


def short_keys(s: np.ndarray) -> np.ndarray:
    """The smallest hashes of a small set as bucket keys.  Sets of one or two
    shingles link with none but equal sets."""
    n = len(s)
    if not 3 <= n <= SHORT:
        return np.zeros(0, np.uint64)
    return mix64(s[:n + PERCENT * -n // 100 + 1] ^ np.uint64(0x9E6C63D0876A9A47))


def signature(s: np.ndarray) -> np.ndarray:
    """SIGN words of parity bits.  A shingle changes one bit, so two sets have
    signatures that differ in no more bits than the sets in shingles."""
    odd = np.bincount((s % np.uint64(64 * SIGN)).astype(np.int64), minlength=64 * SIGN) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = np.uint64(0x632BE59BD9B4E019)
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(*utf8_buffers(part.column("text")))
            keys = band_keys(densified(sets)).view(np.int64)
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            held = [np.r_[k, short_keys(s).view(np.int64)] if len(s) else k[:0] for k, s in zip(keys, sets, strict=True)]
            bands = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, held)]).astype(np.int32)),
                                             pa.array(np.concatenate([*held, np.zeros(0, np.int64)])))
            a = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            b = np.array([mix64(s ^ salt).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            sign = pa.ListArray.from_arrays(pa.array(np.arange(0, SIGN * len(sets) + 1, SIGN, np.int32)),
                                            pa.array(np.concatenate([signature(s) for s in sets])))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ROW), pa.array(n), pa.array(a), pa.array(b), bands, sign],
                [*ROW, "n_shingles", "set_a", "set_b", "bands", "sign"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text_v"):
            u_sets = shingle_sets(*utf8_buffers(part.column("text_u")))
            v_sets = shingle_sets(*utf8_buffers(part.column("text_v")))
            shared = [len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(u_sets, v_sets, strict=True)]
            ok = [s > 0 and 100 * s >= PERCENT * (len(a) + len(b) - s)
                  for s, a, b in zip(shared, u_sets, v_sets, strict=True)]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(c).filter(keep) for c in ("u", "v")], ["u", "v"])


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u < v) whose full sets are alike enough."""
    first = pairs.select("u", "v").join(texts.select(F.col("rid").alias("u"), F.col("text").alias("text_u")), "u")
    return first.join(texts.select(F.col("rid").alias("v"), F.col("text").alias("text_v")), "v").select(
        "u", "v", "text_u", "text_v").mapInArrow(_confirm, "u long, v long")


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (rid, label) after the links (u, v) have joined components."""
    at = labels.select(F.col("rid").alias("u"), F.col("label").alias("a"))
    to = labels.select(F.col("rid").alias("v"), F.col("label").alias("b"))
    merged = components(links.join(at, "u").join(to, "v").select(F.col("a").alias("u"), F.col("b").alias("v")))
    return written(labels.join(merged, F.col("label") == F.col("node"), "left")
                   .select("rid", F.coalesce("component", "label").alias("label")), "labels")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    at = labels.select(F.col("rid").alias("u"), F.col("label").alias("a"))
    to = labels.select(F.col("rid").alias("v"), F.col("label").alias("b"))
    return pairs.join(at, "u").join(to, "v").where("a <> b").drop("a", "b")


def _alike_in_size(a: str, b: str):
    return (100 * F.least(a, b) >= PERCENT * F.greatest(a, b))


def _can_link(p: str, q: str):
    """False only for sets that differ in too many shingles for a link."""
    apart = sum(F.bit_count(F.col(f"{p}.sign")[i].bitwiseXOR(F.col(f"{q}.sign")[i])) for i in range(SIGN))
    return (100 + PERCENT) * apart <= (100 - PERCENT) * (F.col(f"{p}.n_shingles") + F.col(f"{q}.n_shingles"))


def _needed(a, b):
    """Shingles that sets of a and b of them share at least when they link."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def size_class(n: int) -> int:
    return n if n < FINE else FINE + math.floor(math.log(n / FINE) / math.log(STEP))


def class_start(c: int) -> int:
    """No set of the class is smaller."""
    return c if c < FINE else math.floor(FINE * STEP ** (c - FINE))


def prefixes(n: int) -> list[tuple[int, int]]:
    """(partner's size class, how many of the first shingles can be the first
    common one) for a set of ``n``."""
    least, most = -(-PERCENT * n // 100), 100 * n // PERCENT
    return [(c, n - _needed(n, max(class_start(c), least)) + 1) for c in range(size_class(least), size_class(most) + 1)]


def _slot(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingle_sets(*utf8_buffers(part.column("text")))
            slot, n = np.unique(_slot(np.concatenate(sets)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n)], ["slot", "n"])


def _first_shingles(texts: DataFrame) -> DataFrame:
    """texts (rid, label, text) -> key (shingle and both size classes), rid,
    label, n, place, side (the own class is the smaller, the same, the larger)."""
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    # at most 2**COUNT_BITS rows of two numbers, which never become Python objects
    got = texts.mapInArrow(_count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts[got["slot"].to_numpy()] = got["n"].to_numpy()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                keys, row, place, side = [], [], [], []
                sets = shingle_sets(*utf8_buffers(part.column("text")))
                for i, s in enumerate(sets):
                    s, own = s[np.argsort(counts[_slot(s)], kind="stable")], size_class(len(s))
                    for c, n in prefixes(len(s)):
                        both = np.array([min(own, c) << 32 | max(own, c)], np.uint64)
                        keys.append(mix64(s[:n] + mix64(both)))
                        row.append(np.full(n, i))
                        place.append(np.arange(n))
                        side.append(np.full(n, (own > c) - (own < c)))
                row = np.concatenate(row)
                size = np.fromiter(map(len, sets), np.int64, len(sets))[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), part.column("rid").take(pa.array(row)),
                     part.column("label").take(pa.array(row)), pa.array(size.astype(np.int32)),
                     pa.array(np.concatenate(place).astype(np.int32)), pa.array(np.concatenate(side).astype(np.int8))],
                    ["key", "rid", "label", "n", "place", "side"])

    return texts.mapInArrow(first, "key long, rid long, label long, n int, place int, side byte")


def _meeting(texts: DataFrame) -> DataFrame:
    """texts (rid, label, text) -> every pair (u < v) of different labels that
    can link.  Of a key's labels the one with most members doesn't meet itself,
    so a large component costs as much as the others have members."""
    first = written(_first_shingles(texts), "first-shingles")
    labels = first.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    main = written(labels.groupBy("key").agg(F.max(F.struct("n", "label")).alias("m"), F.count(F.lit(1)).alias("k"))
                   .where("k > 1").select("key", F.col("m.label").alias("main")), "shared-shingles")
    shared = first.join(main, "key")
    p, q = shared.where("label <> main").alias("p"), shared.alias("q")
    left = F.least(F.col("p.n") - F.col("p.place"), F.col("q.n") - F.col("q.place"))
    return (p.join(q, (F.col("p.key") == F.col("q.key")) & (F.col("p.label") != F.col("q.label"))
                   & ((F.col("q.label") == F.col("q.main")) | (F.col("p.label") < F.col("q.label")))
                   & (F.col("p.side") + F.col("q.side") == 0)
                   & ((100 + PERCENT) * left >= PERCENT * (F.col("p.n") + F.col("q.n"))))
            .select(F.least("p.rid", "q.rid").alias("u"), F.greatest("p.rid", "q.rid").alias("v")).distinct())


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    return judged(docs, id_col=id_col, text_col=text_col).select("doc_id", "n_shingles", "component_id", "kept")


def judged(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, same (the text's xxhash64), n_shingles, component_id, kept."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(id_col).isNull().alias("none"),
                       F.xxhash64(F.col(text_col)).alias("same"), F.col(text_col).alias("text"))
    sketch = written(rows.mapInArrow(
        _sketch, "id long, none boolean, same long, n_shingles long, set_a long, set_b long, "
        "bands array<long>, sign array<long>"), "sketch")
    key = ["n_shingles", "set_a", "set_b"]
    # ascending numbers in the order of the ids, null last
    vertices = written(sketch.select(*ROW).distinct().sort("none", "id", "same")
                       .withColumn("rid", F.monotonically_increasing_id()), "vertices")
    numbered = written(sketch.select(*ROW, *key).join(vertices, ROW), "numbered")
    heads = (numbered.where("n_shingles > 0").groupBy(*key).agg(F.min(F.struct("rid", *ROW)).alias("h"))
             .select(*key, F.col("h.rid").alias("head"), *[F.col(f"h.{c}").alias(f"head_{c}") for c in ROW]))
    heads = written(heads, "heads")
    of_head = F.expr(" AND ".join(f"{c} = head_{c}" for c in ROW))
    sets = written(sketch.where("n_shingles > 0").join(heads, key).where(of_head)
                   .select(F.col("head").alias("rid"), *ROW, "n_shingles", "bands", "sign").dropDuplicates(["rid"]), "sets")
    shared = (sets.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("bucket"))
    members = written(sets.select("rid", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
                      .join(shared, "bucket"), "buckets")
    ids = members.select("rid").distinct()
    texts = written(rows.join(sets.join(ids, "rid").select(*ROW, "rid"), ROW).dropDuplicates(ROW).select("rid", "text"),
                    "texts")
    labels = written(ids.select("rid", F.col("rid").alias("label")), "labels")

    centres = members.groupBy("bucket").agg(F.min(F.struct("rid", "n_shingles")).alias("c")).select(
        "bucket", F.col("c.rid").alias("u"), F.col("c.n_shingles").alias("n_u"))
    stars = written(
        members.join(centres, "bucket").where("rid <> u").where(_alike_in_size("n_shingles", "n_u"))
        .groupBy("u", F.col("rid").alias("v")).agg(F.count(F.lit(1)).alias("votes"))
        .withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy(F.desc("votes"), "u"))), "stars")
    labels = _relabel(labels, _links(stars.where("nth = 1"), texts))
    labels = _relabel(labels, _links(_apart(stars.where("nth > 1"), labels), texts))
    tested = stars.select("u", "v")
    nth = 0
    while True:
        nth += 1
        at = members.join(labels, "rid")
        split = (at.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"),
                                          F.count(F.lit(1)).alias("n")).where("x <> y")
                 .select("bucket", F.ceil(F.col("n") / CELL).alias("cells")))
        # the keys of other bands, another choice each round
        other = [F.element_at("bands", F.pmod(F.col("band") + 1 + i + nth * DEPTH, F.lit(BANDS)) + 1) for i in range(DEPTH)]
        order = Window.partitionBy("bucket", "cell").orderBy("deal", "rid")
        me = F.struct("rid", "label", "n_shingles", "sign")
        ahead = (at.join(split, "bucket").join(sets.select("rid", "bands", "sign"), "rid").withColumn("deal", F.array(*other))
                 .withColumn("cell", F.pmod(F.xxhash64(F.col("deal")[0]), F.col("cells")))
                 .select(me.alias("p"), F.array(*[F.lead(me, i).over(order) for i in range(1, NEXT + 1)]).alias("next"))
                 .select("p", F.explode("next").alias("q")))
        pairs = (ahead.where("q IS NOT NULL AND p.label <> q.label")
                 .where(_alike_in_size("p.n_shingles", "q.n_shingles")).where(_can_link("p", "q"))
                 .select(F.least("p.rid", "q.rid").alias("u"), F.greatest("p.rid", "q.rid").alias("v")).distinct())
        pairs = written(pairs.join(tested, ["u", "v"], "left_anti"), "pairs")
        links = written(_links(pairs, texts), "links")
        if links.isEmpty():
            break
        tested = tested.unionByName(pairs)
        labels = _relabel(labels, links)

    larger = (members.join(labels, "rid").groupBy("bucket")
              .agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("n"))
              .where("x <> y").where(F.col("n") > NEXT + 1).select("bucket"))
    asked = written(members.join(larger, "bucket").select("rid").distinct().join(labels, "rid"), "asked")
    if not asked.isEmpty():
        pairs = _meeting(written(texts.join(asked, "rid"), "asked-texts")).join(tested, ["u", "v"], "left_anti")
        labels = _relabel(labels, written(_links(pairs, texts), "links"))

    real = F.when(~F.col("none"), F.col("id"))
    named = (heads.join(labels.join(vertices.select(F.col("rid").alias("label"), real.alias("label_id")), "label")
                        .withColumnRenamed("rid", "head"), "head", "left")
             .select(*key, F.coalesce("label", "head").alias("component"),
                     F.when(F.col("label").isNotNull(), F.col("label_id"))
                     .when(~F.col("head_none"), F.col("head_id")).alias("component_id")))
    # an empty set is alone
    return numbered.join(named, key, "left").select(
        real.alias("doc_id"), "same", "n_shingles",
        F.when(F.col("component").isNull(), real).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("rid") == F.coalesce("component", "rid")).alias("kept"))
