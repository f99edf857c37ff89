"""Operator 5: language identification by averaged hashed subword embeddings
with a linear softmax, trained by stochastic gradient descent in numpy, with
calibrated rejection.

A text's subwords are the byte 2- to 4-grams of its lower-cased letters, with
every other character as one border; each hashes to a row of an embedding
table, the rows' average goes through a linear layer and a softmax.  A
temperature that falls with the number of subwords, and a rejection threshold,
are fitted on rows left out of training and on short random draws from them:
``rejected`` marks scores below the level that keeps ``KEEP`` of the rightly
named ones.

Training takes at most ``PER_LABEL`` rows of each label and about ``TOTAL`` in all
(one of each label at least), chosen by hashed id and text, in one distributed
pass that counts their subwords; only those counts come to the driver, where
they stay sparse.  Every label is learned.  Prediction reads every whole text once, in Arrow batches: averaging
embeddings and the linear layer fold into one score row per bucket.

Cases: a null or empty text, or one without a letter, is ``und`` with score 0;
a null lang teaches nothing; without any label every text is ``und``; a label
may be the string "und"; ties go to the first label in code-point order; a null
id hashes as the text "null"; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import mix64, ship_package, slices, utf8_buffers

BITS, DIM = 14, 16
PER_LABEL = 400
#: rows of all labels together: beyond TOTAL / PER_LABEL labels each has fewer
TOTAL = 100_000
KEEP = 0.99
NONE = "und"
_SIZES = (2, 3, 4)
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def subwords(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every subword; ``raw`` is lower-cased UTF-8.  Runs of
    other characters count as one border, and so do a row's ends."""
    n = len(offsets) - 1
    # a border byte before every row and after the last
    rows = np.repeat(np.arange(n), np.diff(offsets))
    letter = _LETTER[raw]
    text = np.zeros(len(raw) + n + 1, np.uint64)
    text[np.arange(len(raw)) + rows + 1] = np.where(letter, raw, 0)
    owner = np.full(len(text), n, np.int64)
    owner[np.arange(len(raw)) + rows + 1] = rows
    owner[offsets[:-1] + np.arange(n)] = np.arange(n)
    keep = np.r_[True, (text[1:] > 0) | (text[:-1] > 0)]
    text, owner = text[keep], owner[keep]
    out_rows, out = [], []
    gram = text + np.uint64(1)
    for size in range(2, max(_SIZES) + 1):
        gram = gram[:-1] * np.uint64(257) + text[size - 1:] + np.uint64(1)
        # borders only at the ends of a gram, so what follows its start names the row
        whole = np.ones(len(gram), bool)
        for i in range(1, size - 1):
            whole &= text[i:i + len(gram)] > 0
        if size in _SIZES:
            at = np.flatnonzero(whole)
            out_rows.append(np.where(text[at] > 0, owner[at], owner[at + 1]))
            out.append((mix64(gram[at] + np.uint64(size << 32)) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out_rows), np.concatenate(out)


def lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return utf8_buffers(pc.utf8_lower(column.cast(pa.large_string())))


class Model:
    """Labels, a score row per bucket, a bias, the temperature and the rejection level."""

    def __init__(self, labels: list[str], table: np.ndarray, bias: np.ndarray):
        self.labels, self.table, self.bias = labels, table, bias
        self.temperature, self.half, self.level = 1.0, 0.0, 0.0

    def logits(self, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        count = np.maximum(np.bincount(rows, minlength=n), 1)
        each = [np.bincount(rows, weights=column[buckets], minlength=n) / count for column in self.table.T]
        return np.stack(each, axis=1) + self.bias if each else np.zeros((n, 0))

    def probabilities(self, rows, buckets, n) -> np.ndarray:
        return self.tempered(self.logits(rows, buckets, n), np.bincount(rows, minlength=n))

    def tempered(self, logits: np.ndarray, count: np.ndarray) -> np.ndarray:
        count = np.maximum(count, 1)
        return softmax(logits / self.temperature * (count / (count + self.half))[:, None])

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        n = len(column)
        spoken = np.zeros(n, bool)
        if n and self.labels:
            spoken = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not spoken.any():
            return [NONE] * n, np.zeros(n), np.ones(n, bool)
        p = self.probabilities(*subwords(*lowered(column)), n)
        best = p.argmax(axis=1)
        score = np.where(spoken, p[np.arange(n), best], 0.0)
        names = [self.labels[b] if s else NONE for b, s in zip(best, spoken, strict=True)]
        return names, score, score < self.level if self.labels else np.ones(n, bool)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, *, epochs: int = 8, rate: float = 0.5,
          batch: int = 32, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Folded (bucket scores, bias) of an embedding table and a linear softmax;
    ``x`` has the (buckets, shares) of each text, one bucket at least."""
    draw = np.random.default_rng(seed)
    embed = draw.normal(0, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    linear, bias = np.zeros((DIM, classes), np.float32), np.zeros(classes, np.float32)
    linear[:] = draw.normal(0, 1 / DIM, linear.shape)
    weight = (len(y) / (classes * np.maximum(np.bincount(y, minlength=classes), 1))).astype(np.float32)
    # a share is about 1 / 100, so steps on the table are scaled up
    scale = 200.0
    for e in range(epochs):
        step = rate * (1 - e / epochs)
        order = draw.permutation(len(y))
        for s in range(0, len(y), batch):
            i = order[s:s + batch]
            n = [len(x[j][0]) for j in i]
            f, v = np.concatenate([x[j][0] for j in i]), np.concatenate([x[j][1] for j in i])[:, None]
            mean = np.add.reduceat(embed[f] * v, np.r_[0, np.cumsum(n)[:-1]])
            g = softmax(mean @ linear + bias)
            g[np.arange(len(i)), y[i]] -= 1
            g *= weight[y[i]][:, None] / len(i)
            back = g @ linear.T
            linear -= step * mean.T @ g
            bias -= step * g.sum(axis=0)
            np.subtract.at(embed, f, np.float32(step * scale) * v * np.repeat(back, n, axis=0))
    return (embed @ linear).astype(np.float64), bias.astype(np.float64)


def calibrate(model: Model, texts: list[np.ndarray], y: np.ndarray, seed: int = 5) -> None:
    """Temperature and half-length of least log loss, then the rejection level.
    ``texts``: the subword buckets of rows that training has not seen; each also
    serves as draws of a few of its subwords, as short texts have them."""
    if not len(y):
        return
    draw = np.random.default_rng(seed)
    parts = [(t if size is None else draw.choice(t, size), i) for t, i in zip(texts, y, strict=True)
             for size in (None, 3, 9, 27, 81)]
    count = np.array([len(p) for p, _ in parts])
    y = np.array([i for _, i in parts])
    logits = model.logits(np.repeat(np.arange(len(parts)), count), np.concatenate([p for p, _ in parts]), len(parts))

    def loss(at: tuple[float, float]) -> float:
        model.temperature, model.half = at
        return -np.log(model.tempered(logits, count)[np.arange(len(y)), y] + 1e-12).mean()

    model.temperature, model.half = min(((float(t), float(h)) for t in np.geomspace(0.02, 20, 40)
                                         for h in (0, 1, 3, 10, 30, 100, 300)), key=loss)
    p = model.tempered(logits, count)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    model.level = float(np.quantile(right, 1 - KEEP)) if len(right) else 0.0


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows, buckets = subwords(*lowered(part.column("text")))
            flat, count = np.unique(rows * (1 << BITS) + buckets, return_counts=True)
            rows = flat >> BITS
            ends = pa.array(np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("nth"), part.column("label"), pa.ListArray.from_arrays(ends, pa.array((flat & ((1 << BITS) - 1)).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32)))], ["nth", "label", "buckets", "counts"])


def fold(id_col, folds: int = 4):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary")) % folds


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_label: int = PER_LABEL) -> Model:
    """Fit on at most ``per_label`` rows of each label outside fold 2."""
    ship_package(docs.sparkSession)
    rows = (docs.where(fold(id_col) != 2).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.xxhash64(id_col).alias("nth"), F.col(id_col).cast("string").alias("id"),
                    F.col(lang_col).alias("label"), F.col(text_col).alias("text")))
    # rows without an id are told apart by their texts, so that they aren't chosen all or none
    named = ["id", F.when(F.col("id").isNull(), F.xxhash64("text"))]
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()      # a row per label, as the model has
    if not counts:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0))
    per_label = max(1, min(per_label, TOTAL // len(counts)))
    # a hashed share of twice the wanted rows, so the ranking below sees few rows of any label
    share = docs.sparkSession.createDataFrame(
        [(r["label"], min(1.0, 2 * per_label / r["n"])) for r in counts], "label string, share double")
    some = rows.join(F.broadcast(share), "label").where(
        F.pmod(F.xxhash64(*named, F.lit("sample")), F.lit(1_000_000)) < F.col("share") * 1_000_000)
    order = Window.partitionBy("label").orderBy("nth", "id", "text")
    got = (some.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_label)
           .select("nth", "label", "text").mapInArrow(_collect, "nth long, label string, buckets array<int>, counts array<int>")
           .collect())
    got.sort(key=lambda r: (r["nth"], r["label"], r["buckets"], r["counts"]))
    labels = sorted({r["label"] for r in counts}, key=lambda s: s.encode())
    got = [r for r in got if r["buckets"]]
    x = [(np.asarray(r["buckets"], np.int64), np.asarray(r["counts"], np.float32) / np.float32(sum(r["counts"]))) for r in got]
    place = {label: i for i, label in enumerate(labels)}
    y = np.array([place[r["label"]] for r in got], np.int64)
    kept = np.arange(len(got)) % 5 == 4
    if not got:
        return Model(labels, np.zeros((1 << BITS, len(labels))), np.zeros(len(labels)))
    table, bias = train([v for v, k in zip(x, kept, strict=True) if not k], y[~kept], len(labels))
    model = Model(labels, table, bias)
    calibrate(model, [np.repeat(r["buckets"], r["counts"]) for r, k in zip(got, kept, strict=True) if k], y[kept])
    return model


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def guess(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for text in texts:
            column = pa.Array.from_pandas(text, type=pa.large_string())
            batch = pa.RecordBatch.from_arrays([column], ["text"])
            got = [model.predict(p.column(0)) for p in slices(batch, "text", 1 << 20)]
            yield pd.DataFrame({"lang_pred": [n for g in got for n in g[0]],
                                "score": np.concatenate([g[1] for g in got]) if got else np.zeros(0),
                                "rejected": np.concatenate([g[2] for g in got]) if got else np.zeros(0, bool)})

    return docs.select(F.col(id_col).alias("doc_id"), (fold(id_col) == 2).alias("held_out"),
                       guess(F.col(text_col)).alias("g")).select("doc_id", "held_out", "g.*")
