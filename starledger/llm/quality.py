"""Operator 8: a quality classifier by Naive Bayes support vectors.

Features are indicators: words, 1- to 3-grams of word shapes (case, digits,
punctuation at the end, repetition of the word before), and profile bins (which
tenth of a text's words has a trait).  Each indicator is scaled by its class
log-count ratio, rows are scaled to unit length, and a linear hinge-loss model
is fitted by dual coordinate descent.  Margins become scores by a logistic
curve fitted on margins of folds that the model had not seen.

Fitting uses at most ``SAMPLE`` labelled rows, the first in the order of a
hashed id; their indicators come to the driver (a text's distinct features, so
bounded by ``SAMPLE`` times the number of features).  Scoring reads every whole
text once, in Arrow batches, without a shuffle.

Cases: null and empty texts have no indicators but the empty profile and get a
score as any other text; a null id hashes as the text "null" and is held out or not by that; labels
that are null, or rows without a label, teach nothing; an id with several
labels teaches each; with no labels, or only one class of them, every score is
the share of label 1 (0.5 without labels); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import LOWER, mix64, ship_package, slices, span_hashes, utf8_buffers, word_spans

SAMPLE = 6000
THRESHOLD = 0.3
FOLDS = 4
_BITS = 15
_TRAITS = 9
#: bytes of text whose features are made at once: their arrays take some 50 times that
PART = 1 << 18
#: features: words, shape n-grams, profile bins, length bins
SIZE = (2 << _BITS) + 16 * _TRAITS + 32

_LOW, _UP, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(4))
_LOW[97:123] = True
_LOW[128:] = True
_UP[65:91] = True
_DIGIT[48:58] = True
_MARK[33:127] = True
_MARK &= ~(_LOW | _UP | _DIGIT)


def _counts(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=total[1:])
    return total[ends] - total[starts]


def features(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, distinct and ordered by row."""
    n = len(offsets) - 1
    starts, ends, rows = word_spans(offsets, raw)
    per_row = np.bincount(rows, minlength=n)
    length_bin = np.floor(np.log2(per_row + 1)).astype(np.int64)
    keys = [np.arange(n) * SIZE + (2 << _BITS) + 16 * _TRAITS + length_bin]
    if len(starts):
        word = span_hashes(LOWER[raw], starts, ends)
        length = ends - starts
        low, up = _counts(_LOW[raw], starts, ends), _counts(_UP[raw], starts, ends)
        digit, mark = _counts(_DIGIT[raw], starts, ends), _counts(_MARK[raw], starts, ends)
        solid = np.maximum.accumulate(np.where(~_MARK[raw], np.arange(len(raw)), -1))
        tail = np.minimum(ends - 1 - np.maximum(solid[ends - 1], starts - 1), 3)
        last = np.where(tail > 0, raw[ends - 1], 0).astype(np.int64)
        shout = (up >= 2) & (low == 0)
        case = np.where(shout, 3, np.where(up + low == 0, 0, np.where(up == 0, 1, np.where(
            (up == 1) & _UP[raw[starts]], 2, 4))))
        begins = np.r_[True, rows[1:] != rows[:-1]]
        again = np.r_[False, word[1:] == word[:-1]] & ~begins
        shape = case + 5 * np.minimum(digit, 2) + 15 * tail + 60 * again + 128 * last
        shape = mix64(shape.astype(np.uint64) + np.uint64(1))
        keys.append(rows * SIZE + (word >> np.uint64(64 - _BITS)).astype(np.int64))
        gram = np.zeros(len(shape), np.uint64)
        for size in range(1, 4):
            gram = mix64(gram[:len(shape) - size + 1] + shape[size - 1:] * np.uint64(2 * size + 1))
            own = rows[:len(gram)]
            whole = own == rows[size - 1:]
            keys.append((own * SIZE + (1 << _BITS) + (gram >> np.uint64(64 - _BITS)).astype(np.int64))[whole])
            gram = gram[:-1] if size < 3 else gram
            if not len(gram):
                break
        order = np.lexsort((word, rows))
        first = np.r_[True, (word[order][1:] != word[order][:-1]) | (rows[order][1:] != rows[order][:-1])]
        seen = np.zeros(len(word), bool)
        seen[order] = ~first
        traits = [again, shout, mark == length, tail >= 2, digit > 0, low + up == 0, seen, length >= 15, length <= 2]
        has = per_row > 0
        for t, trait in enumerate(traits):
            tenth = 10 * np.bincount(rows, weights=trait, minlength=n)[has] // per_row[has]
            keys.append(np.flatnonzero(has) * SIZE + (2 << _BITS) + 16 * t + tenth.astype(np.int64))
    flat = np.unique(np.concatenate(keys))
    return flat // SIZE, flat % SIZE


class Model:
    """weights over the features, and the curve score = 1 / (1 + exp(-(a m + b)))."""

    def __init__(self, weights: np.ndarray, bias: float, a: float = 1.0, b: float = 0.0):
        self.weights, self.bias, self.a, self.b = weights, bias, a, b

    def margins(self, rows: np.ndarray, feats: np.ndarray, n: int) -> np.ndarray:
        dot = np.bincount(rows, weights=self.weights[0][feats], minlength=n)
        norm = np.sqrt(np.bincount(rows, weights=self.weights[1][feats], minlength=n))
        return dot / np.maximum(norm, 1e-9) + self.bias

    def scores(self, rows: np.ndarray, feats: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * self.margins(rows, feats, n) + self.b, -40, 40)))


def _fit_linear(sets: list[np.ndarray], y: np.ndarray, cost: float = 1.0, passes: int = 30, alpha: float = 1.0,
                seed: int = 7) -> Model:
    """NB-SVM on indicator sets, y of -1 and 1."""
    plus, minus = np.full(SIZE, alpha), np.full(SIZE, alpha)
    for s, t in zip(sets, y, strict=True):
        (plus if t > 0 else minus)[s] += 1
    # ratios of the shares of each class's rows that have the indicator
    n_plus, n_minus = (y > 0).sum() + 2 * alpha, (y < 0).sum() + 2 * alpha
    ratio = np.log((plus / n_plus) / (minus / n_minus))
    # a row's scaled indicators are made when it is visited: only its length is kept
    length = [max(np.sqrt((r * r).sum()), 1e-9) for r in (ratio[s] for s in sets)]
    w, bias = np.zeros(SIZE), 0.0
    dual = np.zeros(len(sets))
    # both classes weigh the same
    most = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    norm = np.array([float(r @ r) + 1 for r in (ratio[s] / n for s, n in zip(sets, length, strict=True))])
    draw = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in draw.permutation(len(sets)):
            row = ratio[sets[i]] / length[i]
            gradient = y[i] * (w[sets[i]] @ row + bias) - 1
            new = min(max(dual[i] - gradient / norm[i], 0.0), most[i])
            if step := (new - dual[i]) * y[i]:
                w[sets[i]] += step * row
                bias += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-3:
            break
    return Model(np.stack([w * ratio, ratio * ratio]), bias)


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton steps, with Platt's smoothed targets."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * a, (p - target).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * margins**2).sum() + 1e-3, (s * margins).sum()], [(s * margins).sum(), s.sum() + 1e-9]])
        d = np.linalg.solve(h, g)
        a, b = a - d[0], b - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return float(a), float(b)


def fit_sets(sets: list[np.ndarray], labels: np.ndarray) -> Model:
    y = np.where(labels > 0, 1, -1)
    if len(set(y.tolist())) < 2 or min((y > 0).sum(), (y < 0).sum()) < FOLDS:
        share = float((y > 0).mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros((2, SIZE)), 0.0, 1.0, float(np.log(share / (1 - share))))
    fold = np.arange(len(y)) % FOLDS
    unseen = np.zeros(len(y))
    for f in range(FOLDS):
        part = np.flatnonzero(fold != f)
        own = _fit_linear([sets[i] for i in part], y[part])
        for i in np.flatnonzero(fold == f):
            unseen[i] = own.margins(np.zeros(len(sets[i]), np.int64), sets[i], 1)[0]
    model = _fit_linear(sets, y)
    model.a, model.b = _curve(unseen, y)
    return model


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", PART):
            rows, feats = features(*utf8_buffers(part.column("text")))
            ends = np.searchsorted(rows, np.arange(part.num_rows + 1))
            sets = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(feats.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("label"), sets], ["label", "feats"])


def held_out(id_col, folds: int = 5):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary")) % folds == 0


def _compare(a: np.ndarray, label_a: int, b: np.ndarray, label_b: int) -> int:
    """By size, then label, then the indicators in order; no row is copied."""
    if len(a) != len(b) or label_a != label_b:
        return -1 if (len(a), label_a) < (len(b), label_b) else 1
    apart = np.flatnonzero(a != b)
    return 0 if not len(apart) else -1 if a[apart[0]] < b[apart[0]] else 1


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows outside the held-out fold: the
    first by a hash of id and label, then of the text, so that an id that many
    documents share brings no more rows than the others leave room for."""
    ship_package(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
    chosen = (known.where(~held_out("_id"))
              .withColumn("nth", F.xxhash64("_id", "label")).orderBy("nth", "_id", "label").limit(sample))
    rows = (docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))     # at most ``sample`` labels
            .orderBy("nth", "_id", "label", F.xxhash64("text"), "text").limit(sample).repartition("nth", "text"))
    # at most ``sample`` rows; their numbers never become Python objects
    got = rows.select("label", "text").mapInArrow(_collect, "label int, feats array<int>").toArrow().combine_chunks()
    label = got["label"].to_numpy().astype(np.int64)
    sets = [f.values.to_numpy() for f in got["feats"]]
    order = sorted(range(len(sets)), key=cmp_to_key(lambda i, j: _compare(sets[i], label[i], sets[j], label[j])))
    mixed = [order[i] for i in np.random.default_rng(1).permutation(len(order))]
    # views of the collected column, which is held once
    return fit_sets([sets[i] for i in mixed], label[mixed])


def scorer(model: Model):
    """An Arrow UDF text -> score: a worker holds a batch's texts once, not as
    Python strings and a copy of these, and what it has held it keeps for all
    later stages."""

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            batch = pa.RecordBatch.from_arrays([text], ["text"])
            parts = [model.scores(*features(*utf8_buffers(p.column(0))), p.num_rows) for p in slices(batch, "text", PART)]
            yield pa.array(np.concatenate([*parts, np.zeros(0)]))

    return score
