import numpy as np
import pyarrow as pa
from helpers import MEDIUM, ODD, SMALL, docs_of

from starledger.llm import langid
from starledger.llm.common import table
from starledger.llm.langid import fit, identify


def test_held_out_accuracy(spark):
    docs = table(spark, MEDIUM, "documents")
    got = {r["doc_id"]: r for r in identify(docs, fit(docs)).collect()}
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [d for d in lang if got[d]["held_out"]]
    assert len(got) == len(lang) and 0.15 < len(held) / len(lang) < 0.35
    assert sum(got[d]["lang_pred"] == lang[d] for d in held) / len(held) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_scores_fall_with_length_and_rejection_marks_the_low_ones(spark):
    docs = table(spark, MEDIUM, "documents")
    model = fit(docs)
    text = docs.where("lang = 'de' AND n_chars > 2000").orderBy("doc_id").first()["text"]
    rows = [(1, text), (2, text[:12]), (3, "zq"), (4, "xkcd vvv qqq")]
    by = {r["doc_id"]: r for r in identify(docs_of(spark, rows), model).collect()}
    assert by[1]["lang_pred"] == "de" and by[1]["score"] > by[2]["score"] and not by[1]["rejected"]
    assert by[3]["score"] < 0.9
    assert {r["rejected"] == (r["score"] < model.level) for r in by.values()} == {True}


def test_predictions_ignore_lang_source_and_id(spark):
    docs = table(spark, MEDIUM, "documents")
    model = fit(docs)
    a = {r["doc_id"]: r["score"] for r in identify(docs, model).collect()}
    blind = docs.selectExpr("doc_id + 100000 AS doc_id", "text", "'zz' AS lang", "'other' AS source")
    assert {d + 100000: s for d, s in a.items()} == {r["doc_id"]: r["score"] for r in identify(blind, model).collect()}


def test_odd_and_empty_tables(spark):
    docs = table(spark, SMALL, "documents")
    by = {}
    for r in identify(docs_of(spark, ODD), fit(docs)).collect():
        by[r["doc_id"]] = (r["lang_pred"], r["score"])
    for d in (1, 2, 3, 9):
        assert by[d] == ("und", 0.0)
    assert by[4][0] != "und" and by[12][0] != "und"
    assert identify(docs_of(spark, ODD).limit(0), fit(docs)).count() == 0


def test_nothing_to_learn_from(spark):
    docs = docs_of(spark, [(1, "some text", None), (2, "other text", None)])
    assert {r["lang_pred"] for r in identify(docs, fit(docs)).collect()} == {"und"}
    one = docs_of(spark, [(i, "some text here", "en") for i in range(40)])
    assert {r["lang_pred"] for r in identify(one, fit(one)).collect()} == {"en"}


def test_every_label_is_learned(spark):
    """1,200 labels, each with a word of its own."""
    def word(i):
        return "".join(chr(97 + (i // 26 ** k) % 26) * 2 for k in range(3))
    rows = [(3 * i + j, f"{word(i)} " * (8 + j), f"l{i:04d}") for i in range(1200) for j in range(3)]
    model = fit(docs_of(spark, rows, extra=False))
    assert len(model.labels) == 1200
    assert model.table.shape == (1 << langid.BITS, 1200) and np.isfinite(model.table).all()
    own = model.probabilities(*langid.subwords(*langid.lowered(pa.array([word(i) for i in range(0, 1200, 100)]))), 12)
    # a label's own word speaks for it more than the average label does
    assert np.mean([own[k, i] > np.median(own[k]) for k, i in enumerate(range(0, 1200, 100))]) > 0.8


def test_training_equals_a_plain_loop():
    """The same descent over dense rows, one text at a time."""
    rng = np.random.default_rng(0)
    x = [(np.sort(rng.choice((1 << langid.BITS), 6, replace=False)), np.full(6, 1 / 6, np.float32)) for _ in range(40)]
    y = np.arange(40) % 3
    table_, bias = langid.train(x, y, 3, epochs=2)
    draw = np.random.default_rng(3)
    embed = draw.normal(0, 1 / langid.DIM, ((1 << langid.BITS), langid.DIM)).astype(np.float32).astype(np.float64)
    linear = np.zeros((langid.DIM, 3), np.float32)
    linear[:] = draw.normal(0, 1 / langid.DIM, linear.shape)
    linear, b = linear.astype(np.float64), np.zeros(3)
    weight = [40 / (3 * sum(y == c)) for c in range(3)]
    for e in range(2):
        order = draw.permutation(40)
        for s in range(0, 40, 32):
            d_linear, d_b, d_embed = np.zeros_like(linear), np.zeros(3), {}
            some = order[s:s + 32]
            for j in some:
                mean = sum(embed[f] * v for f, v in zip(*x[j], strict=True))
                z = mean @ linear + b
                g = np.exp(z - z.max())
                g /= g.sum()
                g[y[j]] -= 1
                g *= weight[y[j]] / len(some)
                d_linear += np.outer(mean, g)
                d_b += g
                for f, v in zip(*x[j], strict=True):
                    d_embed[f] = d_embed.get(f, 0) + v * (linear @ g)
            step = 0.5 * (1 - e / 2)
            linear, b = linear - step * d_linear, b - step * d_b
            for f, d in d_embed.items():
                embed[f] -= step * 200 * d
    assert np.allclose(table_, embed @ linear, atol=1e-3) and np.allclose(bias, b, atol=1e-4)


def test_rows_without_an_id_are_sampled_by_their_texts(spark):
    rows = [(None, f"{'ein' if i % 2 else 'the'} wort {i}", "de" if i % 2 else "en") for i in range(400)]
    model = fit(docs_of(spark, rows), per_label=20)
    assert model.labels == ["de", "en"] and np.abs(model.table).max() > 0
