import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm.maxent import (
    BEFORE,
    END,
    Shape,
    Steps,
    Vocabulary,
    Weights,
    features,
    fit_language_model,
    gradients,
)
from ebbtide.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.helpers import AWKWARD, docs

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*WORD.findall(lowered), None]


def base(rows):
    """Contract columns by id: held_out, n_tokens, n_known, train_tokens and base_score."""
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(t for i, text in rows if not held[i] for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    found = {}
    for i, text in rows:
        words = tokens(text)
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        found[i] = (held[i], len(words), sum(counts[w] > 0 for w in words), n, score)
    return found


def test_query_on_whole_table(spark):
    source = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    expected = base([(r.doc_id, r.text) for r in source])
    rows = QUERIES["op12_maxent"](spark, DATA).collect()
    assert len(rows) == len(source)
    for r in rows:
        *exact, score = expected[r.doc_id]
        assert [r.held_out, r.n_tokens, r.n_known, r.train_tokens] == exact
        assert r.base_score == pytest.approx(score, rel=1e-9, abs=1e-9)
        assert r.score < 0
    held = [r for r in rows if r.held_out]
    size = sum(r.n_tokens for r in held)
    gain = sum(r.score - r.base_score for r in held) / size
    assert gain > 0.4  # decimal digits per token


def fit(table, shape=Shape(classes=4, size=4, bits=8, batch=64), **settings):
    learn = F.coalesce(F.col("doc_id"), F.lit(0)) % 5 != 0
    return fit_language_model(table, learn, F.lit(0), rounds=1, shape=shape, **settings)


def test_awkward_rows(spark):
    table = docs(spark, [*AWKWARD, "a\tb\x0bc\x1cd", "x" * 100 + " y", "x" * 100])
    model = fit(table, most_words=3)
    assert model.score(docs(spark, [])).collect() == []
    rows = model.score(table).collect()
    assert len(rows) == table.count()
    source = table.select("doc_id", "text").collect()
    learned = [r.text for r in source if (r.doc_id or 0) % 5]
    counts = Counter(t for text in learned for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (
            repr(r.doc_id),
            len(tokens(r.text)),
            sum(counts[w] > 0 for w in tokens(r.text)),
            round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(r.text)), 4),
        )
        for r in source
    )
    got = sorted((repr(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows)
    assert got == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_nothing_learned(spark):
    table = docs(spark, [(5, "one two"), (10, None)])
    rows = fit(table).score(table).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.base_score) for r in rows] == [(3, 0, 0.0), (1, 0, 0.0)]
    assert all(math.isfinite(r.score) for r in rows)


def test_probabilities_sum_to_one(spark):
    """Over all known words and the one outcome of unseen words, in any context."""
    source = random.Random(2)
    texts = [" ".join(source.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30)) for _ in range(40)]
    model = fit(docs(spark, texts), most_words=20)
    words = [r.word.decode() for r in model.counts.collect() if r.word != END]
    for context in ("", "a b c d", "q ?"):
        whole = model.score(docs(spark, [f"{context} {w}" for w in [*words, "???"]])).collect()
        # The end token after each word differs, so it is taken out by hand.
        end = {r.doc_id: after(model, f"{context} {w}") for r, w in ordered(whole, [*words, "???"])}
        start = before(model, context)
        total = sum(10 ** (r.score - end[r.doc_id] - start) for r in whole)
        total += 10 ** after(model, context)  # the text could end here
        assert total == pytest.approx(1, abs=1e-5)


def ordered(rows, words):
    by_id = sorted(rows, key=lambda r: r.doc_id)
    return list(zip(by_id, words))


def parts(model, text):
    """Log10 probability of every token of a text, by the formulas of the model."""
    vocabulary, weights = model.vocabulary, model.weights
    counts = {r.word: r.c for r in model.counts.collect()}
    places = {w: i for i, w in enumerate(vocabulary.words[: vocabulary.outcomes])}
    words = [*text.encode().lower().split(), END]
    k = vocabulary.outcomes
    stream = np.array([k + 1] * BEFORE + [places.get(w, k) for w in words])
    logs = weights.scores(features(stream, k + 2), stream[BEFORE:]) / math.log(10)
    for i, word in enumerate(words):
        if word not in places:
            c = counts.get(word)
            logs[i] += vocabulary.tail_log10(c) if c else vocabulary.unseen_log10
    return logs


def after(model, text):
    return parts(model, text)[-1]


def before(model, text):
    return parts(model, text)[:-1].sum()


def test_context_is_learned(spark):
    """Words that follow each other in a fixed order; counts alone cannot tell them."""
    source = random.Random(3)
    texts = []
    for _ in range(200):
        at = source.randrange(12)
        texts.append(" ".join(f"w{(at + i) % 12}" for i in range(40)))
    shape = Shape(classes=4, size=4, bits=10, batch=256)
    learn, part = F.col("doc_id") % 5 != 0, F.pmod("doc_id", F.lit(3))
    table = docs(spark, texts).repartition(4)
    model = fit_language_model(table, learn, part, shape=shape)
    rows = model.score(table.filter("doc_id % 5 = 0")).collect()
    assert np.mean([r.score / r.n_tokens for r in rows]) > -0.35
    assert np.mean([r.base_score / r.n_tokens for r in rows]) < -1


def small_weights():
    shape = Shape(classes=3, size=2, bits=4, batch=8, rate=0.1)
    counts = np.array([5, 9, 4, 3, 2])
    vocabulary = Vocabulary([b"%d" % i for i in range(5)], counts, 5, 30, 9, 7, 4, 0.5)
    weights = Weights(vocabulary, shape)
    random = np.random.default_rng(1)
    weights.tables = [(random.standard_normal(t.shape) / 4).astype(np.float32) for t in weights.tables]
    return weights


def test_gradient_equals_differences():
    weights = small_weights()
    stream = np.array([6, 6, 6, 6, 1, 0, 5, 4, 2, 1, 1])
    hashes, outcomes = features(stream, 7), stream[BEFORE:]
    wanted = [np.zeros(t.shape) for t in weights.tables]

    class Kept:
        def step(self, which, places, errors):
            rows, gradient = gradients(places, errors)
            wanted[which][rows] += gradient

    weights.scores(hashes, outcomes, Kept())
    weights.tables = [t.astype(np.float64) for t in weights.tables]
    for table, gradient in zip(weights.tables, wanted):
        for cell in np.ndindex(*table.shape):
            losses = []
            for step in (1e-4, -1e-4):
                table[cell] += step
                losses.append(-weights.scores(hashes, outcomes).sum())
                table[cell] -= step
            assert (losses[0] - losses[1]) / 2e-4 == pytest.approx(gradient[cell], abs=1e-3)


def test_steps_lower_the_loss():
    weights = small_weights()
    stream = np.array([6, 6, 6, 6] + [1, 2, 3, 4] * 10)
    hashes, outcomes = features(stream, 7), stream[BEFORE:]
    first = weights.scores(hashes, outcomes).sum()
    steps = Steps(weights)
    for _ in range(50):
        weights.scores(hashes, outcomes, steps)
    assert weights.scores(hashes, outcomes).sum() > first / 4
    moved = [b.num_rows for b in steps.changes()]
    assert moved == [(t > 0).sum() for t in steps.touched]
