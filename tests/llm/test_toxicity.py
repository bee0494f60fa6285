import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import toxicity
from ebbtide.llm.linear import log_odds, logistic
from ebbtide.llm.queries import QUERIES
from ebbtide.llm.toxicity import MOST, Scorer, fit_chain, marks, not_toxic
from tests.conftest import DATA
from tests.llm.helpers import AWKWARD, SCHEMA, docs

RUDE = ["clot", "oaf", "dunce"]


def corpus(spark, count=240):
    """Texts with labels: shouting marks junk, rude words toxic, more often in junk."""
    source = random.Random(4)
    texts, labels = [], []
    for i in range(count):
        text = [f"w{source.randrange(60)}" for _ in range(30)]
        junk = i % 3 == 0
        toxic = i % 4 == 0
        if junk:
            text += ["!!!"] * 3
        if toxic:
            text.insert(5, source.choice(RUDE))
        texts.append(" ".join(text))
        labels.append((i, int(junk), int(toxic)))
    frame = spark.createDataFrame(labels, "doc_id long, low_quality int, toxic int")
    return docs(spark, texts), frame, labels


@pytest.fixture(scope="module")
def fitted(spark):
    table, labels, truth = corpus(spark)
    held_out = labels.filter("doc_id < 160")
    return table, truth, fit_chain(table, held_out)


def test_held_out_accuracy(fitted):
    table, truth, chain = fitted
    assert [m.numFeatures for m in chain.models] == [
        chain.models[0].numFeatures,
        chain.models[0].numFeatures + 1,  # the earlier category is a feature
    ]
    rows = {r.doc_id: r.chain for r in chain.probabilities(table).collect()}
    held_out = [t for t in truth if t[0] >= 160]
    right = sum((rows[i].toxic >= 0.5) == bool(t) for i, _, t in held_out)
    assert right >= 0.97 * len(held_out)
    assert sum((rows[i].low_quality >= 0.5) == bool(j) for i, j, _ in held_out) == len(held_out)


def test_awkward_rows_keep_their_columns(spark, fitted):
    _, _, chain = fitted
    table = docs(spark, [*AWKWARD, "you clot clot"])
    scored = chain.probabilities(table)
    assert scored.schema.names == [*SCHEMA.names, "chain"]
    rows = scored.collect()
    assert len(rows) == len(AWKWARD) + 1
    assert all(0 <= r.chain.toxic <= 1 for r in rows)
    kept = not_toxic(table, chain)
    assert kept.schema == table.schema and kept.count() == len(AWKWARD)
    assert chain.probabilities(docs(spark, [])).collect() == []


def test_without_labels_nothing_is_rejected(spark):
    table, labels, _ = corpus(spark, 20)
    chain = fit_chain(table, labels.filter("doc_id < 0"))
    assert {tuple(r.chain) for r in chain.probabilities(table).collect()} == {(None, None)}
    assert not_toxic(table, chain).count() == 20
    some_null = spark.createDataFrame(
        [(i, None if i % 2 else 0, 0) for i in range(20)] * 2, labels.schema
    )
    one_value = fit_chain(table, some_null)
    assert {r.chain.toxic for r in one_value.probabilities(table).collect()} == {0.0}


def test_query_finds_the_labelled_documents(spark):
    rows = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, DATA).collect()}
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    wrong = sum(rows[r.doc_id].rejected != bool(r.toxic) for r in labels)
    assert wrong <= 0.02 * len(labels)


def invented(source, count):
    return [f"w{source.randrange(3000)}" for _ in range(count)]


@pytest.fixture(scope="module")
def by_stem(spark):
    """A chain trained on texts whose toxic words share a stem but hardly ever recur."""
    source = random.Random(9)
    texts, labels = [], []
    for i in range(500):
        text = invented(source, source.choice([20, 60, 200]))
        if i % 5 == 0:
            text[3:3] = [f"boco{source.randrange(10**6)}" for _ in range(2)]
        texts.append(" ".join(text))
        labels.append((i, 0, int(i % 5 == 0)))
    frame = spark.createDataFrame(labels, "doc_id long, low_quality int, toxic int")
    return fit_chain(docs(spark, texts), frame)


def test_long_clean_texts_are_kept(spark, by_stem):
    source = random.Random(10)
    texts = [" ".join(invented(source, n)) for n in [50, 500, 5000, 20000] * 10]
    assert not_toxic(docs(spark, texts), by_stem).count() == len(texts)


def test_unseen_words_of_a_toxic_stem(spark, by_stem):
    source = random.Random(11)
    texts = [" ".join([*invented(source, n), f"boco{n}x", f"boco{n}y"]) for n in range(20, 60)]
    assert not_toxic(docs(spark, texts), by_stem).count() == 0


def brute_fit(dense, counted, names, y, least=5, false_marks=0.05):
    """The linear model by its definition: all marks as columns, plain gradient steps."""
    n, base = len(y), dense.shape[1] + 1
    seen, spread = (counted > 0).sum(axis=0), counted.std(axis=0)
    usable = np.flatnonzero((seen >= least) & (spread > 0))
    rate = y.mean()
    limit = (rate * (1 - rate) / n) ** 0.5 * NormalDist().inv_cdf(1 - false_marks / 2 / len(usable))
    # Of equal columns the longest mark.
    best = {}
    for j in usable:
        other = best.setdefault(counted[:, j].tobytes(), j)
        if len(names[j]) > len(names[other]):
            best[counted[:, j].tobytes()] = j
    usable = np.array(sorted(best.values()))
    x = np.hstack([np.ones((n, 1)), dense, counted[:, usable]])
    penalty = np.concatenate([np.zeros(base), limit * spread[usable]])
    curvature = np.concatenate([[0], np.full(base - 1, 1e-4), np.zeros(len(usable))])
    w = accelerated(x, y, penalty, curvature)
    chosen = np.concatenate([np.full(base, True), np.abs(w[base:]) > 1e-6])
    prior = np.full(chosen.sum(), 1 / (9 * n))
    prior[0] = 0
    fitted = accelerated(x[:, chosen], y, np.zeros(chosen.sum()), prior)
    weights = np.zeros(base + len(names))
    weights[:base] = fitted[:base]
    weights[base + usable[chosen[base:]]] = fitted[base:]
    return weights


def accelerated(x, y, penalty, curvature):
    # Columns of one scale, or the steps would be tiny.
    scale = np.sqrt((x * x).mean(axis=0))
    x, penalty, curvature = x / scale, penalty / scale, curvature / scale**2
    step = 1 / (np.linalg.norm(x, 2) ** 2 / 4 / len(y) + curvature.max())
    w = at = np.zeros(x.shape[1])
    momentum = 1.0
    for _ in range(20_000):
        slope = x.T @ (logistic(x @ at) - y) / len(y) + curvature * at
        new = at - step * slope
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        if (at - new) @ (new - w) > 0:
            momentum = 1.0  # start the momentum anew
        following = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        at, moved = new + (momentum - 1) / following * (new - w), np.abs(new - w).max()
        w, momentum = new, following
        if moved < 1e-10:
            break
    return w / scale


def test_chain_equals_a_dense_fit(spark):
    """Support, weights, out-of-fold log odds and probabilities from their definitions."""
    table, labels, truth = corpus(spark, 150)
    chain = fit_chain(table, labels)
    rows = {r.doc_id: r.chain for r in chain.probabilities(table).collect()}
    source = sorted(table.select("doc_id", "text").collect())
    found = [marks(r.text) for r in source]
    names = sorted({name for counts, _ in found for name in counts})
    counted = np.array([[min(c.get(n, 0), MOST) for n in names] for c, _ in found], float)
    lengths = np.log1p([[size] for _, size in found])
    order = {r.doc_id: r.fold for r in table.select(
        "doc_id", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3)).alias("fold")).collect()}
    fold = np.array([order[r.doc_id] for r in source])
    y = np.array([t[1:] for t in sorted(truth)], float)
    dense = trained = lengths
    for place, name in enumerate(("low_quality", "toxic")):
        held_out = np.zeros(len(y))
        for f in range(3):
            used, ones = fold != f, np.ones(((fold == f).sum(), 1))
            w = brute_fit(dense[used], counted[used], names, y[used, place])
            held_out[~used] = logistic(np.hstack([ones, dense[~used], counted[~used]]) @ w)
        w = brute_fit(dense, counted, names, y[:, place])
        expected = logistic(np.hstack([np.ones((len(y), 1)), trained, counted]) @ w)
        got = np.array([rows[r.doc_id][name] for r in source])
        assert np.abs(got - expected).max() < 1e-3
        dense = np.hstack([dense, log_odds(held_out)[:, None]])
        trained = np.hstack([trained, log_odds(expected)[:, None]])


def test_earlier_category_helps(spark):
    """Toxic texts are some of the junk, and junk has one of many marks: each mark says too
    little about toxicity alone, the junk model knows them all."""
    source = random.Random(12)
    texts, labels = [], []
    for i in range(1800):
        text = [f"w{source.randrange(300)}" for _ in range(20)]
        junk = source.random() < 0.5
        if junk:
            text[3] = f"{source.randrange(20):02d}junk"  # no common beginning
        toxic = junk and source.random() < 0.35
        texts.append(" ".join(text))
        labels.append((i, int(junk), int(toxic)))
    table = docs(spark, texts)
    frame = spark.createDataFrame(labels, "doc_id long, low_quality int, toxic int")
    train = frame.filter("doc_id < 1200")

    def loss(chain):
        rows = {r.doc_id: r.chain.toxic for r in chain.probabilities(table).collect()}
        chances = np.array([rows[i] if t else 1 - rows[i] for i, _, t in labels if i >= 1200])
        return -np.log(np.maximum(chances, 1e-9)).mean()

    chained, alone = fit_chain(table, train), fit_chain(table, train, categories=("toxic",))
    assert chained.models[1].linear.dense[1] > 0.2
    assert loss(chained) < loss(alone) - 0.03


def test_labels_decide_where_there_are_any(spark, fitted):
    table, truth, chain = fitted
    other = spark.createDataFrame(
        [(0, None, 1), (1, 0, 0), (1, 0, 1), (4, 0, None), (None, 0, 1), (4, 1, 0)],
        "doc_id long, low_quality int, toxic int",
    )
    without = {r.doc_id for r in not_toxic(table, chain).collect()}
    kept = not_toxic(table, chain, labels=other)
    assert kept.schema == table.schema
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids))
    assert set(ids) ^ without == {1, 4} and 4 in ids and 1 not in ids
    assert not_toxic(docs(spark, []), chain, labels=other).count() == 0


def test_slices_of_a_long_text_count_together(monkeypatch, fitted):
    _, _, chain = fitted
    text = "Clot w1\tw2 !!! oaf clotted w3 " * 5 + "été"
    whole, scores = marks(text), Scorer(chain.models, chain.lengths)(text)
    monkeypatch.setattr(toxicity, "SLICE", 7)
    assert marks(text) == whole and Scorer(chain.models, chain.lengths)(text) == scores


@pytest.fixture(scope="module")
def held_out(spark):
    """Of a fifth of the labelled rows of a larger table, kept from training: (toxic, rejected)
    by language."""
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    labels = toxicity.standard_labels(spark.read.parquet(f"{folder}/labels.parquet"))
    apart = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(5)) == 0
    chain = fit_chain(table, labels.filter(~apart))
    rows = chain.probabilities(table.join(labels.filter(apart), "doc_id")).select(
        "lang", "toxic", (F.col("chain.toxic") >= chain.limit("toxic")).alias("rejected")
    )
    found = {}
    for r in rows.collect():
        found.setdefault(r.lang, []).append((bool(r.toxic), r.rejected))
    return found


def test_held_out_texts_of_every_language(held_out):
    assert sorted(held_out) == ["de", "en", "es", "fr"]
    every = [pair for pairs in held_out.values() for pair in pairs]
    for pairs in held_out.values():
        clean = [rejected for toxic, rejected in pairs if not toxic]
        assert sum(clean) <= 0.02 * len(clean)
    # Some labelled ones have no toxic word at all.
    caught = [rejected for toxic, rejected in every if toxic]
    assert sum(caught) >= 0.9 * len(caught)


def test_the_sample_travels_packed_and_unpacks_whole(spark):
    source = random.Random(6)
    texts = ["", None, *[" ".join(f"w{source.randrange(400)}" for _ in range(300)) for _ in range(60)]]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(len(texts))], "doc_id long, low_quality int, toxic int")
    rows = toxicity.training_rows(
        docs(spark, texts), labels, ("low_quality", "toxic"), "doc_id", "text", 1000, 10**9, 3
    )
    names = toxicity._names(rows, 5)
    table = toxicity._numbered(rows, names).toArrow()
    order = np.argsort(table["row"].to_numpy(), kind="stable")
    sample = toxicity._sample(table, order)
    by_row = {r.row: r.text for r in rows.collect()}
    for i, row in enumerate(table["row"].to_numpy()[order]):
        at = slice(sample.starts[i], sample.starts[i + 1])
        found = {names[n]: c for n, c in zip(sample.numbers[at], sample.counts[at].tolist())}
        known = marks(by_row[row])[0].items()
        assert found == {m: min(c, MOST) for m, c in known if m in set(names)}
    assert table["marks"].nbytes < 0.6 * (sample.numbers.nbytes + sample.counts.nbytes)
