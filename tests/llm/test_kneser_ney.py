import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ebbtide.llm import kneser_ney, minhash, textbatches
from ebbtide.llm.kneser_ney import gram_counts, log_probabilities, quality, train
from ebbtide.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.helpers import AWKWARD, docs

S, E = "\x02", "\x03"


class Brute:
    """Interpolated modified Kneser-Ney by its recursive definition."""

    def __init__(self, texts, order):
        self.order = order
        counts = {order: Counter()}
        for text in texts:
            signs = S * (order - 1) + text + E
            counts[order].update(
                signs[i : i + order] for i in range(len(signs) - order + 1)
            )
        for k in range(order - 1, 0, -1):
            counts[k] = Counter()
            for gram, c in counts[k + 1].items():
                if gram[0] == S and gram[1] == S:
                    counts[k][gram[1:]] += c
                else:
                    counts[k][gram[1:]] += 1
        self.counts = counts
        self.discounts = {}
        self.followers = {}
        for k, table in counts.items():
            n = [sum(c == i for c in table.values()) for i in range(1, 5)]
            if min(n) == 0:
                self.discounts[k] = [0.5, 1.0, 1.5]
            else:
                y = n[0] / (n[0] + 2 * n[1])
                found = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
                self.discounts[k] = [min(max(d, 0.0), i + 1.0) for i, d in enumerate(found)]
            self.followers[k] = defaultdict(list)
            for gram, c in table.items():
                self.followers[k][gram[:-1]].append(c)

    def taken(self, k, c):
        return self.discounts[k][min(c, 3) - 1]

    def p(self, context, sign):
        k = len(context) + 1
        if k == 1:
            lower = 1 / (len(self.counts[1]) + 1)
        else:
            lower = self.p(context[1:], sign)
        seen = self.followers[k].get(context)
        if not seen:
            return lower
        total = sum(seen)
        share = max(sum(self.taken(k, c) for c in seen) / total, 1e-12)
        c = self.counts[k].get(context + sign, 0)
        rest = c - self.taken(k, c) if c else 0.0
        return rest / total + share * lower

    def log_prob(self, text):
        signs, n = S * (self.order - 1) + text + E, self.order - 1
        return sum(math.log(self.p(signs[i - n : i], signs[i])) for i in range(n, len(signs)))


def sample(count, seed, letters="abcde "):
    source = random.Random(seed)
    return ["".join(source.choice(letters) for _ in range(source.randrange(60))) for _ in range(count)]


@pytest.mark.parametrize("order, block", [(4, 1 << 20), (3, 50), (2, 7)])
def test_equals_the_recursive_definition(spark, monkeypatch, order, block):
    monkeypatch.setattr(kneser_ney, "BLOCK_CHARS", block)
    monkeypatch.setattr(kneser_ney, "GROUP_CHARS", 500)
    trusted = [*sample(80, 1), "", "héé"]
    texts = [*sample(30, 2, "abcdef z\U0001f600"), "", "a" * 200, trusted[0]]
    weights = train(docs(spark, trusted).repartition(3), order)
    table = docs(spark, texts).repartition(2).selectExpr("doc_id AS id", "lang", "text")
    rows = {r.id: r for r in log_probabilities(table, weights, order).collect()}
    brute = Brute(trusted, order)
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert rows[i].signs == len(text) + 1
        assert rows[i].log_prob == pytest.approx(brute.log_prob(text), rel=1e-9)


def test_probabilities_sum_to_one():
    brute = Brute(sample(50, 3), 3)
    signs = [*brute.counts[1], "?"]
    for context in ("ab", "zz", S + S):
        assert sum(brute.p(context, s) for s in signs) == pytest.approx(1)


def test_gram_counts_with_very_many_letters():
    source = random.Random(5)
    parts = [
        np.array([0x4E00 + source.randrange(20000) for _ in range(9000)], np.uint32)
        for _ in range(3)
    ]
    for order in (2, 5):
        signs, owner, count = gram_counts(parts, order)
        expected = Counter(
            (tuple(p[i : i + order].tolist()), o)
            for o, p in enumerate(parts)
            for i in range(len(p) - order + 1)
        )
        found = {(tuple(s), o): c for s, o, c in zip(signs.tolist(), owner.tolist(), count.tolist())}
        assert found == dict(expected)


def test_awkward_rows(spark):
    table = docs(spark, [*AWKWARD, "a\x00b\x02c\x03"])
    trusted = spark.createDataFrame([(0,), (100,), (100,), (None,), (102,), (3,), (1,)], "doc_id long")
    rows = quality(table, trusted, order=3).collect()
    assert len(rows) == len(AWKWARD) + 1
    assert all(r.perplexity > 0 and r.kept in (True, False) for r in rows)
    assert quality(docs(spark, []), trusted).collect() == []
    without = quality(table, trusted.filter("doc_id < 0")).collect()
    assert {(r.perplexity, r.threshold, r.kept) for r in without} == {(None, None, True)}
    assert len(without) == len(rows)


def test_query_drops_junk_and_keeps_the_rest(spark):
    rows = {r.doc_id: r for r in QUERIES["op10_quality_ngram"](spark, DATA).collect()}
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    good = [rows[r.doc_id].kept for r in labels if r.quality == 1]
    junk = [rows[r.doc_id].kept for r in labels if r.quality == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(junk) <= 0.1 * len(junk)


def test_all_kinds_of_junk_go_at_a_larger_size(spark):
    folder = os.path.join(os.path.dirname(DATA), "sf0.1")
    rows = {r.doc_id: r for r in QUERIES["op10_quality_ngram"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    good = [rows[r.doc_id].kept for r in labels if r.quality == 1]
    assert sum(good) >= 0.98 * len(good)
    kept = defaultdict(list)
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text or "" for r in texts}
    for r in labels:
        if r.quality == 0:
            words = texts[r.doc_id].split()
            repeated = len(set(words)) * 4 <= len(words) and not texts[r.doc_id].isupper()
            kept[repeated].append(rows[r.doc_id].kept)
    counts = {k: (sum(v), len(v)) for k, v in kept.items()}
    print("good", sum(good), len(good), "junk", counts)
    assert all(n <= 0.1 * every for n, every in counts.values()), counts


def test_texts_and_counts_are_packed_and_come_back():
    texts = pa.array(["", None, "aé𝄞" * 50, "x"])
    packed = textbatches.packed_texts(texts)
    assert textbatches.unpacked_texts(packed).to_pylist() == texts.to_pylist()
    assert textbatches.unpacked_texts(texts) is texts
    sizes = np.random.default_rng(1).geometric(0.3, 20_000)
    data = kneser_ney._packed(kneser_ney._planes(sizes))
    assert (kneser_ney._from_planes(data, len(sizes)) == sizes).all()
    assert len(data) < 0.8 * len(kneser_ney._packed(sizes.astype("<u4")))


def test_training_texts_are_shuffled_packed(spark):
    docs = spark.createDataFrame([(i, None if i == 3 else "abc " * i) for i in range(9)], "id long, text string")
    ids = spark.createDataFrame([(2,), (3,), (2 + (1 << 40),)], "id long")
    found = minhash.rows_with_ids(docs, ids, packed=True)
    assert dict(found.dtypes)["text"] == "binary"
    rows = {r.id: r.text for r in found.collect()}
    assert textbatches.unpacked_texts(pa.array([rows[2], rows[3]], pa.binary())).to_pylist() == ["abc abc ", None]
    plain = minhash.rows_with_ids(docs, ids).select("text")
    one, other = (
        {r.gram: round(r.weight, 9) for r in kneser_ney.train(t, 2).collect()} for t in (plain, found)
    )
    assert one == other and len(rows) == 2
