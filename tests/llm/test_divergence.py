import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ebbtide.llm import divergence
from ebbtide.llm.divergence import digest64, source_divergence
from tests.llm.helpers import SCHEMA

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def table(spark, rows):
    """Documents from (text, lang, source)."""
    full = [(i, t, lang, source, "x", None, "y", 1) for i, (t, lang, source) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def brute(rows, least=3, top=200):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        terms = TERM.findall(lowered)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in counts}:
        kept = [t for t, c in docs[lang].items() if c >= least]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = sum(groups.values(), Counter())

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        by_source = {s: shares(c) for s, c in groups.items()}
        q = shares(whole)
        for s, p in by_source.items():
            pairs = [
                (sum((p[t] - o[t]) ** 2 // o[t] for t in kept), x)
                for x, o in by_source.items()
                if x != s
            ]
            terms = [
                ((p[t] - q[t]) ** 2 // q[t], t) for t in kept if groups[s][t] and p[t] > q[t]
            ]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda v: (-v[0], v[1].encode()))
                for rank, (value, item) in enumerate(found, 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def made(count=300, seed=1):
    source = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}é" for i in range(90)]
    rows = []
    for _ in range(count):
        lang, s = source.choice(["en", "fr"]), source.choice(["a", "b", "c", None, ""])
        size = source.choice([0, 3, 40])
        text = " ".join(words[int(source.paretovariate(0.7)) % 90] for _ in range(size))
        rows.append((text.upper() if source.random() < 0.3 else text, lang, s))
    return rows


AWKWARD = [
    (None, "de", "x"),
    ("", "de", "y"),
    ("one two", None, None),
    ("one ONE\x00one", None, "z"),
    ("one-one3É", "", "z"),
    ("lorem ipsum dolor " * 300_000, "la", "long"),  # longer than a slice
    ("ipsum", "la", "s"),
    ("ipsum", "la", "s"),  # repeated rows
    ("\U0001f600 alone", "solo", "s"),
]


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("rows", [made(), AWKWARD, []], ids=["made", "awkward", "empty"])
def test_equals_brute_force(spark, rows):
    got = result(source_divergence(table(spark, rows)))
    assert len(got) == len(set(got)) and set(got) == brute(rows)


@pytest.mark.parametrize(
    "digest", [lambda data: 7, lambda data: digest64(data) % 40], ids=["constant", "few"]
)
def test_shared_digests_are_split(spark, digest):
    rows = made() + AWKWARD
    assert set(result(source_divergence(table(spark, rows), digest=digest))) == brute(rows)


def test_small_tiles_and_blocks_of_sources(spark):
    rows = made(400, 2)
    df = source_divergence(table(spark, rows), tile_cells=20, source_block=2, top=5)
    assert set(result(df)) == brute(rows, top=5)


def test_counts_of_a_very_large_corpus():
    """Beyond the range where a count times 10**9 fits a long."""
    counts = [10**15, 5, 0, 10**15 + 7]
    cells = pa.table(
        {"lang_key": [1] * 3, "a": [0] * 3, "b": [0] * 3, "key": [1, 1, 2], "part": [0] * 3,
         "place": [0, 1, 1], "count": [counts[0], counts[1], counts[3]]}
    )
    n = [10**15, 10**15 + 12]
    sources = pa.table({"place": [0, 1], "n": n, "terms": [2, 2]})
    out = divergence._tile_sums(cells, sources, 256)
    p = [[1 + 10**9 * (c + 1) // (m + 2) for c in pair] for pair, m in zip(([counts[0], 0], [5, counts[3]]), n)]
    expected = sum((x - y) ** 2 // y for x, y in zip(*p))
    got = dict(zip(zip(out["place"].to_pylist(), out["other"].to_pylist()), out["value"].to_pylist()))
    assert got[0, 1] == expected and np.all(np.array(out["seen"]) == 2)
