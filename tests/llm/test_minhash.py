import random
from collections import defaultdict

import pandas as pd
import pytest

from ebbtide.llm import minhash
from ebbtide.llm.graph import components
from ebbtide.llm.minhash import near_groups
from ebbtide.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.helpers import AWKWARD, docs


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(pairs, width, percent):
    """id to (set size, component), by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, width) for i, t in pairs}
    index = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            index[x].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for b in index[x]:
                if b > a:
                    shared[b] += 1
        for b, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    smallest = {}
    for i in sorted(sets):
        smallest.setdefault(root(i), i)
    return {i: (len(sets[i]), smallest[root(i)]) for i in sets}


def found(rows):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_whole_table_equals_brute_force(spark):
    frame = pd.read_parquet(f"{DATA}/documents.parquet")
    rows = QUERIES["op3_minhash"](spark, DATA).collect()
    assert len(rows) == len(frame)
    assert found(rows) == brute(list(zip(frame.doc_id, frame.text)), 4, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def family_texts(seed):
    """Families of near copies, chains, and texts that only share a long passage."""
    source = random.Random(seed)
    word = lambda: "w" + str(source.randrange(5000))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(6):
        base = [word() for _ in range(source.randrange(40, 120))]
        for _ in range(source.randrange(1, 12)):
            copy = list(base)
            for _ in range(source.randrange(0, 4)):
                copy[source.randrange(len(copy))] = word()
            texts.append(copy)
        for _ in range(4):  # a chain that drifts away
            base = list(base)
            base[source.randrange(len(base))] = word()
            texts.append(base)
    for _ in range(40):
        texts.append(passage + [word() for _ in range(source.randrange(3, 30))])
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("small_cell", [16, 1])
def test_families_and_shared_passages(spark, monkeypatch, small_cell):
    # With cells of one member called small, everything goes through the prefix join.
    monkeypatch.setattr(minhash, "SMALL_CELL", small_cell)
    texts = family_texts(1) + family_texts(2)
    table = docs(spark, texts).repartition(3)
    rows = near_groups(table, width=5).collect()
    assert found(rows) == brute(list(enumerate(texts)), 5, 80)


def test_awkward_rows(spark):
    rows = near_groups(docs(spark, AWKWARD), width=4).collect()
    got = sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.kept) for r in rows)
    assert got == sorted(
        [
            ("0", 0, "0", True),
            ("1", 0, "1", True),
            ("2", 0, "2", True),
            ("3", 1, "3", True),
            ("4", 1, "4", True),
            ("100", 1, "100", True),
            ("100", 1, "100", True),
            ("101", 1, "100", False),
            ("None", 1, "None", True),
            ("102", 5, "102", True),
        ]
    )
    assert near_groups(docs(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {tuple(r) for r in rows} == {(i, 10) for i in range(10, 61)} | {
        (i, 100) for i in range(100, 150)
    }
