from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from ebbtide.llm.exact_dedup import ascii_lower, exact_groups, without_copies
from ebbtide.llm.secrets import RULES
from tests.conftest import DATA
from tests.llm.helpers import AWKWARD, SCHEMA, docs
from tests.llm.test_minhash import brute


AWKWARD_PAIRS = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(AWKWARD)]


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before every stage, and the result of the last one."""
    from ebbtide.session import stored

    table = spark.read.parquet(f"{DATA}/documents.parquet")
    tables = [table]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], DATA)))
    return tables


def texts(table):
    return {r.doc_id: r.text for r in table.select("doc_id", "text").collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_dedup", "secrets", "packing",
    ]
    assert all(t.columns == stages[0].columns for t in stages[:-1])
    assert queries()["pipeline"] is corpus_pipeline.run


def test_toxic_documents_go(spark, stages):
    kept = texts(stages[1])
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    toxic = [r.doc_id in kept for r in labels if r.toxic]
    clean = [r.doc_id in kept for r in labels if not r.toxic]
    assert sum(toxic) <= 0.02 * len(toxic) and sum(clean) >= 0.98 * len(clean)


def test_of_copies_the_smallest_stays(stages):
    best = {}
    for i, text in sorted(texts(stages[1]).items(), reverse=True):
        best[lower(text)] = i
    assert set(texts(stages[2])) == set(best.values())


def test_of_near_copies_the_smallest_stays(stages):
    before = texts(stages[2])
    groups = brute(list(before.items()), 5, 80)
    assert set(texts(stages[3])) == {i for i, (_, root) in groups.items() if i == root}
    assert len(before) > len(texts(stages[3]))


def test_secrets_are_masked(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    masked = 0
    for i, text in after.items():
        for rule in RULES:
            for match in rule.compiled().finditer(text):
                assert match.end(rule.group) - match.start(rule.group) < rule.least
        masked += text != before[i]
        assert text == before[i] or "[secret]" in text
    assert masked > 0
    assert all(r.n_chars == len(r.text) for r in stages[4].select("n_chars", "text").collect())


def test_packed_pieces_hold_all_tokens(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces, used = defaultdict(list), defaultdict(int)
    for r in stages[5].collect():
        pieces[r.doc_id].append(r)
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 1024
    for i, text in texts(stages[4]).items():
        joined = b"".join(bytes(r.ids) for r in sorted(pieces[i], key=lambda r: r.start))
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert np.frombuffer(joined, "<u4").tolist() == ids


def test_exact_groups_of_awkward_rows(spark):
    table = docs(spark, AWKWARD)
    rows = exact_groups(table).collect()
    assert sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.kept) for r in rows) == sorted(
        [
            ("0", "0", 2, True),
            ("1", "0", 2, False),
            ("2", "2", 1, True),
            ("3", "3", 1, True),
            ("4", "4", 1, True),
            ("100", "100", 3, True),
            ("100", "100", 3, True),
            ("101", "100", 3, False),
            ("None", "None", 1, True),
            ("102", "102", 1, True),
        ]
    )
    assert exact_groups(docs(spark, [])).collect() == []
    kept = without_copies(table)
    assert kept.schema == table.schema
    texts = [r.text for r in kept.collect()]
    # One row of each text: NULL is empty, and the repeated tie stays once.
    assert len(texts) == len(set(texts)) == len({t or "" for _, t in AWKWARD_PAIRS})
    more = docs(spark, [*AWKWARD, (None, "tie"), (3, "tie"), (None, "no id"), (None, "NO ID")])
    stays = [(r.doc_id, r.text) for r in without_copies(more, keep="largest").collect()]
    assert (101, "tie") in stays and (3, "One") in stays
    assert not {(None, "tie"), (3, "tie"), (100, "tie")} & set(stays)
    assert sum(i is None for i, _ in stays) == 1


def test_of_repeated_rows_the_first_by_its_columns_stays(spark):
    rows = [(7, "same", lang, s, "x", None, "y", 1) for lang, s in [("fr", "b"), ("en", "c"), ("en", "a")]]
    table = spark.createDataFrame(rows * 4 + [(8, "other", "en", "a", "x", None, "y", 1)], SCHEMA)
    kept = without_copies(table.repartition(5))
    assert sorted(map(tuple, kept.collect())) == sorted([rows[2], (8, "other", "en", "a", "x", None, "y", 1)])


def awkward_folder(path, documents, labels):
    documents.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


LABELS = "doc_id long, quality int, toxic int"


def test_awkward_documents_pass_all_stages(spark, tmp_path):
    """NULLs, ties, repeated rows, a very long text and clashing names; no labels at all."""
    table = docs(spark, [*AWKWARD, (7, "password = hunter2hunter2")] * 2)
    folder = awkward_folder(tmp_path, table, spark.createDataFrame([], LABELS))
    pieces = corpus_pipeline.run(spark, folder).collect()
    whole = defaultdict(int)
    for r in pieces:
        whole[r.doc_id] += r.length
    # Each of the different texts once; an empty one has just the id that ends a document.
    assert sorted(whole, key=repr) == sorted([0, 2, 3, 4, 7, 100, 102, None], key=repr)
    assert whole[0] == 1 and whole[102] > 100_000


@pytest.mark.parametrize("labels", [[], [(0, None, 1), (None, 1, 1), (1, 1, None)]])
def test_no_documents(spark, tmp_path, labels):
    folder = awkward_folder(tmp_path, docs(spark, []), spark.createDataFrame(labels, LABELS))
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_clashing_hashes_are_told_apart(spark):
    """With a constant hash all texts collide; the bytes still decide."""
    from pyspark.sql import functions as F

    table = docs(spark, ["b", "B", "c", None, "", "é", "É"])
    same = exact_groups(table, digest=lambda text: F.unhex(F.lit("00")))
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, exact_groups(table).collect()))


def test_only_ascii_letters_are_lowered(spark):
    from pyspark.sql import functions as F

    assert docs(spark, ["AÉİZ"]).select(ascii_lower(F.col("text"))).first()[0] == "aÉİz"
