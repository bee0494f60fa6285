"""Corpus pipeline: from raw documents to packed training sequences.

Each stage works on all documents that the one before kept. All stages but the last
return the columns of ``documents``:

1. ``toxicity``: documents labelled toxic go, those labelled otherwise stay; of all others
   those go that the classifier chain rejects;
2. ``exact_dedup``: of equal texts (A-Z lower-cased) the smallest id stays, in one row;
3. ``near_dedup``: of each group of near duplicates (five words, 0.8) the smallest id stays;
4. ``secrets``: every secret in a text is replaced by ``[secret]``; no document goes;
5. ``packing``: tokenised pieces of sequences of 1024, one row per piece.

Defined results: a NULL text is an empty one; all empty texts are equal, and the one that stays
is packed as the id that ends a document. A NULL id never becomes the kept id while a text has
another one; near duplicates are not sought among NULL ids. Of rows that repeat an id with its text
one stays; rows that repeat an id with different texts are different documents, but they go
together if one of them is a near copy of a smaller id. Without usable labels (none, or NULLs) nothing is rejected as toxic; an empty ``documents``
table gives no rows. Columns beyond id and text may have any name and pass unchanged up to the
last stage (``n_chars`` is set anew by ``secrets``).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import exact_dedup, minhash, packing, secrets, toxicity
from ebbtide.session import stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = toxicity.standard_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.not_toxic(docs, toxicity.fit_chain(docs, labels), labels=labels)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_near_copies(docs, width=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.masked(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

# Classifiers, MinHash and tokenisers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
