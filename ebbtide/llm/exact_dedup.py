"""Exact duplicates by content hash, with the bytes compared inside every hash group.

Texts are grouped by a 128-bit hash *and* the text itself, so two different texts
with one hash end in different groups. The aggregation combines copies before the
shuffle; a text shared by a third of all rows therefore reaches its group as one row
per input partition. The decisions then join back on the hash alone: that side
carries no texts, and adaptive execution splits the partition of a hot hash.

Defined results: a NULL text is an empty text and groups with empty ones. A NULL id
never becomes the kept id while another id exists; a group of NULL ids only has the
kept id NULL and keeps its rows. Rows that repeat an id together with its text count
in ``group_size`` and share one decision. An empty table gives no rows. Only the id
and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.session import stored


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; NULL becomes the empty text.

    ``lower`` does the same for texts of one byte per character and is much faster
    than ``translate``.
    """
    text = F.coalesce(text, F.lit(""))
    one_byte = F.octet_length(text) == F.char_length(text)
    return F.when(one_byte, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise=ascii_lower,
    digest=lambda text: F.unhex(F.md5(text)),
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept and text_sha256.

    ``keep`` names the id that stays, "smallest" or "largest". ``digest`` is the
    grouping hash; any other one, even a constant, gives the same result.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    base = docs.select(F.col(id_col).alias("id"), normalise(F.col(text_col)).alias("body"))
    hashed = base.withColumn("hash", digest(F.col("body")))
    texts = hashed.groupBy("hash", "body").agg(
        best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # One row per hash: the decision, and whether the hash stands for several texts.
    by_hash = stored(
        texts.groupBy("hash").agg(
            F.count(F.lit(1)).alias("texts"),
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
        )
    )
    result = _decided(
        hashed.select("id", "hash", F.sha2("body", 256).alias("text_sha256")).join(
            by_hash.filter("texts = 1").drop("texts"), "hash"
        )
    )
    shared = by_hash.filter("texts > 1").select("hash")
    if not shared.isEmpty():
        clashing = hashed.join(shared, "hash", "left_semi")
        decisions = texts.join(shared, "hash", "left_semi")
        result = result.unionByName(
            _decided(
                clashing.join(decisions, ["hash", "body"]).withColumn(
                    "text_sha256", F.sha2("body", 256)
                )
            )
        )
    return result.withColumnRenamed("id", id_col)


def _decided(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def without_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row of every text, with all its columns: that of the id that stays.

    Of rows that repeat the id (or NULL) together with the text, the one whose columns are
    first as JSON stays. Only rows of such groups are grouped; all others pass by joins on
    ids and hashes that carry no text.
    """
    groups = stored(exact_groups(docs, id_col, text_col, keep).filter("group_size > 1"))
    keys = groups.select(F.col(id_col).alias("gone_id"), F.col("text_sha256").alias("gone_sha256"), "kept")
    gone = keys.filter("NOT kept").drop("kept").distinct()
    repeated = stored(
        keys.filter("kept")
        .groupBy("gone_id", "gone_sha256")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .drop("rows")
    )
    sha256 = F.sha2(ascii_lower(docs[text_col]), 256)

    def matches(side: DataFrame) -> Column:
        return docs[id_col].eqNullSafe(side["gone_id"]) & (sha256 == side["gone_sha256"])

    if repeated.isEmpty():
        return docs.join(gone, matches(gone), "left_anti")
    several = gone.unionByName(repeated)
    rows = docs.join(repeated, matches(repeated), "left_semi")
    whole = F.struct(*(rows[c] for c in docs.columns))
    first = rows.groupBy(rows[id_col].alias("id"), F.md5(ascii_lower(rows[text_col])).alias("hash"), ascii_lower(rows[text_col]).alias("body")).agg(
        F.min_by(whole, F.to_json(whole)).alias("row")
    )
    return docs.join(several, matches(several), "left_anti").unionByName(
        first.select("row.*").to(docs.schema)
    )
