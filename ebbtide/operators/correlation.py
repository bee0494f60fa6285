"""Pairwise-complete Pearson correlations of many columns in one pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)
# A spread this small against the mean square is rounding, not variation.
NO_SPREAD = 1e-12


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums over the rows of one partition in which both columns are present."""
    sums = None
    for batch in batches:
        values = batch.to_numpy(dtype=float, na_value=np.nan)
        seen = (~np.isnan(values)).astype(float)
        values = np.nan_to_num(values)
        part = (
            seen.T @ seen,
            values.T @ seen,
            (values * values).T @ seen,
            values.T @ values,
        )
        sums = part if sums is None else tuple(a + b for a, b in zip(sums, part))
    if sums is None:
        return
    n, x, xx, xy = sums
    i, j = np.indices(n.shape)
    yield pd.DataFrame(
        {
            "i": i.ravel(),
            "j": j.ravel(),
            "n": n.ravel(),
            "x": x.ravel(),
            "y": x.T.ravel(),
            "xx": xx.ravel(),
            "yy": xx.T.ravel(),
            "xy": xy.ravel(),
        }
    )


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows (feature_a, feature_b, correlation) of the full matrix.

    Each partition yields one row per pair of columns; rows of ``df`` are never
    paired or moved. A column without variation has NULL correlations. Columns are
    shifted by their smallest value first, which keeps the sums accurate.
    """
    names = columns or numeric_columns(df)
    smallest = df.agg(*[F.min(c).cast("double").alias(c) for c in names]).first()
    shifted = df.select(
        *[(F.col(c).cast("double") - F.lit(smallest[c] or 0.0)).alias(c) for c in names]
    )
    keys = ["i", "j"]
    parts = ["n", "x", "y", "xx", "yy", "xy"]
    schema = ", ".join([f"{k} int" for k in keys] + [f"{p} double" for p in parts])
    sums = (
        shifted.mapInPandas(_partial_sums, schema)
        .groupBy(*keys)
        .agg(*[F.sum(p).alias(p) for p in parts])
    )
    n = F.col("n")

    def spread(square: str, total: str):
        amount = n * F.col(square) - F.col(total) * F.col(total)
        return F.when(amount > n * F.col(square) * NO_SPREAD, amount)

    both = F.sqrt(spread("xx", "x")) * F.sqrt(spread("yy", "y"))
    value = (n * F.col("xy") - F.col("x") * F.col("y")) / both
    labels = F.array(*[F.lit(c) for c in names])
    return sums.select(
        F.get(labels, F.col("i")).alias("feature_a"),
        F.get(labels, F.col("j")).alias("feature_b"),
        # least and greatest skip NULLs, so a missing value is kept apart.
        F.when(
            value.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))
        ).alias("correlation"),
    )


def top_correlations(matrix: DataFrame, target: str, k: int = 15) -> DataFrame:
    """The k features with the largest absolute correlation with ``target`` (itself
    included)."""
    return (
        matrix.where((F.col("feature_a") == target) & F.col("correlation").isNotNull())
        .select(
            F.col("feature_b").alias("feature"),
            F.abs("correlation").alias("abs_correlation"),
        )
        .orderBy(F.desc("abs_correlation"), "feature")
        .limit(k)
    )
