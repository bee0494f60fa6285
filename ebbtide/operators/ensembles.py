"""Scores of many boosted-tree models in one pass.

The nodes of all trees of a model are laid out in arrays (``roots``, ``feature``, ``limit``,
``left``, ``right``, ``value``, and the ``depth`` of the deepest tree), sent to the tasks once,
and a batch of rows walks the trees of its models level by level.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The worker function travels by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that walk the trees together: their nodes stay in the cache of a core.
BLOCK_ROWS = 256


def leaves(trees: dict, rows: np.ndarray) -> np.ndarray:
    """Node where each row (first axis) ends in each tree (second axis).

    A node holds a feature, a limit and two children; up to the limit a row goes left, NaN
    goes right. A leaf is its own child on both sides, so walking on changes nothing.
    """
    flat = np.ascontiguousarray(rows).ravel()
    row = (np.arange(len(rows)) * rows.shape[1])[:, None]
    feature = trees["feature"].astype(np.intp)
    sides = np.stack([trees["right"], trees["left"]], axis=1).astype(np.intp).ravel()
    node = np.repeat(trees["roots"].astype(np.intp)[None, :], len(rows), axis=0)
    for _ in range(trees["depth"]):
        small = flat.take(row + feature.take(node)) <= trees["limit"].take(node)
        node = sides.take(2 * node + small)
    return node


def margins(trees: dict, rows: np.ndarray) -> np.ndarray:
    """Sum of the values of the leaves that every row reaches."""
    found = np.zeros(len(rows))
    if not len(trees["roots"]):
        return found
    for start in range(0, len(rows), BLOCK_ROWS):
        block = rows[start : start + BLOCK_ROWS]
        # A sum per row: equal rows get equal scores in any batch.
        found[start : start + len(block)] = trees["value"][leaves(trees, block)].sum(1)
    return found


def ensemble_probability(
    spark: SparkSession, models: dict[int, dict], number: Column, features: Column
) -> Column:
    """Probability of class 1 from the model that ``number`` names (arrays of its
    trees), for an array of its features; NULL where there is no such model."""
    sent = spark.sparkContext.broadcast(models)

    def score(numbers: pd.Series, rows: pd.Series) -> pd.Series:
        result = pd.Series(None, index=rows.index, dtype=object)
        for key, held in rows.groupby(numbers, sort=False):
            trees = sent.value.get(int(key))
            if trees is None:
                continue
            total = margins(trees, np.stack(held.to_list()).astype(float))
            result.loc[held.index] = 1.0 / (1.0 + np.exp(-total))
        return result

    return F.pandas_udf(score, "double")(number, features)
