"""Operators that need one global order, without a single-partition window.

All of them range-partition the rows by the sort key, number the rows inside each
partition and add up what lies before the partition. The sort key should end in
columns that make it unique, so that even one value shared by most rows spreads over
many partitions. The numbered rows are written to the checkpoint folder before they
are read again: partition numbers are only meaningful for one physical layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import broadcast_checked, pinned

# monotonically_increasing_id() puts the partition number above this bit.
PARTITION_BITS = 33
PLACE = "_place"
SLICE = "_slice"


def numbered(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys``, with its place and slice."""
    ordered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(PLACE, F.monotonically_increasing_id())
    )
    return pinned(
        ordered.withColumn(SLICE, F.shiftright(PLACE, PARTITION_BITS).cast("int"))
    )


def with_rank(
    df: DataFrame, keys: Sequence[Column], group: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Add the 1-based rank by ``keys`` and the number of rows, per ``group``.

    The offsets hold at most one row per slice plus one per group; they are broadcast
    only after a check of their number.
    """
    rows = numbered(df, [*[F.col(g) for g in group], *keys])
    starts = rows.groupBy(*group, SLICE).agg(
        F.count("*").alias("_rows"), F.min(PLACE).alias("_first")
    )
    before = Window.partitionBy(*group).orderBy(SLICE)
    offsets = starts.select(
        *[F.col(g).alias(f"_{g}") for g in group],
        F.col(SLICE).alias("_at"),
        (F.sum("_rows").over(before) - F.col("_rows") - F.col("_first") + 1).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(*group)).alias(f"{name}_rows"),
    )
    match = F.col(SLICE) == F.col("_at")
    for g in group:
        match &= F.col(g).eqNullSafe(F.col(f"_{g}"))
    return (
        rows.join(broadcast_checked(offsets), match)
        .withColumn(name, F.col(PLACE) + F.col("_shift"))
        .drop(PLACE, SLICE, "_at", "_shift", *[f"_{g}" for g in group])
    )


def with_running_sums(
    df: DataFrame, keys: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """Add ``cum_<c>`` (sum up to and with this row) and ``all_<c>`` for each column.

    ``keys`` must order the rows uniquely; callers aggregate to distinct keys first.
    """
    rows = numbered(df, keys)
    starts = rows.groupBy(SLICE).agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice: the only place where a window without partitions is used.
    offsets = starts.select(
        F.col(SLICE).alias("_at"),
        *[
            F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_before_{c}")
            for c in columns
        ],
        *[
            F.sum(f"_{c}").over(Window.partitionBy(F.lit(1))).alias(f"all_{c}")
            for c in columns
        ],
    )
    inside = (
        Window.partitionBy(SLICE)
        .orderBy(PLACE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.select(
        "*", *[F.sum(c).over(inside).alias(f"_inside_{c}") for c in columns]
    )
    return (
        summed.join(broadcast_checked(offsets), F.col(SLICE) == F.col("_at"))
        .select(
            *df.columns,
            *[(F.col(f"_before_{c}") + F.col(f"_inside_{c}")).alias(f"cum_{c}") for c in columns],
            *[f"all_{c}" for c in columns],
        )
    )


def forward_filled(
    df: DataFrame,
    keys: Sequence[Column],
    columns: Sequence[str],
    group: Sequence[str] = (),
) -> DataFrame:
    """Replace NULLs by the last non-NULL value before them in the order of ``keys``,
    within ``group`` (few values) when given."""
    rows = numbered(df, [*[F.col(g) for g in group], *keys])
    ends = rows.groupBy(SLICE, *group).agg(
        *[
            F.max(F.when(F.col(c).isNotNull(), F.struct(PLACE, F.col(c).alias("v")))).alias(
                f"_end_{c}"
            )
            for c in columns
        ]
    )
    before = (
        Window.partitionBy(*group)
        .orderBy(SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = ends.select(
        F.col(SLICE).alias("_at"),
        *[F.col(g).alias(f"_{g}") for g in group],
        *[
            F.last(F.col(f"_end_{c}")["v"], ignorenulls=True).over(before).alias(f"_carry_{c}")
            for c in columns
        ],
    )
    inside = Window.partitionBy(SLICE, *group).orderBy(PLACE)
    filled = rows.select(
        "*",
        *[F.last(c, ignorenulls=True).over(inside).alias(f"_last_{c}") for c in columns],
    )
    match = F.col(SLICE) == F.col("_at")
    for g in group:
        match &= F.col(g).eqNullSafe(F.col(f"_{g}"))
    joined = filled.join(broadcast_checked(carried), match)
    return joined.select(
        *[
            F.coalesce(f"_last_{c}", f"_carry_{c}").alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )
