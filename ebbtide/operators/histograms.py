"""Equal-width histograms and two-dimensional grids as grouped counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.session import broadcast_checked

BINS = 30


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin; bins are closed on the left, the last one on both sides."""
    width = (high - low) / float(bins)
    guess = F.least(
        F.floor((value - low) / (high - low) * float(bins)).cast("int"), F.lit(bins - 1)
    )
    # The division can land one bin off a limit; the limits themselves decide.
    return (
        F.when(value < low + guess * width, guess - 1)
        .when((value >= low + (guess + 1) * width) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )


def _limits(low: Column, high: Column) -> tuple[Column, Column]:
    """Value range, widened by one half to both sides when it is a single value."""
    single = low == high
    return (
        F.when(single, low - 0.5).otherwise(low),
        F.when(single, high + 0.5).otherwise(high),
    )


def histogram(
    df: DataFrame, value: Column, by: str | None = None, bins: int = BINS
) -> DataFrame:
    """Count and density of each of ``bins`` bins between the smallest and largest value.

    With ``by`` every class has its own range. ``by`` is a class label: the range
    table has one row per class and is sent to all tasks if it is small. Empty bins are
    listed.
    """
    label = F.col(by) if by else F.lit(0)
    values = df.select(label.alias("_by"), value.cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & F.col("_by").isNotNull()
    )
    low, high = _limits(F.min("_v"), F.max("_v"))
    ranges = values.groupBy("_by").agg(
        low.alias("_low"), high.alias("_high"), F.count("*").alias("_total")
    )
    counted = (
        values.join(broadcast_checked(ranges), "_by")
        .groupBy("_by", _bin(F.col("_v"), F.col("_low"), F.col("_high"), bins).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    width = (F.col("_high") - F.col("_low")) / float(bins)
    grid = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return grid.join(counted, ["_by", "bin"], "left").select(
        *([F.col("_by").alias(by)] if by else []),
        "bin",
        (F.col("_low") + F.col("bin") * width).alias("bin_low"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("bin_high"),
        n.alias("n"),
        (n / (F.col("_total") * width)).alias("density"),
    )


def grid_counts(
    df: DataFrame, x: str, y: str, by: str, bins: int = BINS
) -> DataFrame:
    """Occupied cells of a bins x bins grid over two columns, counted per class.

    Replaces a scatter of all points: the result has at most bins * bins rows per class.
    """
    points = df.select(
        F.col(by), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    ).where(F.col("_x").isNotNull() & F.col("_y").isNotNull() & F.col(by).isNotNull())
    ends = points.agg(F.min("_x"), F.max("_x"), F.min("_y"), F.max("_y")).first()

    def cell(name: str, low: float | None, high: float | None) -> Column:
        if low is None:
            return F.lit(0)
        if low == high:
            low, high = low - 0.5, high + 0.5
        return _bin(F.col(name), F.lit(low), F.lit(high), bins)

    return points.groupBy(
        by, cell("_x", ends[0], ends[1]).alias("x_bin"), cell("_y", ends[2], ends[3]).alias("y_bin")
    ).agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per distinct value, most frequent first; NULL values are not listed."""
    known = df.dropna(subset=list(columns))
    return (
        known.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *columns)
    )
