"""The rows at given ranks of a composite order, without sorting the rows.

A random sample of the keys brackets every wanted rank. The bracket is accepted only after
an exact count of the keys below and inside it, so the sample decides how fast the search
ends but never its result. Once few keys are left inside, their distinct values are counted
and ordered. No row is range-partitioned, and only brackets and counts reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys inside a bracket that are counted and ordered at once, in one task.
FINAL_ROWS = 200_000
# Keys of a sample, ordered in one task.
SAMPLE_ROWS = 50_000
# Deviations of a sample's rank that a bracket leaves on both sides.
DEVIATIONS = 4.0


@dataclass
class _Target:
    rank: int
    # None where the bracket has no limit.
    low: Row | None
    high: Row | None
    below: int
    inside: int
    slack: float = DEVIATIONS
    # Whether a narrower bracket may still be found.
    open: bool = True

    @property
    def bracket(self) -> tuple[Row | None, Row | None]:
        return (self.low, self.high)


def key_literal(key: Row, kind: T.StructType) -> Column:
    return F.struct(*[F.lit(key[f.name]).cast(f.dataType).alias(f.name) for f in kind])


def _brackets(targets: Sequence[_Target]) -> dict[tuple, int]:
    """Numbers of the distinct brackets: targets that share one share its keys."""
    numbers: dict[tuple, int] = {}
    for t in targets:
        numbers.setdefault(t.bracket, len(numbers))
    return numbers


def _inside(key: Column, low: Row | None, high: Row | None, kind: T.StructType) -> Column:
    held = F.lit(True)
    if low is not None:
        held &= key >= key_literal(low, kind)
    if high is not None:
        held &= key <= key_literal(high, kind)
    return held


def _members(
    keys: DataFrame, numbers: dict[tuple, int], kind: T.StructType, chosen: dict[int, Column]
) -> DataFrame:
    """(b, k): every key once per bracket that holds it, if ``chosen`` of the bracket holds."""
    key = F.col("k")
    marks = [
        F.when(_inside(key, low, high, kind) & chosen.get(b, F.lit(True)), F.lit(b))
        for (low, high), b in numbers.items()
    ]
    # A projection of its own: a generator cannot hold random numbers.
    marked = keys.select("k", F.array_compact(F.array(*marks)).alias("bs"))
    return marked.select(F.explode("bs").alias("b"), "k")


def _sampled_limits(
    keys: DataFrame, targets: Sequence[_Target], kind: T.StructType, seed: int
) -> list[tuple[Row | None, Row | None]]:
    """For every target a narrower bracket around its rank in a sample; None for a limit
    beyond the sample."""
    numbers = _brackets(targets)
    sizes = {numbers[t.bracket]: t.inside for t in targets}
    chosen = {
        b: F.rand(seed + b) < min(1.0, SAMPLE_ROWS / rows) for b, rows in sizes.items()
    }
    ordered = (
        _members(keys, numbers, kind, chosen)
        .groupBy("b")
        .agg(F.sort_array(F.collect_list("k")).alias("s"))
    )
    asks = []
    for i, t in enumerate(targets):
        share = (t.rank - 1 - t.below) / t.inside
        size = F.size("s")
        # Deviation of the rank of one of ``size`` random keys.
        spread = F.sqrt(size * share * (1 - share)) * t.slack + t.slack
        for name, place in (
            (f"low{i}", F.floor(size * share - spread) - 1),
            (f"high{i}", F.ceil(size * share + spread) + 1),
        ):
            asks.append(F.get("s", place.cast("int")).alias(name))
    rows = {r["b"]: r for r in ordered.select("b", *asks).collect()}
    found = []
    for i, t in enumerate(targets):
        row = rows.get(numbers[t.bracket])
        found.append((row[f"low{i}"], row[f"high{i}"]) if row else (None, None))
    return found


def _narrow(keys: DataFrame, targets: list[_Target], kind: T.StructType) -> None:
    """Shrink the bracket of every target until few keys are left inside it."""
    key, seed = F.col("k"), 0
    while wide := [t for t in targets if t.open and t.inside > FINAL_ROWS]:
        seed += len(targets)
        limits = [
            (t.low if low is None else low, t.high if high is None else high)
            for t, (low, high) in zip(wide, _sampled_limits(keys, wide, kind, seed))
        ]
        checks = []
        for i, (low, high) in enumerate(limits):
            under = F.lit(False) if low is None else key < key_literal(low, kind)
            checks += [
                F.count(F.when(under, 1)).alias(f"l{i}"),
                F.count(F.when(_inside(key, low, high, kind), 1)).alias(f"m{i}"),
            ]
        seen = keys.agg(*checks).first()
        for i, (t, (low, high)) in enumerate(zip(wide, limits)):
            below, inside = seen[f"l{i}"], seen[f"m{i}"]
            if not below < t.rank <= below + inside:
                t.slack *= 2
                continue
            # A bracket that hardly shrinks consists of a few very frequent keys, which the
            # final step counts as one row each.
            t.open = inside <= t.inside / 2
            t.low, t.high, t.below, t.inside = low, high, below, inside


def _pick(
    keys: DataFrame, targets: Sequence[_Target], kind: T.StructType
) -> dict[int, Row]:
    numbers = _brackets(targets)
    counted = _members(keys, numbers, kind, {}).groupBy("b", "k").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("b").orderBy("k"))
    runs = counted.select("b", "k", "n", upto.alias("upto"))
    asked = [(numbers[t.bracket], t.rank - t.below, t.rank) for t in targets]
    hit = F.array_compact(
        F.array(
            *[
                F.when(
                    (F.col("b") == b)
                    & (F.col("upto") >= place)
                    & (F.col("upto") - F.col("n") < place),
                    F.lit(rank),
                )
                for b, place, rank in asked
            ]
        )
    )
    # One row per rank.
    found = runs.select(F.explode(hit).alias("rank"), "k").collect()
    return {r["rank"]: r["k"] for r in found}


def keys_at_ranks(
    keys: DataFrame, choose: Callable[[int], Sequence[int]]
) -> tuple[int, dict[int, Row]]:
    """Row count and the keys at the ranks ``choose(count)`` (1-based), in Spark's order of
    structs (NULL fields first).

    ``keys`` has one column ``k``, a struct. It is read once to count, once to order at most
    ``FINAL_ROWS`` keys, and twice per narrowing of a larger table: pass a stored frame.
    Repeated keys take as many ranks as they have rows.
    """
    kind = keys.schema["k"].dataType
    total = keys.count()
    ranks = sorted(set(choose(total))) if total else []
    targets = [_Target(r, None, None, 0, total) for r in ranks]
    _narrow(keys, targets, kind)
    return total, _pick(keys, targets, kind) if targets else {}
