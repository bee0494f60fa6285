"""Exact quantiles of many columns at once, and quintile scores.

``percentile`` keeps every distinct value of a column in one aggregation buffer,
which a continuous column of a large table would overflow. Here an approximate
quantile first brackets the wanted position; only the values between the brackets
are then counted, so the exact step works on a small rest whatever the table size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.scalars import bucket_by_edges, double_text, quoted
from ebbtide.operators.selection import key_literal, keys_at_ranks

# Values that one (column, quantile) may leave for the final ordered count.
FINAL_ROWS = 1_000_000
ACCURACY = 10_000
# Place of a row's group among all groups.
PLACE = "_group_place"


@dataclass
class _Target:
    # None where the rows are not grouped.
    group: int | None
    column: str
    prob: float
    rows: int
    low: float
    high: float
    below: int
    inside: int

    @property
    def position(self) -> float:
        return (self.rows - 1) * self.prob

    @property
    def open(self) -> bool:
        return self.low < self.high


def _per_group(
    targets: Sequence[_Target], group: str | None, make: Callable[[_Target], Column]
) -> Column:
    """``make`` of the target of a row's group; NULL for groups without one."""
    if group is None:
        return make(targets[0])
    return reduce(
        lambda chain, t: chain.when(F.col(group) == t.group, make(t)),
        targets[1:],
        F.when(F.col(group) == targets[0].group, make(targets[0])),
    )


def _rows_by_group(df: DataFrame, group: str | None, asks: Sequence[Column]) -> dict:
    if group is None:
        return {None: df.agg(*asks).first()}
    return {r[group]: r for r in df.groupBy(group).agg(*asks).collect()}


def _narrow(df: DataFrame, targets: list[_Target], group: str | None) -> None:
    """Shrink the bracket of every target that still holds too many rows."""
    wide = [t for t in targets if t.open and t.inside > FINAL_ROWS]
    slack_of = {id(t): 2.0 for t in wide}
    while wide:
        # One expression per column and quantile, whatever the number of groups.
        sets: dict[tuple, list[_Target]] = {}
        for t in wide:
            sets.setdefault((t.column, t.prob), []).append(t)
        asks = []
        for i, held in enumerate(sets.values()):
            value = F.col(held[0].column).cast("double")
            shares = []
            for t in held:
                share = (t.position - t.below) / t.inside
                slack = slack_of[id(t)] / ACCURACY + 2.0 / t.inside
                shares += [max(0.0, share - slack), min(1.0, share + slack)]

            def inner(t: _Target, value: Column = value) -> Column:
                return (
                    value
                    if math.isinf(t.low)
                    else F.when(value.between(t.low, t.high), value)
                )

            asks.append(
                F.percentile_approx(
                    _per_group(held, group, inner), shares, ACCURACY
                ).alias(f"b{i}")
            )
        found = _rows_by_group(df, group, asks)
        limits: dict[int, tuple[float, float]] = {}
        checks = []
        for i, held in enumerate(sets.values()):
            value = F.col(held[0].column).cast("double")
            for place, t in enumerate(held):
                bounds = found[t.group][f"b{i}"]
                limits[id(t)] = (bounds[2 * place], bounds[2 * place + 1])

            def under(t: _Target, value: Column = value) -> Column:
                return F.when(value < limits[id(t)][0], 1)

            def within(t: _Target, value: Column = value) -> Column:
                return F.when(value.between(*limits[id(t)]), 1)

            checks += [
                F.count(_per_group(held, group, under)).alias(f"l{i}"),
                F.count(_per_group(held, group, within)).alias(f"m{i}"),
            ]
        seen = _rows_by_group(df, group, checks)
        again = []
        for i, held in enumerate(sets.values()):
            for t in held:
                low, high = limits[id(t)]
                below, inside = seen[t.group][f"l{i}"], seen[t.group][f"m{i}"]
                # Accept only a bracket that holds both neighbours of the position.
                holds = (
                    below <= math.floor(t.position)
                    and math.ceil(t.position) < below + inside
                )
                if not holds:
                    slack_of[id(t)] *= 4
                    again.append(t)
                    continue
                shrunk = inside < t.inside
                t.low, t.high, t.below, t.inside = low, high, below, inside
                # A bracket that stays the same consists of a few very frequent values,
                # which the final step counts as one row each.
                if shrunk and t.open and inside > FINAL_ROWS:
                    again.append(t)
        wide = again


@dataclass(frozen=True)
class ColumnQuantiles:
    rows: int
    values: list[float | None]


def _quantiles(
    df: DataFrame, group: str | None, columns: Sequence[str], probs: Sequence[float]
) -> dict[tuple, ColumnQuantiles]:
    # Positional names: a column may be called like the group.
    asks = [F.count(F.col(quoted(c))).alias(f"n{i}") for i, c in enumerate(columns)]
    counts = {
        (key, c): row[f"n{i}"]
        for key, row in _rows_by_group(df, group, asks).items()
        for i, c in enumerate(columns)
    }
    targets = [
        _Target(key, c, q, rows, -math.inf, math.inf, 0, rows)
        for (key, c), rows in counts.items()
        if rows
        for q in probs
    ]
    _narrow(df, targets, group)
    picked = _pick(df, [t for t in targets if t.open], group)
    found: dict[tuple, float] = {}
    for t in targets:
        name = (t.group, t.column, t.prob)
        low, high = picked.get(name, (t.low, t.low))
        part = t.position - math.floor(t.position)
        found[name] = low + (high - low) * part
    return {
        (key, c): ColumnQuantiles(rows, [found.get((key, c, q)) for q in probs])
        for (key, c), rows in counts.items()
    }


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, ColumnQuantiles]:
    """Linearly interpolated quantiles of the non-NULL values of each column.

    Two passes over ``df`` while a column has at most ``FINAL_ROWS`` values, two more
    per narrowing. Only counts and the wanted values reach the driver.
    """
    if not columns:
        return {}
    found = _quantiles(df, None, columns, probs)
    return {c: found[None, c] for c in columns}


def grouped_quantiles(
    df: DataFrame, group: str, columns: Sequence[str], probs: Sequence[float]
) -> dict[tuple[int, str], ColumnQuantiles]:
    """:func:`column_quantiles` within every value of the whole-number column ``group``
    (few values, none of them NULL), by (group, column). The number of passes does not
    depend on the number of groups."""
    return _quantiles(df, group, columns, probs) if columns else {}


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Only the values of :func:`column_quantiles` (None for a column without values)."""
    return {c: q.values for c, q in column_quantiles(df, columns, probs).items()}


def _pick(df: DataFrame, targets: list[_Target], group: str | None) -> dict[tuple, tuple]:
    """The values at both neighbours of every target position."""
    if not targets:
        return {}
    # Targets of one column that share a bracket share the counted values too.
    brackets: dict[tuple, int] = {}
    wanted = []
    for i, t in enumerate(targets):
        number = brackets.setdefault((t.group, t.column, t.low, t.high), len(brackets))
        for side, position in enumerate((math.floor(t.position), math.ceil(t.position))):
            wanted.append((number, int(position - t.below), i, side))
    # A row takes the brackets of its own group. Groups with the same bracket of a column,
    # such as the first one of all values, share an entry.
    keys = list(dict.fromkeys(t.group for t in targets))
    numbers: dict[tuple, list[str]] = {}
    for (key, column, low, high), number in brackets.items():
        held = numbers.setdefault((column, low, high), ["NULL"] * len(keys))
        held[keys.index(key)] = str(number)
    entries = []
    for (column, low, high), held in numbers.items():
        value = f"cast({quoted(column)} as double)"
        number = f"array({', '.join(held)})[{PLACE}]"
        inside = f"{value} BETWEEN {double_text(low)} AND {double_text(high)}"
        entries.append(f"IF({inside}, named_struct('b', {number}, 'v', {value}), NULL)")
    place = F.lit(0)
    if group is not None:
        place = reduce(
            lambda chain, at: chain.when(F.col(group) == keys[at], at),
            range(1, len(keys)),
            F.when(F.col(group) == keys[0], 0),
        )
    counted = (
        df.withColumn(PLACE, place)
        .selectExpr(f"inline(array_compact(array({', '.join(entries)})))")
        .where(F.col("b").isNotNull())
        .groupBy("b", "v")
        .agg(F.count("*").alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("b").orderBy("v"))
    runs = counted.select("b", "v", "n", upto.alias("upto"))
    # Two rows per group, column and quantile, so always small.
    rows = ", ".join(f"({b}, {position}L, {i}, {side})" for b, position, i, side in wanted)
    asked = df.sparkSession.sql(
        f"SELECT * FROM VALUES {rows} AS asked(b, position, target, side)"
    )
    hits = runs.join(F.broadcast(asked), "b").where(
        (F.col("position") < F.col("upto"))
        & (F.col("position") >= F.col("upto") - F.col("n"))
    )
    result: dict[tuple, list] = {}
    for row in hits.select("target", "side", "v").collect():
        t = targets[row["target"]]
        name = (t.group, t.column, t.prob)
        result.setdefault(name, [None, None])[row["side"]] = row["v"]
    return {key: tuple(pair) for key, pair in result.items()}


def value_quintile(df: DataFrame, column: str) -> Column:
    """Quintile 1-5 by value (right-closed); NULL when fewer than two values exist."""
    found = column_quantiles(df, [column], [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])[column]
    if found.rows < 2:
        return F.lit(None).cast("int")
    return bucket_by_edges(F.col(column), found.values)


def rank_quintile(df: DataFrame, column: str, ties: Sequence[str]) -> Column:
    """Quintile 1-5 of the rank by ``column``, ties ordered by ``ties`` (NULLs last).

    Only four rows mark the limits between the quintiles. They are selected by brackets,
    without a sort; scoring compares each row with these four and moves no data.
    """
    key = F.struct(
        F.col(column).alias("value"),
        *[
            part
            for tie in ties
            for part in (F.col(tie).isNull().alias(f"no_{tie}"), F.col(tie).alias(tie))
        ],
    )
    narrow = df.where(F.col(column).isNotNull()).select(key.alias("k"))

    def limits(rows: int) -> list[int]:
        return [k * (rows - 1) // 5 + 1 for k in range(1, 5)]

    total, found = keys_at_ranks(narrow, limits)
    if total < 2:
        return F.lit(None).cast("int")
    kind = narrow.schema["k"].dataType
    chain = F.when(F.col(column).isNull(), None)
    for quintile, rank in enumerate(limits(total), start=1):
        chain = chain.when(key <= key_literal(found[rank], kind), quintile)
    return chain.otherwise(5)
