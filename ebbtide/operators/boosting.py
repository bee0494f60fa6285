"""Boosted trees for many routes at once: one aggregation per tree level for all of them.

Second-order boosting for 0/1 labels on binned features. The rows of all routes lie in one
distributed set of blocks. Per level, every task adds up the gradients of its rows by
(route, node, feature, bin). Beyond ``DIRECT`` tasks the sums are added up in a shuffle by
(route, node); those of fewer tasks are small enough to be added up in the driver, which picks the
splits. The number of jobs therefore
follows the longest ensemble, not the number of routes. Rows are dealt to the tasks by ranges
of routes, so a task has the sums of few routes, and a level moves about
(tasks + routes) × nodes × features × bins of them, whatever the number of rows. Blocks hold the
bins feature by feature, so a level is a pass over one byte per row and drawn feature.

Rows find their nodes by masks, a compare of bytes per node, and two features are added up in one
table of their pairs of bins where enough rows share it, so half the additions do.

Of two children only the lighter one is added up: the other one has what remains of the sums of
their parent. Gradients are rounded to a step (some 2^-52 of the weight of a route) of which a
double holds every sum exactly, so the difference is exact too, and neither the order of the rows
nor the number of tasks changes a sum.

The margins of the rows are brought up to date by the first job of the next round. The blocks
with them stay in memory or on local disk, and every ``CUT`` rounds in the checkpoint folder,
so a lost executor costs at most so many rounds of its blocks. Rows are drawn per tree by the number
of their stored block, so a repeated task draws the same ones.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.params import BoostSpec
from ebbtide.session import pinned, shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CUT = 20
# Up to so many tasks the sums of a level go straight to the driver: some (tasks + routes) ×
# nodes × features × bins pairs of numbers (0.3 MB per task at 16 nodes of 34 features).
DIRECT = 48
# Rows that are worth a task of their own while other cores have none.
LEAST_ROWS = 25_000
# So many tasks that dealt the rows may become one of a level.
MERGED = 4
# Rows that are added up together, and how many of them a cell of a table of pairs must be worth.
ADDED_ROWS = 1 << 16
ROWS_PER_CELL = 2
# Bytes that a worker takes and frees once. glibc then hands later arrays of up to this size from
# memory that it keeps, where it would return that of every block and have it mapped anew.
KEPT_BYTES = 30 << 20
# Nodes of a tree whose numbers fit one byte.
BYTE_NODES = 255
# Penalty on squared leaf values, and least sum of second derivatives in a leaf.
LEAF_PENALTY = 1.0
LEAST_IN_LEAF = 1.0
# Error of the approximate quantiles that limit the bins, as one part in so many.
ACCURACY = 10_000
BLOCKS = "route int, block long, bins binary, label binary, weight binary"
# Blocks are read once a level: held as they are, so that no reader has to unpack them.
HELD = StorageLevel.MEMORY_AND_DISK_DESER


def bin_limits(
    rows: DataFrame, number: str, features: str, counts: dict[int, int], max_bins: int
) -> dict[int, list[np.ndarray]]:
    """Upper limits of the bins per route and feature: quantiles, at most ``max_bins`` - 1,
    from one aggregation for all routes."""
    shares = [k / max_bins for k in range(1, max_bins)]
    asks = []
    for place in range(max(counts.values())):
        value = F.get(F.col(features), F.lit(place))
        finite = F.when(~F.isnan(value), value)
        asks.append(F.percentile_approx(finite, shares, ACCURACY).alias(f"q{place}"))
    found = {r[number]: r for r in rows.groupBy(number).agg(*asks).collect()}
    if missing := counts.keys() - found.keys():
        raise ValueError(f"no rows for routes {sorted(missing)}")
    return {
        route: [
            np.unique(found[route][f"q{place}"] or []).astype(float) for place in range(count)
        ]
        for route, count in counts.items()
    }


def _binned(
    limits: dict[int, list[np.ndarray]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            routes, vectors, label, weight = batch.columns
            routes, label, weight = (
                c.to_numpy(zero_copy_only=False) for c in (routes, label, weight)
            )
            for route in np.unique(routes):
                at = np.flatnonzero(routes == route)
                rows = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                rows = rows.reshape(len(at), -1)
                bins = np.empty(rows.shape[::-1], dtype=np.uint8)
                for place, limit in enumerate(limits[int(route)]):
                    # Bin b: above limit b - 1, up to limit b; NaN comes last.
                    bins[place] = np.searchsorted(limit, rows[:, place])
                values = [
                    [int(route)],
                    [made],
                    [bins.tobytes()],
                    [label[at].astype(np.float64).tobytes()],
                    [weight[at].astype(np.float64).tobytes()],
                ]
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(values, kinds)],
                    names=["route", "block", "bins", "label", "weight"],
                )
                made += 1

    return blocks


@dataclass
class _Tree:
    """One tree over bins while it grows; a node without a split is its own child."""

    feature: list[int] = field(default_factory=lambda: [0])
    limit: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    depth: int = 0

    def add(self, value: float) -> int:
        node = len(self.value)
        for column, entry in (
            (self.feature, 0),
            (self.limit, 0),
            (self.left, node),
            (self.right, node),
            (self.value, value),
            (self.gain, 0.0),
        ):
            column.append(entry)
        return node


def _flat(trees: list[_Tree], step: float) -> dict:
    """Trees as the arrays that :func:`ebbtide.operators.ensembles.margins` takes."""
    starts = np.cumsum([0, *[len(t.value) for t in trees]])

    def joined(name: str, kind: type, links: bool = False) -> np.ndarray:
        parts = [np.array(getattr(t, name), dtype=kind) for t in trees]
        parts = [p + s if links else p for p, s in zip(parts, starts)]
        return np.concatenate([np.zeros(0, dtype=kind), *parts])

    return {
        "roots": starts[:-1].astype(np.int32),
        "feature": joined("feature", np.int32),
        "limit": joined("limit", np.float64),
        "left": joined("left", np.int32, links=True).astype(np.int32),
        "right": joined("right", np.int32, links=True).astype(np.int32),
        "value": joined("value", np.float64) * step,
        "depth": max([t.depth for t in trees], default=0),
    }


def _coded(tree: dict, bins: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """``codes`` of the node where each row ends in a single tree; ``bins`` has a row per
    feature. Codes are below 256 in a tree of up to ``BYTE_NODES`` nodes."""
    if len(codes) > BYTE_NODES:
        return codes.take(_walked(tree, bins))
    found = np.zeros(bins.shape[1], dtype=np.uint8)
    feature, limit, left, right = (
        tree[name].tolist() for name in ("feature", "limit", "left", "right")
    )
    code = codes.astype(np.uint8)
    paths = [(0, np.ones(bins.shape[1], dtype=bool))]
    while paths:
        node, here = paths.pop()
        if left[node] != node:
            low = here & (bins[feature[node]] <= int(limit[node]))
            paths += [(left[node], low), (right[node], here ^ low)]
        elif code[node]:
            found += here.view(np.uint8) * code[node]
    return found


def _walked(tree: dict, bins: np.ndarray) -> np.ndarray:
    """Node where each row ends, for trees of many nodes."""
    rows = np.arange(bins.shape[1])
    node = np.zeros(len(rows), dtype=np.intp)
    offset = tree["feature"].astype(np.intp) * len(rows)
    limit, flat = tree["limit"].astype(np.uint8), bins.ravel()
    sides = np.stack([tree["right"], tree["left"]], axis=1).astype(np.intp).ravel()
    for _ in range(tree["depth"]):
        small = flat.take(offset.take(node) + rows) <= limit.take(node)
        node = sides.take(2 * node + small)
    return node


class _Sums:
    """Sums of two values by open node, drawn feature and bin."""

    def __init__(self, nodes: int, columns: int, bins_most: int) -> None:
        self.total = np.zeros((2, nodes, columns, bins_most))
        self.parts: list[tuple] = []
        self.rows = 0

    def add(self, slot: np.ndarray, bins: np.ndarray, *values: np.ndarray) -> None:
        self.parts.append((slot, bins, *values))
        self.rows += len(slot)
        if self.rows >= ADDED_ROWS:
            self.flush()

    def flush(self) -> None:
        if not self.rows:
            return
        slot, bins, *values = (np.concatenate(c, axis=-1) for c in zip(*self.parts))
        _, nodes, columns, most = self.total.shape
        paired = columns - columns % 2 if self.rows >= ROWS_PER_CELL * nodes * most**2 else 0
        slot = slot.astype(np.intp)
        start = slot * most**2
        for place in range(0, paired, 2):
            key = start + (bins[place].astype(np.uint16) * most + bins[place + 1])
            for which, value in enumerate(values):
                pairs = np.bincount(key, value, nodes * most**2).reshape(nodes, most, most)
                self.total[which, :, place] += pairs.sum(2)
                self.total[which, :, place + 1] += pairs.sum(1)
        start = slot * most
        for place in range(paired, columns):
            key = start + bins[place]
            for which, value in enumerate(values):
                added = np.bincount(key, value, nodes * most)
                self.total[which, :, place] += added.reshape(nodes, most)
        self.parts, self.rows = [], 0


def _level_sums(plans: dict[int, dict], bins_most: int, seed: int, turn: int) -> Callable:
    """Sums of first and second derivatives per open node, feature and bin of one task."""

    def sums(blocks: Iterator[tuple]) -> Iterator[tuple]:
        np.empty(KEPT_BYTES, dtype=np.uint8)
        found: dict[int, _Sums] = {}
        for route, block, bins, label, weight, margin in blocks:
            plan = plans.get(route)
            if plan is None:
                continue
            # The place of a row's open node from 1 on; 0 for rows of no open node.
            slot = _coded(plan["tree"], bins, plan["slots"] + 1)
            if plan["row_share"] < 1.0:
                draw = np.random.default_rng([seed, turn, block, route + 1])
                slot *= draw.random(len(slot)) < plan["row_share"]
            at = np.flatnonzero(slot)
            label, weight, margin = (v.take(at) for v in (label, weight, margin))
            chance = 1.0 / (1.0 + np.exp(-margin))
            step = plan["step"]
            first = np.rint(weight * (chance - label) / step) * step
            second = np.rint(weight * chance * (1.0 - chance) / step) * step
            if route not in found:
                found[route] = _Sums(len(plan["open"]), len(plan["columns"]), bins_most)
            drawn = bins.take(plan["columns"], axis=0).take(at, axis=1)
            found[route].add(slot.take(at) - 1, drawn, first, second)
        for route, part in found.items():
            part.flush()
            for place, node in enumerate(plans[route]["open"]):
                yield (route, node), part.total[:, place]

    return sums


def best_split(sums: np.ndarray) -> tuple[float, int, int, float, float, float]:
    """Gain, place of the feature, bin, values of both sides and of the whole node, from
    the (2, features, bins) sums of a node; a gain of 0 means no split."""
    first, second = sums
    whole = first[0].sum(), second[0].sum()
    left = np.cumsum(first, axis=1), np.cumsum(second, axis=1)
    right = whole[0] - left[0], whole[1] - left[1]

    def score(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g * g / (h + LEAF_PENALTY)

    fits = (left[1] >= LEAST_IN_LEAF) & (right[1] >= LEAST_IN_LEAF)
    gain = np.where(fits, score(*left) + score(*right) - score(*whole), 0.0)
    place, limit = np.unravel_index(int(gain.argmax()), gain.shape)

    def value(g: float, h: float) -> float:
        return float(-g / (h + LEAF_PENALTY))

    return (
        max(0.0, float(gain[place, limit])),
        int(place),
        int(limit),
        value(left[0][place, limit], left[1][place, limit]),
        value(right[0][place, limit], right[1][place, limit]),
        value(*whole),
    )


def _splits(state: RDD, sums: Callable) -> dict[tuple[int, int], np.ndarray]:
    """What the splits of a level are picked from: the sums of the nodes that are added up.
    Those of few tasks are added up here, which spares a second stage per level."""
    parts = state.mapPartitions(sums)
    if (tasks := state.getNumPartitions()) > DIRECT:
        parts = parts.reduceByKey(lambda a, b: a + b, min(tasks, 64))
    whole: dict[tuple[int, int], np.ndarray] = {}
    for key, part in parts.collect():
        whole[key] = whole[key] + part if key in whole else part
    return whole


def even_tasks(rows: int, rows_per_task: int, cores: int) -> int:
    """Tasks for so many rows: as many as keep to ``rows_per_task`` and use all cores evenly,
    but no task for less than ``LEAST_ROWS`` while one would do."""
    needed = max(1, math.ceil(rows / rows_per_task))
    if needed >= cores:
        return math.ceil(needed / cores) * cores
    return max(needed, min(cores, rows // LEAST_ROWS))


def level_tasks(dealt: int, cores: int) -> int:
    """Tasks of a level: those that dealt the rows, up to ``MERGED`` of them together while that
    leaves work for all cores. A task has a fixed cost, and sums of its own to send."""
    return min(dealt, math.ceil(dealt / (MERGED * cores)) * cores)


def _exact_step(weight: float) -> float:
    """The least power of 2 of which a double holds all sums of multiples up to ``weight``."""
    return 2.0 ** (math.frexp(weight)[1] - 52)


def _advanced(newest: dict[int, dict]) -> Callable:
    def advance(blocks: Iterator[tuple]) -> Iterator[tuple]:
        np.empty(KEPT_BYTES, dtype=np.uint8)
        for route, block, bins, label, weight, margin in blocks:
            if (tree := newest.get(route)) is not None:
                reached = _coded(tree, bins, np.arange(len(tree["value"])))
                margin = margin + tree["value"].take(reached)
            yield route, block, bins, label, weight, margin

    return advance


def _state(item: tuple) -> tuple:
    label = np.frombuffer(item.label)
    bins = np.frombuffer(item.bins, dtype=np.uint8).reshape(-1, len(label))
    weight = np.frombuffer(item.weight)
    return item.route, item.block, bins, label, weight, np.zeros(len(label))


def fit_ensembles(
    rows: DataFrame,
    number: str,
    features: str,
    label: Column,
    weight: Column,
    specs: dict[int, BoostSpec],
    counts: dict[int, int],
    max_bins: int = 32,
    seed: int = 42,
    tasks: int = 1,
) -> dict[int, dict]:
    """Boosted trees per route number, as arrays for
    :func:`ebbtide.operators.ensembles.ensemble_probability` with an ``importance`` per feature
    (mean gain of its splits, as shares of 1; all 0 without any split).

    ``counts`` gives the number of features per route. ``rows`` is read twice: pass a
    stored frame. Every tree draws its rows and its features anew.
    """
    if not 2 <= max_bins <= 256:
        raise ValueError("a bin number must fit one byte")
    spark = rows.sparkSession
    shared_folder(spark)
    rows = rows.where(F.col(number).isin(list(specs)))
    counts = {route: counts[route] for route in specs}
    limits = bin_limits(rows, number, features, counts, max_bins)
    blocks = pinned(
        rows.select(
            F.col(number).cast("int").alias("number"),
            F.col(features).alias("features"),
            label.cast("double").alias("label"),
            weight.cast("double").alias("weight"),
            F.rand(seed).alias("_drawn"),
        )
        .repartitionByRange(tasks, "number", "_drawn")
        # Whatever order the shuffle delivers, a seed makes the same blocks.
        .sortWithinPartitions("number", "_drawn")
        .drop("_drawn")
        .mapInArrow(_binned(limits), BLOCKS)
    )
    cores = spark.sparkContext.defaultParallelism
    merged = level_tasks(blocks.rdd.getNumPartitions(), cores)
    state = blocks.rdd.map(_state).coalesce(merged).persist(HELD)
    weights = state.map(lambda b: (b[0], float(np.abs(b[4]).sum()))).reduceByKey(lambda a, b: a + b)
    steps = {route: _exact_step(total) for route, total in weights.collect()}
    finished: dict[int, list[_Tree]] = {route: [] for route in specs}
    newest: dict[int, dict] = {}
    for turn in range(max(s.trees for s in specs.values())):
        before = None
        if newest:
            before, state = state, state.mapPartitions(_advanced(newest))
            state.persist(HELD)
            if turn % CUT == 0:
                state.checkpoint()
        active = [route for route, spec in specs.items() if turn < spec.trees]
        growing = {route: _Tree() for route in active}
        # Nodes to be added up, and their siblings, which have the rest of their parents.
        open_nodes = {route: [0] for route in active}
        siblings: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        columns = {}
        for route in active:
            share = max(1, round(specs[route].column_share * counts[route]))
            draw = np.random.default_rng([seed, turn, route + 1])
            columns[route] = np.sort(draw.choice(counts[route], share, replace=False))
        while open_nodes:
            plans = {}
            for route, nodes in open_nodes.items():
                slots = np.full(len(growing[route].value), -1)
                slots[nodes] = np.arange(len(nodes))
                plans[route] = {
                    "tree": _flat([growing[route]], 1.0),
                    "slots": slots,
                    "open": nodes,
                    "columns": columns[route],
                    "row_share": specs[route].row_share,
                    "step": steps[route],
                }
            found = _splits(state, _level_sums(plans, max_bins, seed, turn))
            if before is not None:
                before.unpersist()
                before = None
            for (route, node), (sibling, parent) in siblings.items():
                found[route, sibling] = parent - found[route, node]
            siblings, following = {}, {}
            for (route, node), sums in sorted(found.items(), key=lambda item: item[0]):
                tree = growing[route]
                gain, place, at, low, high, whole = best_split(sums)
                if node == 0:
                    tree.value[0] = whole
                if gain <= 0.0:
                    continue
                tree.feature[node], tree.limit[node] = int(columns[route][place]), at
                tree.gain[node] = gain
                pair = tree.left[node], tree.right[node] = tree.add(low), tree.add(high)
                mass = sums[1, place]
                lighter = int(2 * mass[: at + 1].sum() > mass.sum())
                added = pair[lighter]
                following.setdefault(route, []).append(added)
                siblings[route, added] = (pair[1 - lighter], sums)
            for route in following:
                growing[route].depth += 1
            open_nodes = {
                route: nodes
                for route, nodes in following.items()
                if growing[route].depth < specs[route].depth
            }
            siblings = {key: kept for key, kept in siblings.items() if key[0] in open_nodes}
        for route, tree in growing.items():
            finished[route].append(tree)
        newest = {r: _flat([tree], specs[r].step) for r, tree in growing.items()}
    state.unpersist()
    return {
        route: _with_limits(trees, specs[route].step, limits[route])
        for route, trees in finished.items()
    }


def _with_limits(trees: list[_Tree], step: float, limits: list[np.ndarray]) -> dict:
    """Flat trees over values instead of bins, and the importance of the features."""
    flat = _flat(trees, step)
    gain = np.concatenate([np.zeros(0), *[np.array(t.gain) for t in trees]])
    splits = np.flatnonzero(flat["left"] != np.arange(len(gain)))
    for node in splits:
        flat["limit"][node] = limits[flat["feature"][node]][int(flat["limit"][node])]
    total = np.bincount(flat["feature"][splits], gain[splits], len(limits))
    number = np.bincount(flat["feature"][splits], minlength=len(limits))
    mean = total / np.maximum(number, 1)
    flat["importance"] = mean / mean.sum() if mean.sum() > 0 else mean
    return flat
