"""Boosting of many routes in one job per level, against a plain recursive form."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import boosting
from ebbtide.operators.boosting import best_split, bin_limits, fit_ensembles
from ebbtide.operators.ensembles import ensemble_probability, margins
from ebbtide.params import BoostSpec

SPECS = {-1: BoostSpec(4, 0.3, 3, 1.0, 1.0), 0: BoostSpec(2, 0.1, 1, 1.0, 1.0)}
COUNTS = {-1: 3, 0: 2}


@pytest.fixture(scope="module")
def rows(spark):
    """Two routes with different features; ties, and a column of one value."""
    draw = random.Random(5)
    made = []
    for i in range(600):
        x = [float(draw.randrange(40)), draw.gauss(0, 1), 7.0]
        label = int(x[0] + 10 * x[1] + draw.gauss(0, 8) > 20)
        made.append((-1 if i % 3 else 0, x if i % 3 else x[:2], label, 1.0 + i % 2))
    return spark.createDataFrame(made, "n int, x array<double>, y int, w double").cache()


def fitted(rows, tasks=1, specs=SPECS, **other):
    return fit_ensembles(rows, "n", "x", F.col("y"), F.col("w"), specs, COUNTS, 16, tasks=tasks, **other)


def plain(x, y, w, limits, spec):
    """Margins of the rows after all rounds, one node at a time."""
    margin = np.zeros(len(y))

    def grow(at, g, h, depth):
        whole = g[at].sum(), h[at].sum()
        best, side = 1e-9, None
        for f, cuts in enumerate(limits):
            for cut in cuts:
                left, right = at[x[at, f] <= cut], at[x[at, f] > cut]
                if h[left].sum() < 1 or h[right].sum() < 1:
                    continue
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, right))
                gain -= whole[0] ** 2 / (whole[1] + 1)
                if gain > best + 1e-9:
                    best, side = gain, (left, right)
        if side is None or depth == 0:
            margin[at] += spec.step * -whole[0] / (whole[1] + 1)
            return
        for s in side:
            grow(s, g, h, depth - 1)

    for _ in range(spec.trees):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), w * (p - y), w * p * (1 - p), spec.depth)
    return margin


@pytest.mark.parametrize("tasks", [1, 3])
def test_equals_the_plain_form(rows, tasks):
    limits = bin_limits(rows, "n", "x", COUNTS, 16)
    found = fitted(rows, tasks)
    for route, spec in SPECS.items():
        held = rows.where(F.col("n") == route).collect()
        x = np.array([r.x for r in held])
        y, w = (np.array([r[c] for r in held], dtype=float) for c in ("y", "w"))
        assert margins(found[route], x) == pytest.approx(plain(x, y, w, limits[route], spec), abs=1e-9)
        assert found[route]["depth"] <= spec.depth and len(found[route]["roots"]) == spec.trees


def test_importance(rows):
    for trees in fitted(rows).values():
        assert trees["importance"].sum() == pytest.approx(1) and (trees["importance"] >= 0).all()
    assert fitted(rows)[-1]["importance"][2] == 0


def test_same_seed_same_trees_and_rows_are_drawn(rows):
    drawn = {-1: BoostSpec(25, 0.3, 2, 0.5, 0.5), 0: BoostSpec(22, 0.3, 2, 0.5, 0.5)}
    first, again, other = (fitted(rows, specs=drawn, seed=s) for s in (1, 1, 2))
    assert (first[-1]["value"] == again[-1]["value"]).all()
    assert first[-1]["value"].tolist() != other[-1]["value"].tolist()
    assert [len(first[r]["roots"]) for r in (-1, 0)] == [25, 22]


def test_number_of_jobs_does_not_depend_on_the_routes(spark, rows):
    def jobs(specs):
        group = f"boost-{len(specs)}"
        spark.sparkContext.setJobGroup(group, group)
        fitted(rows, specs=specs)
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert abs(jobs({-1: SPECS[-1]}) - jobs(SPECS)) <= 2


def test_a_single_class_or_a_pure_node_has_no_split(spark):
    sums = np.array([[[-3.0, 0.0]], [[5.0, 0.0]]])
    assert best_split(sums) == (0.0, 0, 0, 0.5, -0.0, 0.5)
    df = spark.createDataFrame([(-1, [1.0, 2.0, 3.0], 1, 1.0)] * 9, "n int, x array<double>, y int, w double")
    trees = fitted(df, specs={-1: SPECS[-1]})[-1]
    assert trees["depth"] == 0 and trees["importance"].tolist() == [0.0] * 3
    p = df.select(ensemble_probability(spark, {-1: trees}, F.col("n"), F.col("x")).alias("p"))
    assert all(r.p > 0.5 for r in p.collect())


def test_missing_values_go_right(spark):
    made = [(-1, [float(i % 10) if i % 4 else float("nan"), 0.0, 0.0], int(i % 4 == 0), 1.0) for i in range(200)]
    df = spark.createDataFrame(made, "n int, x array<double>, y int, w double")
    trees = fitted(df, specs={-1: SPECS[-1]})[-1]
    nan, low = margins(trees, np.array([[np.nan, 0, 0], [3.0, 0, 0]]))
    assert nan > 0 > low


def test_sums_of_many_tasks_are_shuffled_to_the_same_trees(rows, monkeypatch):
    few = fitted(rows, 3)
    monkeypatch.setattr(boosting, "DIRECT", 2)
    many = fitted(rows, 3)
    for route in SPECS:
        assert (few[route]["feature"] == many[route]["feature"]).all()
        assert few[route]["value"] == pytest.approx(many[route]["value"], abs=1e-12)


def test_a_level_of_few_tasks_is_one_stage_and_a_task_has_few_routes(spark, rows, monkeypatch):
    held, kept = [], boosting._splits

    def splits(state, sums):
        held.append(state.mapPartitions(lambda blocks: [sorted({b[0] for b in blocks})]).collect())
        spark.sparkContext.setJobGroup("level", "level")
        found = kept(state, sums)
        spark.sparkContext.setJobGroup("", "")
        return found

    monkeypatch.setattr(boosting, "_splits", splits)
    fitted(rows, 3)
    tracker = spark.sparkContext.statusTracker()
    stages = [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("level")]
    # The first levels of a turn may also name the stages that dealt the rows.
    assert min(stages) == 1
    assert sum(map(len, held[0])) <= len(SPECS) + 2


def test_only_the_lighter_child_is_added_up(rows, monkeypatch):
    """The sums of a node and its sibling are those of the rows, though one is never summed."""
    taken, kept = [], boosting._splits

    def splits(state, sums):
        found = kept(state, sums)
        taken.append({key: np.array(part) for key, part in found.items()})
        return found

    monkeypatch.setattr(boosting, "_splits", splits)
    one = fitted(rows, 1, {-1: SPECS[-1]})[-1]
    # Per tree a root, then one child of every split: 1, 1 and up to 2 nodes.
    assert [len(level) <= most for level, most in zip(taken, [1, 1, 2] * 4)] == [True] * 12
    many = fitted(rows, 3, {-1: SPECS[-1]})[-1]
    # Sums are exact, so other tasks give the same trees to the last bit.
    for name in ("feature", "limit", "left", "right", "value"):
        assert one[name].tolist() == many[name].tolist()


def test_rows_use_all_cores_evenly():
    tasks = [boosting.even_tasks(rows, 200_000, 12) for rows in (0, 100, 60_000, 947_040, 5_700_000)]
    assert tasks == [1, 1, 2, 12, 36]


def test_blocks_are_held_unpacked(rows, monkeypatch):
    """Every level reads all blocks: none of its tasks unpacks them first."""
    levels, kept = [], boosting._splits

    def splits(state, sums):
        levels.append(state.getStorageLevel())
        return kept(state, sums)

    monkeypatch.setattr(boosting, "_splits", splits)
    fitted(rows, 2)
    assert levels and all(level.deserialized and level.useMemory and level.useDisk for level in levels)


def grown(depth, features, bins_most, draw):
    """A full tree of random splits, and the nodes of its last level."""
    tree, last = boosting._Tree(depth=depth), [0]
    for _ in range(depth):
        below = []
        for node in last:
            tree.feature[node], tree.limit[node] = draw.randrange(features), draw.randrange(bins_most)
            tree.left[node], tree.right[node] = tree.add(1.0), tree.add(2.0)
            below += [tree.left[node], tree.right[node]]
        last = below
    return boosting._flat([tree], 1.0), last


@pytest.mark.parametrize("depth", [0, 1, 6, 8])
def test_masks_find_the_nodes_that_rows_walk_to(depth):
    tree, last = grown(depth, 5, 16, random.Random(3))
    bins = np.random.default_rng(1).integers(0, 16, (5, 3_000)).astype(np.uint8)
    codes = np.zeros(len(tree["value"]), dtype=int)
    codes[last[::2]] = np.arange(1, len(last[::2]) + 1)
    assert boosting._coded(tree, bins, codes).tolist() == codes[boosting._walked(tree, bins)].tolist()


@pytest.mark.parametrize("columns", [1, 4, 5])
def test_sums_of_pairs_are_those_of_single_features(columns, monkeypatch):
    monkeypatch.setattr(boosting, "ADDED_ROWS", 4_000)
    draw, sums, parts = np.random.default_rng(2), boosting._Sums(3, columns, 16), []
    plain = np.zeros((2, 3, columns, 16))
    for rows in (2_500, 2_500, 1_700):
        slot = draw.integers(0, 3, rows).astype(np.uint8)
        bins = draw.integers(0, 16, (columns, rows)).astype(np.uint8)
        values = draw.integers(-9, 9, (2, rows)) / 8
        sums.add(slot, bins, *values)
        parts.append(len(sums.parts))
        for which in (0, 1):
            for column in range(columns):
                np.add.at(plain[which, :, column], (slot, bins[column]), values[which])
    sums.flush()
    # The first two are added up together, by pairs; the last rows are too few for that.
    assert parts == [1, 0, 1] and (sums.total == plain).all()


def test_level_tasks_join_those_that_dealt_the_rows(rows, monkeypatch):
    found = [boosting.level_tasks(dealt, 12) for dealt in (1, 7, 12, 36, 48, 60, 96, 480)]
    assert found == [1, 7, 12, 12, 12, 24, 24, 120]
    held, kept = [], boosting._splits

    def splits(state, sums):
        held.append(state.getNumPartitions())
        return kept(state, sums)

    monkeypatch.setattr(boosting, "_splits", splits)
    many = fitted(rows, 40)
    assert set(held) == {16}
    one = fitted(rows, 1)
    assert all(one[r]["value"].tolist() == many[r]["value"].tolist() for r in SPECS)


def test_rows_walk_many_trees_in_little_memory():
    draw = random.Random(7)
    parts = [grown(4, 6, 16, draw)[0] for _ in range(200)]
    nodes = len(parts[0]["value"])
    trees = {name: np.concatenate([p[name] for p in parts]) for name in ("feature", "limit", "value")}
    trees |= {
        name: np.concatenate([p[name] + k * nodes for k, p in enumerate(parts)])
        for name in ("roots", "left", "right")
    }
    trees["depth"] = 4
    rows = np.random.default_rng(4).uniform(0, 16, (2_100, 6))
    rows[::7, 2] = np.nan
    tracemalloc.start()
    found = margins(trees, rows)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 5_000_000
    for at in range(0, len(rows), 300):
        total = []
        for node in trees["roots"]:
            for _ in range(4):
                small = rows[at, trees["feature"][node]] <= trees["limit"][node]
                node = trees["left" if small else "right"][node]
            total.append(trees["value"][node])
        assert found[at] == np.array(total).sum()
