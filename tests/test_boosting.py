"""Boosted trees and isotonic pools against plain programs, and in both ways of getting sums."""

import json
import math
import random
import time

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from riskflow.contract import CAT_COLS, NUM_COLS
from riskflow.operators import boosting, models, scoring
from riskflow.operators.boosting import Boosting, Codes, Layout, Tree
from riskflow.operators.isotonic import curve, isotonic_pools
from riskflow.session import stage

SIZES, ORDERED = [6, 9, 4, 3], np.array([True, True, False, False])


def some_rows(n, seed):
    rng = np.random.default_rng(seed)
    codes = np.stack([rng.integers(0, s, n) for s in SIZES], axis=1).astype(np.int32)
    chance = 1 / (1 + np.exp(-(codes[:, 0] - 2.5 + (codes[:, 1] > 4) * (codes[:, 2] == 1) * 2)))
    return codes, (rng.random(n) < chance).astype(float)


def plain_tree(codes, g, h, how):
    """Leaf-wise growth over row lists: leaves as (rows, value), by trying every split of every leaf."""
    def score(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + how.l2)

    def best(rows):
        found = (0.0, None, None)
        for f, size in enumerate(SIZES):
            for c in range(size):
                left = rows[codes[rows, f] <= c] if ORDERED[f] else rows[codes[rows, f] == c]
                right = np.setdiff1d(rows, left)
                if min(len(left), len(right)) >= how.min_leaf:
                    gain = score(left) + score(right) - score(rows)
                    if gain > found[0] + 1e-9:
                        found = (gain, left, right)
        return found

    leaves = [(np.arange(len(codes)), best(np.arange(len(codes))))]
    while len(leaves) < how.leaves:
        at = max(range(len(leaves)), key=lambda k: leaves[k][1][0])
        gain, left, right = leaves[at][1]
        if gain <= 0:
            break
        leaves[at : at + 1] = [(left, best(left)), (right, best(right))]
    return sorted((sorted(rows.tolist()), -how.step * g[rows].sum() / (h[rows].sum() + how.l2)) for rows, _ in leaves)


@pytest.mark.parametrize("how", [Boosting(leaves=6, min_leaf=5), Boosting(leaves=12, min_leaf=1, l2=2.0), Boosting(leaves=1), Boosting(leaves=30, min_leaf=60)])
@pytest.mark.parametrize("ahead", [1, 5])
def test_tree_equals_plain_growth(how, ahead):
    codes, target = some_rows(300, 4)
    layout = Layout(SIZES, ORDERED)
    weight = np.where(target == 1, 1.7, 0.6)
    rows = boosting.HeldRows(codes, target, weight, np.zeros(300, bool), 0.1, layout)
    _, root = rows.begin([])

    def smaller(tree, asked):
        """Like the stored way: rows are found by their leaf in the tree given."""
        leaf = tree.leaf(codes, ORDERED)
        return [boosting.histogram(layout.slots(codes[leaf == c]), rows.g[leaf == c], rows.h[leaf == c], layout.n) for _, c in asked]

    tree = boosting.grow(root, layout, how, rows.smaller if ahead == 1 else smaller, ahead)
    leaf = tree.leaf(codes, ORDERED)
    got = sorted((np.flatnonzero(leaf == k).tolist(), tree.value[k]) for k in np.unique(leaf))
    want = plain_tree(codes, rows.g / boosting.ONE, rows.h / boosting.ONE, how)
    assert [r for r, _ in got] == [r for r, _ in want]
    assert [v for _, v in got] == pytest.approx([v for _, v in want])


@pytest.fixture(scope="module")
def prepared(cohort_table):
    from riskflow.operators import cohort

    return models.fit_features(cohort.make_target(cohort_table))


@pytest.mark.parametrize("how", [Boosting(step=0.3, rounds=12, leaves=5, l2=1.0, early_stop_rows=100, patience=2), Boosting(rounds=3, leaves=7)])
def test_both_ways_give_the_same_trees(prepared, how, monkeypatch):
    monkeypatch.setattr(boosting, "TREES_PER_PASS", 2)
    held = boosting.fit(prepared.coded, prepared.codes, how, True, 1)
    stored = boosting.fit(prepared.coded.repartition(5), prepared.codes, how, True, 1, in_task_rows=10)
    assert held == stored and 0 < len(held["trees"]) <= how.rounds


def test_tasks_of_a_barrier_stage_give_the_same_trees(prepared):
    """Shares of the rows, some of them empty, in tasks that add up their counts."""
    how = Boosting(step=0.3, rounds=3, leaves=6, l2=1.0, early_stop_rows=100, patience=2)
    for rows, most in ((prepared.coded, 2000), (prepared.coded.limit(60), 10)):
        held = boosting.fit(rows, prepared.codes, how, True, 1)
        assert held == boosting.fit(rows, prepared.codes, how, True, 1, in_task_rows=most)


def test_tasks_wait_shortly_for_each_other(prepared):
    """Forty trees need some 200 sums over all tasks, each of which took a second."""
    how = Boosting(step=0.3, rounds=40, leaves=6, l2=1.0)
    held = boosting.fit(prepared.coded, prepared.codes, how, True, 1)
    start = time.monotonic()
    assert held == boosting.fit(prepared.coded, prepared.codes, how, True, 1, alone_rows=1500) and len(held["trees"]) == 40
    assert time.monotonic() - start < 80


@pytest.mark.parametrize("at", [None, "/dev/null/none"])
def test_tasks_without_a_common_folder(prepared, monkeypatch, at):
    """One task alone where it may hold the rows, otherwise sums by way of the driver."""
    monkeypatch.setattr(boosting, "exchange_dir", lambda spark: at)
    how = Boosting(step=0.3, rounds=2, leaves=4, l2=1.0)
    held = boosting.fit(prepared.coded, prepared.codes, how, True, 1)
    assert held == boosting.fit(prepared.coded, prepared.codes, how, True, 1, alone_rows=1500)
    assert held == boosting.fit(prepared.coded, prepared.codes, how, True, 1, in_task_rows=2000, alone_rows=1500)


def test_exchange_dir(spark, tmp_path):
    class Session:
        def __init__(self, at):
            self.conf, self.sparkContext = {"spark.checkpoint.dir": at}, spark.sparkContext

    for at, found in ((f"{tmp_path}/a%20b/", f"{tmp_path}/a%20b/"), (f"file://{tmp_path}/a%20b", f"{tmp_path}/a b/"), (f"file:{tmp_path}", f"{tmp_path}/")):
        assert boosting.exchange_dir(Session(at)).startswith(f"{found}boosting-")
    assert boosting.exchange_dir(Session("hdfs://names/shared")) is None


@pytest.mark.parametrize("leaves", [1, 2, 9, 32, 33, 64, 65, 90])
def test_leaves_of_rows(leaves):
    """Rows reach the leaf that a walk by hand leads to, on both sides of the limits of 32 and 64 leaves."""
    rng = np.random.default_rng(leaves)
    codes, tree, at = some_rows(400, leaves)[0].astype(np.uint8), Tree(), {0: 0}
    while len(at) < leaves:
        node = int(rng.choice(list(at)))
        f = int(rng.integers(0, len(SIZES)))
        for child in tree.split(node, f, int(rng.integers(0, SIZES[f] + 1))):
            at[child] = at[node] + 1
        del at[node]
    tree.depth = max(at.values())

    def walk(row):
        node = 0
        while tree.left[node] != node:
            f, cut = tree.feature[node], tree.cut[node]
            node = (tree.left if (row[f] <= cut if ORDERED[f] else row[f] == cut) else tree.right)[node]
        return node

    assert tree.leaf(codes, ORDERED).tolist() == [walk(row) for row in codes.tolist()]
    assert tree.leaf(codes[:0], ORDERED).tolist() == []


def test_features_counted_together():
    """Shared codes give the counts of each feature, with few and with many codes, and rows are read no wider than needed."""
    rng = np.random.default_rng(3)
    sizes = [6, 300, 4, 3, 5000, 2, 70]
    layout = Layout(sizes, np.ones(7, bool))
    assert sorted(f for own in layout.joint for f in own) == list(range(7)) and len(layout.joint) < 7
    codes = np.stack([rng.integers(0, s, 500) for s in sizes], axis=1).astype(np.int32)
    rows = boosting.HeldRows(codes, rng.integers(0, 2, 500) * 1.0, np.ones(500), rng.random(500) < 0.2, 0.3, layout)
    _, root = rows.begin([])
    own = rows.fitted
    assert (root == boosting.histogram(layout.slots(codes[own]), rows.g[own], rows.h[own], layout.n)).all()
    assert rows.codes.dtype == np.uint16 and sum(x.itemsize for x in rows.joint) <= 16


def test_early_stopping_and_loss(prepared):
    fast = boosting.fit(prepared.coded, prepared.codes, Boosting(step=1.0, rounds=100, leaves=31, early_stop_rows=100, patience=3), False, 1)
    assert 3 <= len(fast["trees"]) < 60
    slow = boosting.fit(prepared.coded, prepared.codes, Boosting(rounds=40, leaves=4), False, 1)
    rows = prepared.coded.collect()
    codes, target = np.array([r["codes"] for r in rows]), np.array([r["target"] for r in rows], float)
    one = np.ones(len(target))
    loss = [boosting.losses(boosting.margins(codes, slow["base"], boosting.load_trees(slow)[:k], prepared.codes.ordered), target, one).mean() for k in (0, 1, 10, 40)]
    assert loss == sorted(loss, reverse=True)


def test_no_rows_and_one_class(spark, prepared):
    none = prepared.coded.where("false")
    assert boosting.fit(none, prepared.codes, Boosting(), True, 1) == {"base": 0.0, "trees": []}
    one = boosting.fit(prepared.coded.where("target = 0"), prepared.codes, Boosting(rounds=2), True, 1)
    assert one["base"] < -10 and all(len(t["feature"]) == 1 for t in one["trees"])


def test_bins_and_categories(spark):
    """Few values have a bin each, many are cut at quantiles; unknown and rare categories share the last code."""
    rng = random.Random(2)
    values = {"num_medications": [rng.randint(0, 9) for _ in range(4000)], "num_lab_procedures": [rng.random() for _ in range(4000)]}
    rows = [(float(a), b, "x" if k % 2 else "y" if k > 30 else f"rare{k}") for k, (a, b) in enumerate(zip(*values.values()))]
    from riskflow.operators import features

    df = features.clean(spark.createDataFrame(rows, "num_medications double, num_lab_procedures double, race string"))
    prof = stage(features.profile(df))
    state = features.fit_state(prof)
    codes = boosting.fit_codes(features.imputed(prof, state["median"]), state)
    assert codes.names() == NUM_COLS + CAT_COLS
    assert codes.numeric["num_medications"]["edges"] == [k + 0.5 for k in range(9)]
    assert 240 <= len(codes.numeric["num_lab_procedures"]["edges"]) <= 254
    out = [r["codes"] for r in boosting.coded(df, codes, []).collect()]
    at = codes.names().index("num_lab_procedures")
    share = np.bincount([c[at] for c in out]).max() / len(out)
    assert share < 3 / 255
    race, k = codes.categories["race"], codes.names().index("race")
    assert race == ["x", "y"] and {c[k] for c in out} == {0, 1, 2}


def test_saved_models_score_alike(spark, cohort_table, prepared, tmp_path):
    from riskflow.params import Experiment

    rows = stage(cohort_table.limit(200))
    for calibrate in (False, True):
        options = {"max_iter": 6, "leaves": 6, "min_leaf": 5, "balanced": not calibrate, "calibrate": calibrate}
        model = models.fit(Experiment("m", "gbt", options), prepared)
        path = str(tmp_path / f"m{calibrate}")
        model.write().save(path)
        direct = sorted(map(tuple, scoring.score(rows, model).collect()))
        assert direct == sorted(map(tuple, scoring.score(rows, PipelineModel.load(path)).collect()))
        assert all(0 <= s <= 1 for _, s in direct) and len({s for _, s in direct}) > 5
        # From raw columns the same codes come out as from the training table.
        parts = json.loads(model.stages[1].getOrDefault("model"))["parts"]
        coded = {r["encounter_id"]: r["codes"] for r in prepared.coded.collect()}
        known = [(e, s) for e, s in direct if e in coded]
        matrix, total = np.array([coded[e] for e, _ in known]), 0
        for p in parts:
            margin = boosting.margins(matrix, p["base"], boosting.load_trees(p), prepared.codes.ordered)
            total = total + (np.interp(margin, *p["curve"]) if calibrate else 1 / (1 + np.exp(-margin)))
        assert len(known) > 100 and [s for _, s in known] == pytest.approx(list(total / len(parts)), rel=1e-12)


def plain_isotonic(points):
    """(low, high, n, pos) pools by merging any two violating neighbours until none is left."""
    pools = [list(p) for p in points]
    k = 0
    while k < len(pools) - 1:
        a, b = pools[k], pools[k + 1]
        if a[3] * b[2] >= b[3] * a[2]:
            pools[k : k + 2] = [[a[0], b[1], a[2] + b[2], a[3] + b[3]]]
            k = max(k - 1, 0)
        else:
            k += 1
    return pools


@pytest.mark.parametrize("pool_rows, partitions", [(100_000, None), (4, 9), (5, 3)])
def test_isotonic_pools(spark, pool_rows, partitions):
    rng = random.Random(pool_rows)
    curves = {
        0: [(float(k), 1, rng.random() < k / 200) for k in range(200)], 1: [(float(k), 2, 200 - k) for k in range(100)], 2: [(float(k), 200, k) for k in range(60)],
        3: [(k / 7, 3, rng.randint(0, 3)) for k in range(50)], 4: [(0.5, 9, 4)], 5: [(float(k), 4, 2) for k in range(40)],
    }
    rows = [(by, v, n, int(pos)) for by, points in curves.items() for v, n, pos in points]
    rng.shuffle(rows)
    found = isotonic_pools(spark.createDataFrame(rows, "by int, value double, n bigint, pos bigint").repartition(4), pool_rows, partitions)
    got = {by: sorted([r["low"], r["high"], r["n"], r["pos"]] for r in found.collect() if r["by"] == by) for by in curves}
    assert got == {by: plain_isotonic([(v, v, n, int(pos)) for v, n, pos in points]) for by, points in curves.items()}


def test_isotonic_of_nothing_and_curve(spark):
    assert isotonic_pools(spark.createDataFrame([], "by int, value double, n bigint, pos bigint")).count() == 0
    x, y = curve([{"low": 0.0, "high": 2.0, "n": 4, "pos": 1}, {"low": 3.0, "high": 3.0, "n": 2, "pos": 1}])
    assert (x, y) == ([0.0, 2.0, 3.0], [0.25, 0.25, 0.5])
    assert math.isclose(np.interp(2.5, x, y), 0.375) and np.interp(-9, x, y) == 0.25


def test_tree_of_one_leaf():
    tree = Tree(value=[0.5])
    assert boosting.margins(np.zeros((3, 4), np.int32), 1.0, [tree], ORDERED).tolist() == [1.5] * 3
    assert Codes({}, {"a": ["x"]}).sizes == [2]
