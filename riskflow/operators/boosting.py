"""Boosted trees over value-count histograms: leaf-wise growth by best gain, L2 penalty, early stopping.

A row is a vector of small codes: the bin of each numeric feature and the category of each other one. Everything a tree
needs from the rows is how many rows, and what sums of gradients and curvatures, each code has in each open leaf. Gradients
are whole numbers of ``1 / ONE``, so these sums don't depend on who adds them up in which order, and the same trees come out
of all ways to get them, which the number of training rows decides:

* up to ``ALONE_ROWS`` one task holds the codes and grows all trees; the driver gets the model only;
* beyond that the tasks of one barrier stage hold a share of the rows each, up to ``IN_TASK_ROWS``. They add up the counts of
  every split (``Exchange``) and grow the same trees from the same sums, so rows are read once for a fit;
* where the cores there are can't hold the rows so, each round of splits is one Spark aggregation over the stored rows, whose
  result is as large as the open leaves times the codes. Every ``TREES_PER_PASS`` trees the rows are stored again with their
  margins.

In all, the larger child's counts are the parent's minus those of the smaller one.
"""

from __future__ import annotations

import base64
import heapq
import json
import math
import os
import shutil
import time
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.contract import CAT_COLS, NUM_COLS
from riskflow.functions import hash_bucket
from riskflow.operators.ranking import quantiles
from riskflow.session import keep, shared_dir

MAX_BINS = 255
#: Rows that one task grows trees from by itself; beyond that each task of a barrier stage has about as many, if there are the cores.
ALONE_ROWS = 500_000
#: Rows (about 100 bytes each) that one task may hold to grow trees, by itself or as its share of a barrier stage.
IN_TASK_ROWS = 8_000_000
#: Combinations of codes that are counted at once; their sums should fit into a core's cache.
JOINT_CODES = 8192
#: Rows counted at once, for the same reason.
BLOCK_ROWS = 65_536
#: Leaves that tasks split between two sums over all of them. More are split in vain, fewer wait more often.
SHARED_AHEAD = 4
#: Seconds that tasks look for each other's files before they give up on files.
MEETING_SECONDS = 5.0
TREES_PER_PASS = 10
ONE = 1 << 24
LEAST_CURVATURE = 1e-3


@dataclass(frozen=True)
class Boosting:
    """``holdout`` of the rows decide on stopping where there are more than ``early_stop_rows`` of them."""

    step: float = 0.1
    rounds: int = 100
    leaves: int = 31
    l2: float = 0.0
    min_leaf: int = 20
    early_stop_rows: int = 10_000
    holdout: float = 0.1
    patience: int = 10
    least_gain: float = 1e-7


# ---- codes -------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Codes:
    """How cleaned features become codes, with the fitted medians, bounds and vocabularies of ``features.fit_state``."""

    numeric: dict[str, dict]
    categories: dict[str, list[str]]

    @property
    def sizes(self) -> list[int]:
        """Codes of each feature; a category list is followed by one code for everything else."""
        return [len(v["edges"]) + 1 for v in self.numeric.values()] + [len(v) + 1 for v in self.categories.values()]

    @property
    def ordered(self) -> np.ndarray:
        return np.array([True] * len(self.numeric) + [False] * len(self.categories))

    def names(self) -> list[str]:
        return [*self.numeric, *self.categories]

    def of(self, columns: list[pa.Array]) -> np.ndarray:
        """The code matrix of columns in the order of ``names``."""
        out = np.empty((len(columns[0]) if columns else 0, len(columns)), np.int32)
        for k, (column, how) in enumerate(zip(columns, [*self.numeric.values(), *self.categories.values()])):
            if isinstance(how, dict):
                value = pc.fill_null(column.cast(pa.float64()), how["median"]).to_numpy(zero_copy_only=False)
                out[:, k] = np.searchsorted(how["edges"], np.clip(value, how["low"], how["high"]), side="left")
            else:
                index = pc.index_in(pc.fill_null(column.cast(pa.string()), "missing"), pa.array(how, pa.string()))
                out[:, k] = pc.fill_null(index, len(how)).to_numpy(zero_copy_only=False)
        return out


def fit_codes(filled: DataFrame, state: dict, max_bins: int = MAX_BINS) -> Codes:
    """Bins from the value counts of the imputed numeric features, vocabularies from ``state``.

    Up to ``max_bins`` distinct values after clipping have a bin each, cut half-way; otherwise the cuts are quantiles.
    """
    numeric = {c: {"median": state["median"][c], "low": state["low"][c], "high": state["high"][c]} if c in state["median"] else {"median": 0.0, "low": 0.0, "high": 0.0} for c in NUM_COLS}
    bounds = F.create_map(*[x for c, v in numeric.items() for x in (F.lit(c), F.struct(F.lit(float(v["low"])).alias("low"), F.lit(float(v["high"])).alias("high")))])
    b = F.element_at(bounds, F.col("feature"))
    clipped = filled.select("feature", F.greatest(F.least(F.col("value"), b["high"]), b["low"]).alias("value"), "n")
    clipped = keep(clipped.groupBy("feature", "value").agg(F.sum("n").alias("n")), "clipped-counts")
    distinct = {r["feature"]: r["n"] for r in clipped.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    few = [c for c, n in distinct.items() if n <= max_bins]
    values: dict[str, list[float]] = {c: [] for c in NUM_COLS}
    for r in clipped.where(F.col("feature").isin(few)).collect():  # at most max_bins for each feature
        values[r["feature"]].append(r["value"])
    for c in NUM_COLS:
        own = sorted(values[c])
        numeric[c]["edges"] = [(a + z) / 2 for a, z in zip(own, own[1:])]
    many = [c for c in distinct if c not in few]
    if many:
        probs = [k / max_bins for k in range(1, max_bins)]
        for r in quantiles(clipped.where(F.col("feature").isin(many)), probs, ("feature",)).collect():
            numeric[r["feature"]]["edges"] = sorted(set(r["q"]))
    return Codes(numeric, {c: state["categories"][c] for c in CAT_COLS})


def coded(cleaned: DataFrame, codes: Codes, keep_columns: list[str]) -> DataFrame:
    """``keep_columns`` and ``codes`` (array of int) of cleaned features."""
    names = codes.names()
    schema = ", ".join([*(f"`{c}` {cleaned.schema[c].dataType.simpleString()}" for c in keep_columns), "codes array<int>"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = codes.of([batch.column(c) for c in names])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, matrix.size + 1, len(names), dtype=np.int32)), pa.array(matrix.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep_columns], lists], names=[*keep_columns, "codes"])

    return cleaned.select(*[F.col(f"`{c}`") for c in [*keep_columns, *names]]).mapInArrow(rows, schema)


# ---- trees -------------------------------------------------------------------------------------

def _places(kind: type, factor: int) -> tuple:
    """How the place of a single bit is found: a product with a de Bruijn sequence has other high bits for each."""
    bits = np.iinfo(kind).bits
    shift = kind(bits - bits.bit_length() + 1)
    place = np.empty(bits, np.int64)
    place[((kind(1) << np.arange(bits, dtype=kind)) * kind(factor)) >> shift] = np.arange(bits)
    return kind(factor), shift, place


_LOWEST = {np.uint32: _places(np.uint32, 0x077CB531), np.uint64: _places(np.uint64, 0x03F79D71B4CB0A89)}


@dataclass
class Tree:
    """Nodes in order of creation. Left is ``code <= cut`` for ordered features and ``code == cut`` for others; a leaf leads to itself."""

    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: int = 0

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, a, a + 1
        for k in (a, a + 1):
            self.feature.append(0)
            self.cut.append(0)
            self.left.append(k)
            self.right.append(k)
            self.value.append(0.0)
        return a, a + 1

    def leaf(self, codes: np.ndarray, ordered: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        leaves = (len(self.feature) + 1) // 2
        if leaves <= 64 and len(codes):
            return self._leaf_by_masks(codes, ordered, np.uint32 if leaves <= 32 else np.uint64)
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        node, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        for _ in range(self.depth):
            f = feature[node]
            code, at = codes[rows, f], cut[node]
            node = np.where(np.where(ordered[f], code <= at, code == at), left[node], right[node])
        return node

    def _leaf_by_masks(self, codes: np.ndarray, ordered: np.ndarray, kind: type) -> np.ndarray:
        """Leaves are bits, from left to right. Each code of a feature has the leaves left that its splits don't rule out; of
        those that all features leave, a row's leaf is the first."""
        below: list[list[int]] = [[] for _ in self.feature]
        for node in range(len(self.feature) - 1, -1, -1):  # children come after their parent
            a, b = self.left[node], self.right[node]
            below[node] = [node] if a == node else below[a] + below[b]
        bit = {leaf: k for k, leaf in enumerate(below[0])}
        tables: dict[int, np.ndarray] = {}
        for node, f in enumerate(self.feature):
            if self.left[node] == node:
                continue
            if f not in tables:
                tables[f] = np.full(int(codes[:, f].max()) + 1, np.iinfo(kind).max, kind)
            code = np.arange(len(tables[f]))
            goes = code <= self.cut[node] if ordered[f] else code == self.cut[node]
            tables[f][~goes] &= kind(np.iinfo(kind).max ^ sum(1 << bit[leaf] for leaf in below[self.left[node]]))
        rest = np.full(len(codes), np.iinfo(kind).max, kind)
        for f, table in tables.items():
            rest &= table[codes[:, f]]
        rest &= ~rest + kind(1)  # the lowest bit by itself
        factor, shift, place = _LOWEST[kind]
        return np.array(below[0])[place[(rest * factor) >> shift]]


def margins(codes: np.ndarray, base: np.ndarray | float, trees: list[Tree], ordered: np.ndarray) -> np.ndarray:
    """``base`` plus the trees' values, added in their order."""
    out = np.zeros(len(codes)) + base
    codes = np.asfortranarray(codes)  # trees read whole columns
    for tree in trees:
        out += np.array(tree.value)[tree.leaf(codes, ordered)]
    return out


def gradients(margin: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the log-loss as whole numbers of ``1 / ONE``."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint(weight * (p - target) * ONE), np.rint(weight * p * (1.0 - p) * ONE)


def losses(margin: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log-loss of each row in whole numbers of ``1 / ONE``."""
    return np.rint(weight * (np.logaddexp(0.0, margin) - target * margin) * ONE)


@dataclass
class Layout:
    """Where each feature's codes lie in a histogram."""

    sizes: list[int]
    ordered: np.ndarray

    def __post_init__(self):
        self.first = np.cumsum([0, *self.sizes[:-1]])
        self.n = sum(self.sizes)
        self.feature = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.is_ordered = self.ordered[self.feature]
        self.joint: list[list[int]] = []
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            own = next((own for own in self.joint if math.prod([self.sizes[f], *(self.sizes[k] for k in own)]) <= JOINT_CODES), None)
            if own is None:
                self.joint.append(own := [])
            own.append(f)

    def slots(self, codes: np.ndarray) -> np.ndarray:
        return codes + self.first.astype(np.int32)


def gains(hist: np.ndarray, layout: Layout, how: Boosting) -> np.ndarray:
    """Gain of each split: after each code of an ordered feature, of each code of others against the rest."""
    total = hist[: layout.sizes[0]].sum(axis=0)
    run = np.cumsum(hist, axis=0)
    before = np.vstack([np.zeros((1, 3), hist.dtype), run])[layout.first][layout.feature]
    low = np.where(layout.is_ordered[:, None], run - before, hist)
    high = total - low
    (n0, g0, h0), (n1, g1, h1) = low.T, high.T
    g0, h0, g1, h1 = g0 / ONE, h0 / ONE, g1 / ONE, h1 / ONE
    fits = (n0 >= how.min_leaf) & (n1 >= how.min_leaf) & (h0 >= LEAST_CURVATURE) & (h1 >= LEAST_CURVATURE)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g0 * g0 / (h0 + how.l2) + g1 * g1 / (h1 + how.l2) - (total[1] / ONE) ** 2 / (total[2] / ONE + how.l2)
    return np.where(fits, gain, -np.inf)


def best_split(hist: np.ndarray, layout: Layout, how: Boosting) -> tuple[float, int, int]:
    """(gain, feature, cut) of the best split; the first of equals."""
    gain = gains(hist, layout, how)
    at = int(gain.argmax())
    return float(gain[at]), int(layout.feature[at]), at - int(layout.first[layout.feature[at]])


def grow(root: np.ndarray, layout: Layout, how: Boosting, smaller: Callable[[Tree, list[tuple[int, int]]], list[np.ndarray]], ahead: int = 1) -> Tree:
    """A tree of at most ``leaves`` leaves, grown at the leaf of best gain.

    ``smaller(tree, asked)`` gives histograms of nodes of ``tree``. Up to ``ahead`` leaves are split in one call, those of
    best gain first; a split that turns out not to be among the best is taken back, so ``ahead`` doesn't change the tree.
    """
    def leaf_value(hist: np.ndarray) -> float:
        _, g, h = hist[: layout.sizes[0]].sum(axis=0)
        return -how.step * (g / ONE) / (h / ONE + how.l2 + 1e-12)

    tree, depth = Tree(), {0: 0}
    tree.value[0] = leaf_value(root)
    known: dict[int, tuple[float, int, int, np.ndarray]] = {}
    heap: list[tuple[float, tuple]] = []
    # Nodes are named by their path, so that trial splits leave no trace in the tree.
    paths: dict[tuple, np.ndarray] = {(): root}
    children: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    node_of: dict[tuple, int] = {(): 0}

    def offer(path: tuple) -> None:
        gain, feature, cut = best_split(paths[path], layout, how)
        if gain > 0:
            known[path] = (gain, feature, cut)
            heapq.heappush(heap, (-gain, len(node_of), path))

    offer(())
    leaves = 1
    while heap and leaves < how.leaves:
        path = heap[0][2]
        if path not in children:
            _look_ahead([p for _, _, p in heapq.nsmallest(min(ahead, how.leaves - leaves), heap) if p not in children], tree, max(depth.values()) + 1, node_of, known, paths, children, layout, smaller)
        heapq.heappop(heap)
        _, feature, cut = known[path]
        node = node_of[path]
        a, b = tree.split(node, feature, cut)
        depth[a] = depth[b] = depth[node] + 1
        leaves += 1
        for side, child, hist in ((0, a, children[path][0]), (1, b, children[path][1])):
            own = (*path, side)
            paths[own], node_of[own] = hist, child
            tree.value[child] = leaf_value(hist)
            offer(own)
        del paths[path], children[path]
    tree.depth = max(depth.values())
    return tree


def _look_ahead(wanted, tree, depth, node_of, known, paths, children, layout, smaller) -> None:
    """Histograms of the children that splits of ``wanted`` would make."""
    trial = Tree(*[list(x) for x in (tree.feature, tree.cut, tree.left, tree.right, tree.value)], depth=depth)
    asked, sides = [], []
    for path in wanted:
        _, feature, cut = known[path]
        a, b = trial.split(node_of[path], feature, cut)
        part = slice(int(layout.first[feature]), int(layout.first[feature]) + layout.sizes[feature])
        counts = paths[path][part, 0]
        n_left = counts[: cut + 1].sum() if layout.ordered[feature] else counts[cut]
        left_smaller = 2 * n_left <= counts.sum()
        asked.append((node_of[path], a if left_smaller else b))
        sides.append(left_smaller)
    for path, left_smaller, hist in zip(wanted, sides, smaller(trial, asked)):
        rest = paths[path] - hist
        children[path] = (hist, rest) if left_smaller else (rest, hist)


# ---- rows --------------------------------------------------------------------------------------

def histogram(slots: np.ndarray, g: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """(rows, gradients, curvatures) by slot. Sums of whole numbers below 2^53 are exact in floating point."""
    flat, k = slots.ravel(), slots.shape[1]
    out = np.empty((n, 3), np.int64)
    out[:, 0] = np.bincount(flat, minlength=n)
    out[:, 1] = np.bincount(flat, np.repeat(g, k), n)
    out[:, 2] = np.bincount(flat, np.repeat(h, k), n)
    return out


def by_feature(cells: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Sums for each feature's codes from those for combinations of codes, halving the features each time."""
    if len(sizes) == 1:
        return [cells]
    half = len(sizes) // 2
    both = cells.reshape(len(cells), math.prod(sizes[:half]), -1)
    return by_feature(both.sum(axis=2), sizes[:half]) + by_feature(both.sum(axis=1), sizes[half:])


class HeldRows:
    """All training rows in memory. Features share a code where their sizes allow it, so that they are counted together."""

    def __init__(self, codes: np.ndarray, target: np.ndarray, weight: np.ndarray, held_out: np.ndarray, base: float, layout: Layout):
        self.layout, self.codes, self.target, self.weight = layout, np.asfortranarray(compact(codes, layout)), target, weight
        self.joint = [joint_code(self.codes, own, layout) for own in layout.joint]
        self.margin, self.g, self.h = np.full(len(codes), base), np.empty(len(codes)), np.empty(len(codes))
        kind = np.int32 if len(codes) <= np.iinfo(np.int32).max else np.int64
        self.fitted, self.tested = (np.flatnonzero(x).astype(kind) for x in (~held_out, held_out))
        self.tested_codes = np.asfortranarray(self.codes[self.tested])
        #: How many rows each slot has at the root, which is the same for all trees.
        self.counts: np.ndarray | None = None
        #: Rows of leaves, and of both sides of the splits that were asked for.
        self.of: dict[int, np.ndarray] = {}
        self.sides: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def begin(self, trees: list[Tree]) -> tuple[int, np.ndarray]:
        t = self.tested
        if trees:
            tree = trees[-1]
            self.margin[t] = margins(self.tested_codes, self.margin[t], [tree], self.layout.ordered)
            for node in range(len(tree.feature)):
                if tree.left[node] == node:
                    for rows in self.sides[node] if node in self.sides else (self._rows(tree, node),):
                        self.margin[rows] += tree.value[node]
        for at in range(0, len(self.margin), BLOCK_ROWS):
            own = slice(at, at + BLOCK_ROWS)
            self.g[own], self.h[own] = gradients(self.margin[own], self.target[own], self.weight[own])
        self.of, self.sides = {0: self.fitted}, {}
        root = self._histogram(self.fitted, self.counts)
        self.counts = root[:, 0]
        return int(losses(self.margin[t], self.target[t], self.weight[t]).sum()), root

    def _histogram(self, rows: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
        """What ``histogram`` gives. Sums over shared codes are added up to those of each feature; known ``counts`` are taken over."""
        out, sizes = np.empty((self.layout.n, 3), np.int64), self.layout.sizes
        cells = [math.prod(sizes[f] for f in own) for own in self.layout.joint]
        totals = [np.zeros((3, n)) for n in cells]
        for at in range(0, len(rows), BLOCK_ROWS):
            block = rows[at : at + BLOCK_ROWS].astype(np.intp)
            g, h = self.g[block], self.h[block]
            for joint, total, n in zip(self.joint, totals, cells):
                code = joint[block].astype(np.intp)
                if counts is None:
                    total[0] += np.bincount(code, None, n)
                total[1] += np.bincount(code, g, n)
                total[2] += np.bincount(code, h, n)
        for own, total in zip(self.layout.joint, totals):
            for f, sums in zip(own, by_feature(total, [sizes[f] for f in own])):
                out[self.layout.first[f] : self.layout.first[f] + sizes[f]] = sums.T
        if counts is not None:
            out[:, 0] = counts
        return out

    def _rows(self, tree: Tree, leaf: int) -> np.ndarray:
        if leaf not in self.of:
            parent = next(p for p in range(leaf) if leaf in (tree.left[p], tree.right[p]))
            self.of[tree.left[parent]], self.of[tree.right[parent]] = self.sides.pop(parent)
        return self.of[leaf]

    def smaller(self, tree: Tree, asked: list[tuple[int, int]]) -> list[np.ndarray]:
        out = []
        for node, child in asked:
            rows, f, cut = self._rows(tree, node), tree.feature[node], tree.cut[node]
            code = self.codes[:, f][rows]
            goes = code <= cut if self.layout.ordered[f] else code == cut
            self.sides[node] = rows[goes], rows[~goes]
            del self.of[node]
            out.append(self._histogram(self.sides[node][child == tree.right[node]]))
        return out


class SharedRows(HeldRows):
    """One task's share of the training rows; losses and histograms are those of all tasks of its barrier stage."""

    def __init__(self, *args, exchange: Exchange):
        super().__init__(*args)
        self.exchange = exchange

    def begin(self, trees: list[Tree]) -> tuple[int, np.ndarray]:
        loss, hist = super().begin(trees)
        # The loss travels in a row of its own.
        found = self.exchange.added(np.vstack([hist, [[loss, 0, 0]]]))
        return int(found[-1, 0]), found[:-1]

    def smaller(self, tree: Tree, asked: list[tuple[int, int]]) -> list[np.ndarray]:
        return list(self.exchange.added(np.stack(super().smaller(tree, asked))))


class Exchange:
    """Sums of arrays of whole numbers over the tasks of a barrier stage, which all call it alike.

    By ``allGather`` each sum takes a second, because Spark looks for the others' messages once a second. So where all tasks see
    the folder ``at``, each replaces a file of its own there, the first one adds the files up, and all read the file of sums.
    """

    def __init__(self, at: str | None):
        self.context, self.calls, self.at = BarrierTaskContext.get(), 0, None
        self.me, self.tasks = self.context.partitionId(), len(self.context.getTaskInfos())
        # A stage that is run again gets a folder of its own.
        first = self.context.allGather(str(self.context.taskAttemptId()))[0]
        if at is not None and "no" not in self.context.allGather("yes" if self._met(f"{at}/{first}") else "no"):
            self.at = f"{at}/{first}"

    def _met(self, folder: str) -> bool:
        try:
            os.makedirs(folder, exist_ok=True)
            self._write(folder, f"part-{self.me}", np.zeros(0, np.int64))
        except OSError:
            return False
        until = time.monotonic() + MEETING_SECONDS
        return all(self._read(folder, f"part-{k}", until) is not None for k in range(self.tasks))

    def added(self, own: np.ndarray) -> np.ndarray:
        """The sum of all tasks' arrays."""
        self.calls += 1
        if self.at is None:
            all_ = self.context.allGather(base64.b64encode(zlib.compress(own.tobytes(), 1)).decode())
            return sum(np.frombuffer(zlib.decompress(base64.b64decode(x)), np.int64) for x in all_).reshape(own.shape)
        if self.me:
            self._write(self.at, f"part-{self.me}", own)
            return self._read(self.at, "sum").reshape(own.shape)
        total = own.ravel().copy()
        for k in range(1, self.tasks):
            total += self._read(self.at, f"part-{k}")
        self._write(self.at, "sum", total)
        return total.reshape(own.shape)

    def _write(self, folder: str, name: str, values: np.ndarray) -> None:
        path = f"{folder}/{name}"
        with open(f"{path}.new", "wb") as f:
            f.write(np.int64(self.calls).tobytes() + values.tobytes())
        os.replace(f"{path}.new", path)

    def _read(self, folder: str, name: str, until: float = math.inf) -> np.ndarray | None:
        """The values of this call, waited for: a file of an earlier call is still to be replaced."""
        pause = 0.0002
        while True:
            try:
                with open(f"{folder}/{name}", "rb") as f:
                    if int.from_bytes(f.read(8), "little") == self.calls:
                        return np.frombuffer(f.read(), np.int64)
            except OSError:
                pass
            if time.monotonic() > until:
                return None
            time.sleep(pause)
            pause = min(1.5 * pause, 0.001)


def exchange_dir(spark: SparkSession) -> str | None:
    """A folder for files of one fit's tasks in the shared one, if that may be a folder of a file system they see as theirs."""
    where = shared_dir(spark)
    parsed = urlparse(where)
    path = unquote(parsed.path) if parsed.scheme == "file" else where
    return f"{path.rstrip('/')}/boosting-{uuid.uuid4().hex}" if parsed.scheme in ("", "file") else None


def compact(codes: np.ndarray, layout: Layout) -> np.ndarray:
    """Codes in as few bytes as they need."""
    return codes.astype(np.min_scalar_type(max(layout.sizes)), copy=False)


def joint_code(codes: np.ndarray, features: list[int], layout: Layout) -> np.ndarray:
    """One code for the combination of the codes of some features."""
    out = np.zeros(len(codes), np.min_scalar_type(math.prod(layout.sizes[f] for f in features)))
    for f in features:
        out *= out.dtype.type(layout.sizes[f])
        out += codes[:, f].astype(out.dtype)
    return out


class StoredRows:
    """Training rows as a stored table: codes, target, weight, held_out and margin."""

    def __init__(self, rows: DataFrame, base: float, layout: Layout):
        self.layout = layout
        self.rows = keep(rows.select("codes", "target", "weight", "held_out", F.lit(base).alias("margin")), "boosting-rows")
        self.new: list[Tree] = []

    def begin(self, trees: list[Tree]) -> tuple[int, np.ndarray]:
        self.new += trees[-1:]
        if len(self.new) == TREES_PER_PASS:
            self.rows, self.new = keep(self._with_margin(), "boosting-rows"), []
        found = self._sums(None, [])
        return int(found.get(-1, np.zeros((self.layout.n, 3), np.int64))[0, 1]), found.get(0, np.zeros((self.layout.n, 3), np.int64))

    def _with_margin(self) -> DataFrame:
        new, ordered = self.new, self.layout.ordered

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margin = margins(code_matrix(batch), batch.column("margin").to_numpy(), new, ordered)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margin)], names=batch.schema.names)

        return self.rows.mapInArrow(add, self.rows.schema)

    def smaller(self, tree: Tree, asked: list[tuple[int, int]]) -> list[np.ndarray]:
        found = self._sums(tree, [child for _, child in asked])
        return [found.get(child, np.zeros((self.layout.n, 3), np.int64)) for _, child in asked]

    def _sums(self, tree: Tree | None, nodes: list[int]) -> dict[int, np.ndarray]:
        """Histograms of nodes; of all rows and the loss of held-out ones (at -1) without a tree."""
        new, layout = self.new, self.layout

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                codes, held_out = code_matrix(batch), batch.column("held_out").to_numpy(zero_copy_only=False)
                target, weight = (batch.column(c).to_numpy() for c in ("target", "weight"))
                margin = margins(codes, batch.column("margin").to_numpy(), new, layout.ordered)
                g, h = gradients(margin, target, weight)
                slots, leaf = layout.slots(codes), tree.leaf(codes, layout.ordered) if tree else np.zeros(len(codes), np.int64)
                for node in nodes or [0]:
                    own = ~held_out & (leaf == node)
                    total[node] = total.get(node, 0) + histogram(slots[own], g[own], h[own], layout.n)
                if tree is None:
                    loss = np.zeros((layout.n, 3), np.int64)
                    loss[0, 1] = losses(margin[held_out], target[held_out], weight[held_out]).sum()
                    total[-1] = total.get(-1, 0) + loss
            for node, hist in total.items():
                slot = np.flatnonzero(hist.any(axis=1))
                columns = [np.full(len(slot), node, np.int32), slot.astype(np.int32), *[np.ascontiguousarray(hist[slot, k]) for k in range(3)]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "slot", "n", "g", "h"])

        each = self.rows.mapInArrow(sums, "node int, slot int, n bigint, g bigint, h bigint")
        out: dict[int, np.ndarray] = {}
        for r in each.groupBy("node", "slot").agg(*[F.sum(c).alias(c) for c in "ngh"]).collect():
            out.setdefault(r["node"], np.zeros((layout.n, 3), np.int64))[r["slot"]] = (r["n"], r["g"], r["h"])
        return out


def code_matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("codes")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


# ---- fitting -----------------------------------------------------------------------------------

def boost(rows: HeldRows | StoredRows, layout: Layout, how: Boosting, stops: bool, ahead: int) -> list[Tree]:
    """Trees, one round after the other, until the held-out loss has not fallen for ``patience`` rounds."""
    trees: list[Tree] = []
    seen: list[float] = []
    while True:
        loss, root = rows.begin(trees)
        seen.append(loss / ONE)
        if stops and len(seen) > how.patience:
            before, last = seen[-how.patience - 1], seen[-how.patience :]
            if min(last) >= before * (1.0 - how.least_gain):
                break
        if len(trees) == how.rounds:
            break
        trees.append(grow(root, layout, how, rows.smaller, ahead))
    return trees


@dataclass
class Task:
    """What a fit reads: the rows with weights, the log-odds to start from, and whether some rows are held out."""

    rows: DataFrame
    n: int
    base: float
    stops: bool


def _task(rows: DataFrame, how: Boosting, balanced: bool, seed: int) -> Task:
    counts = {int(r["target"]): r["count"] for r in rows.groupBy("target").count().collect()}
    n, pos = sum(counts.values()), counts.get(1, 0)
    weight = {c: n / (2.0 * counts[c]) if balanced and counts.get(c) else 1.0 for c in (0, 1)}
    total = weight[1] * pos + weight[0] * (n - pos)
    share = min(max(weight[1] * pos / total, 1e-6), 1 - 1e-6) if total else 0.5
    stops = n > how.early_stop_rows
    held_out = F.coalesce(hash_bucket("encounter_id", seed + 2) < how.holdout, F.lit(False)) if stops else F.lit(False)
    table = rows.select(
        "codes", F.col("target").cast("double").alias("target"),
        F.when(F.col("target") == 1, weight[1]).otherwise(weight[0]).alias("weight"), held_out.alias("held_out"))
    return Task(table, n, math.log(share / (1.0 - share)), stops)


def fit(rows: DataFrame, codes: Codes, how: Boosting, balanced: bool, seed: int, in_task_rows: int = IN_TASK_ROWS, alone_rows: int = ALONE_ROWS) -> dict:
    """A boosted model as plain data: ``base`` and ``trees``. ``rows`` is (encounter_id, target, codes), stored.

    No rows, or rows of one class, give a model without splits.
    """
    layout, task = Layout(codes.sizes, codes.ordered), _task(rows, how, balanced, seed)
    base, stops = task.base, task.stops
    tasks = 1
    if task.n > min(alone_rows, in_task_rows):
        tasks = min(barrier_slots(rows.sparkSession), math.ceil(task.n / min(alone_rows, in_task_rows)))
    if task.n > tasks * in_task_rows:
        trees = boost(StoredRows(task.rows, base, layout), layout, how, stops, ahead=how.leaves)
        return {"base": base, "trees": [asdict(t) for t in trees]}

    def trees_in(tasks: int, at: str | None) -> list[dict] | None:
        """The trees, grown in so many tasks; none where they would have to wait for each other longer than one alone would take."""
        def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shared = {"exchange": Exchange(at)} if tasks > 1 else {}
            if shared and shared["exchange"].at is None and task_n <= in_task_rows:
                return
            parts = [
                (compact(code_matrix(b), layout), *(b.column(c).to_numpy(zero_copy_only=False) for c in ("target", "weight", "held_out")))
                for b in batches if b.num_rows
            ]
            if not parts:
                parts = [(np.zeros((0, len(layout.sizes)), np.uint8), np.zeros(0), np.zeros(0), np.zeros(0, bool))]
            columns = [np.concatenate(x) for x in zip(*parts)]
            del parts
            held = (SharedRows if shared else HeldRows)(*columns, base, layout, **shared)
            del columns
            ahead = 1 if not shared else SHARED_AHEAD if shared["exchange"].at else how.leaves
            trees = boost(held, layout, how, stops, ahead)
            if not shared or shared["exchange"].me == 0:
                yield pa.RecordBatch.from_arrays([pa.array([json.dumps([asdict(t) for t in trees])])], names=["trees"])

        task_n = task.n
        # Each task's rows are few, by the count above.
        found = task.rows.repartition(tasks).mapInArrow(in_task, "trees string", barrier=tasks > 1).collect()
        return json.loads(found[0]["trees"]) if found else None

    at = exchange_dir(rows.sparkSession) if tasks > 1 else None
    try:
        trees = trees_in(tasks, at)
    finally:
        if at:
            shutil.rmtree(at, ignore_errors=True)
    if trees is None:
        trees = trees_in(1, None) if tasks > 1 else []
    return {"base": base, "trees": trees or []}


def barrier_slots(spark: SparkSession) -> int:
    """Tasks that can run at the same time, as a barrier stage's must; 1 where Spark allows no such stage."""
    conf = spark.sparkContext.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 1
    cores = spark.sparkContext.defaultParallelism
    if conf.contains("spark.default.parallelism"):  # then it says nothing about cores
        executors = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1  # the driver is listed too
        cores = min(cores, executors * int(conf.get("spark.executor.cores", "1")))
    return max(1, cores // int(conf.get("spark.task.cpus", "1")))


def root_gains(rows: DataFrame, codes: Codes, how: Boosting, balanced: bool, seed: int) -> list[tuple[str, int, float | None]]:
    """(feature, codes that occur, best gain) at the root of the first tree; no gain where no split is allowed."""
    layout, task = Layout(codes.sizes, codes.ordered), _task(rows, how, balanced, seed)
    _, root = StoredRows(task.rows, task.base, layout).begin([])
    gain, out = gains(root, layout, how), []
    for name, first, size in zip(codes.names(), layout.first, layout.sizes):
        best = float(gain[first : first + size].max())
        out.append((name, int((root[first : first + size, 0] > 0).sum()), best if math.isfinite(best) else None))
    return out


def load_trees(model: dict) -> list[Tree]:
    return [Tree(**t) for t in model["trees"]]
