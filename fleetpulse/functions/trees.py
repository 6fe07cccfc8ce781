"""Isolation trees on numpy arrays: growing one, and path lengths for a batch.

These helpers run inside Spark tasks. The method is Liu, Ting and Zhou, "Isolation
Forest", ICDM 2008.

A tree is stored as a full binary tree in level order: node ``i`` has the children
``2i + 1`` (value <= threshold) and ``2i + 2``. Where a branch ends early, the nodes
below have an infinite threshold and all bottom slots below carry its path length.

A tree is constant on the boxes its thresholds cut, so most trees also get a table
from box to bottom slot. Rows are then binned once against the thresholds of the
whole forest, and every tree needs one small gather per feature and one from its
table instead of three gathers per level. Trees with too many boxes are walked.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle

# Tasks get this module's code along with the function they run, so the package
# need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Boxes that the tables of all trees together may have; each takes a byte or two.
TABLE_BUDGET = 1 << 25
# Boxes of one tree are numbered with this many bits, so that the numbers of three
# trees fit in one 64-bit integer and are looked up at once.
BOX_BITS = 21
PACKED = 3


class Tree(NamedTuple):
    feature: np.ndarray  # per inner node: the feature compared
    threshold: np.ndarray  # per inner node
    path: np.ndarray  # per bottom slot: path length
    table: np.ndarray | None = None  # box -> bottom slot, features in order


def mean_path(samples: int) -> float:
    """Mean path length of an unsuccessful search among ``samples`` points."""
    if samples <= 1:
        return 0.0
    if samples == 2:
        return 1.0
    harmonic = np.log(samples - 1.0) + np.euler_gamma
    return float(2.0 * harmonic - 2.0 * (samples - 1.0) / samples)


def tree_depth(samples: int) -> int:
    """Levels after which ``samples`` points are no longer split: ceil(log2)."""
    return max(samples - 1, 0).bit_length()


def unsplit_tree(depth: int) -> Tree:
    inner = (1 << depth) - 1
    return Tree(
        np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
    )


def slots_below(node: int, level: int, depth: int) -> slice:
    """The bottom slots under a node."""
    below = depth - level
    first = ((node + 1) << below) - (1 << depth)
    return slice(first, first + (1 << below))


def grow_tree(points: np.ndarray, rng: np.random.Generator) -> Tree:
    """Split ``points`` (rows x features) at random until isolated or too deep."""
    depth = tree_depth(len(points))
    tree = unsplit_tree(depth)
    pending = [(0, 0, points)]
    while pending:
        node, level, rows = pending.pop()
        varying = ()
        if level < depth and len(rows) > 1:
            lowest, highest = rows.min(axis=0), rows.max(axis=0)
            varying = np.flatnonzero(highest > lowest)
        if not len(varying):
            tree.path[slots_below(node, level, depth)] = level + mean_path(len(rows))
            continue
        feature = varying[rng.integers(len(varying))]
        threshold = rng.uniform(lowest[feature], highest[feature])
        if threshold >= highest[feature]:  # rounding may reach the open end
            threshold = lowest[feature]
        tree.feature[node], tree.threshold[node] = feature, threshold
        right = rows[:, feature] > threshold
        pending.append((2 * node + 1, level + 1, rows[~right]))
        pending.append((2 * node + 2, level + 1, rows[right]))
    return tree


def tabulate(tree: Tree, width: int, budget: int = TABLE_BUDGET) -> Tree:
    """Add the table, unless it would have more than ``budget`` boxes."""
    budget = min(budget, 1 << BOX_BITS)
    own = [thresholds(tree, feature) for feature in range(width)]
    shape = tuple(len(t) + 1 for t in own)
    if np.prod(shape, dtype=float) > budget:
        return tree
    depth = len(tree.path).bit_length() - 1
    cut = np.zeros(len(tree.threshold), np.int64)
    for feature in range(width):
        nodes = tree.feature == feature
        cut[nodes] = np.searchsorted(own[feature], tree.threshold[nodes]) + 1
    table = np.zeros(shape, np.min_scalar_type(len(tree.path) - 1))
    pending = [(0, 0, tuple(slice(0, size) for size in shape))]
    while pending:
        node, level, box = pending.pop()
        if level == depth or tree.threshold[node] == np.inf:
            table[box] = slots_below(node, level, depth).start
            continue
        split = tree.feature[node]
        side = box[split]
        for child, part in (
            (2 * node + 1, slice(side.start, cut[node])),
            (2 * node + 2, slice(cut[node], side.stop)),
        ):
            pending.append((child, level + 1, (*box[:split], part, *box[split + 1 :])))
    return tree._replace(table=table.ravel())


def thresholds(tree: Tree, feature: int) -> np.ndarray:
    """Sorted thresholds at which a tree splits one feature."""
    used = (tree.feature == feature) & (tree.threshold < np.inf)
    return np.unique(tree.threshold[used])


class PathLengths:
    """Mean path length over a forest, for batches of rows."""

    def __init__(self, trees: Sequence[Tree], width: int) -> None:
        self.count = len(trees)
        self.walked = [tree for tree in trees if tree.table is None]
        tabled = [tree for tree in trees if tree.table is not None]
        self.edges = [
            np.unique(np.concatenate([[], *(thresholds(t, f) for t in tabled)]))
            for f in range(width)
        ]
        self.packs = []
        for start in range(0, len(tabled), PACKED):
            members = tabled[start : start + PACKED]
            shares = [self._shares(tree) for tree in members]
            packed = [
                sum(share << BOX_BITS * place for place, share in enumerate(of_feature))
                for of_feature in zip(*shares)
            ]
            self.packs.append((packed, members))

    def _shares(self, tree: Tree) -> list[np.ndarray]:
        """Per feature: bin among all edges -> what it adds to the box number."""
        shares, stride = [], tree.table.size
        for feature, edges in enumerate(self.edges):
            own = thresholds(tree, feature)
            stride //= len(own) + 1
            shares.append(np.searchsorted(own, np.append(edges, np.inf)) * stride)
        return shares

    def __call__(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        rows = len(columns[0])
        total, length = np.zeros(rows), np.empty(rows)
        for tree in self.walked:
            total += tree.path.take(walk(tree, columns))
        bins = [np.searchsorted(e, c) for e, c in zip(self.edges, columns)]
        boxes, part = np.empty(rows, np.int64), np.empty(rows, np.int64)
        # Indices are in range by construction; "clip" skips the check.
        for (first, *others), members in self.packs:
            first.take(bins[0], out=boxes, mode="clip")
            for share, place in zip(others, bins[1:]):
                boxes += share.take(place, out=part, mode="clip")
            for tree in members:
                np.bitwise_and(boxes, (1 << BOX_BITS) - 1, out=part)
                slot = tree.table.take(part, mode="clip")
                total += tree.path.take(slot, out=length, mode="clip")
                boxes >>= BOX_BITS
        return total / self.count


def worker_tables(name: str, trees: Sequence[tuple], width: int) -> PathLengths:
    """The forest's tables, built once by a Python worker for all its tasks.

    This module comes anew with every task, so the last forest is kept beside it.
    """
    kept = vars(sys).setdefault("_forest_tables", {})
    if name not in kept:
        kept.clear()
        grown, budget = [Tree(*arrays) for arrays in trees], TABLE_BUDGET // max(len(trees), 1)
        tabled = [t if t.table is not None else tabulate(t, width, budget) for t in grown]
        kept[name] = PathLengths(tabled, width)
    return kept[name]


def draw_slots(
    seed: int, codes: np.ndarray, slots: np.ndarray, share: float
) -> tuple[np.ndarray, np.ndarray]:
    """Which of each row's ``slots`` are drawn, each with probability ``share``.

    Returns the rows' places and their slots. How many a row gets is the binomial
    quantile of its own uniform number, which is what ``sampled`` compares in Spark: at
    least one is drawn where that is below ``1 - (1 - share) ** slots``. Nothing but the
    row's code and the seed decides.
    """
    codes = codes.astype(np.int64).view(np.uint64)
    counts = np.minimum(_slot_counts(codes, slots, share), slots)
    row = np.repeat(np.arange(len(codes)), counts)
    if share > 0.5:  # few rows in all: put the slots of each in random order
        orders = [
            np.random.default_rng([seed, int(code)]).permutation(int(n))[:count]
            for code, n, count in zip(codes, slots, counts, strict=True)
        ]
        return row, np.concatenate([np.zeros(0, np.int64), *orders])
    # The n-th slot of a row is a hash of its code and n; slots taken are drawn again.
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    base = mixed(codes ^ mixed(np.full(1, seed, np.uint64)))
    slot = np.zeros(len(row), np.int64)
    left, attempt = np.arange(len(row)), 0
    while len(left):
        turn = np.uint64(attempt) * np.uint64(1 << 40) + number[left].astype(np.uint64)
        slot[left] = (mixed(base[row[left]] + turn) % slots[row[left]].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((number, slot, row))
        same = (row[order][1:] == row[order][:-1]) & (slot[order][1:] == slot[order][:-1])
        left, attempt = np.sort(order[1:][same]), attempt + 1
    return row, slot


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits well mixed."""
    values = values + np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _slot_counts(codes: np.ndarray, slots: np.ndarray, share: float) -> np.ndarray:
    if share >= 1.0:
        return slots.astype(np.int64)
    uniform = (codes >> np.uint64(11)) * 2.0**-53
    counts = np.zeros(len(codes), np.int64)
    many = slots * share > 500
    for place in np.flatnonzero(many):
        counts[place] = _tail_quantile(float(uniform[place]), int(slots[place]), share)
    # From above: the smaller the number, the more slots are drawn.
    chance = np.exp(slots * math.log1p(-share))
    left = 1.0 - chance
    rest = np.flatnonzero(~many & (uniform < left))
    while len(rest):
        counts[rest] += 1
        chance[rest] *= (slots[rest] - counts[rest] + 1) / counts[rest] * share / (1 - share)
        left[rest] -= chance[rest]
        rest = rest[(uniform[rest] < left[rest]) & (counts[rest] < slots[rest])]
    return counts


def _tail_quantile(uniform: float, slots: int, share: float) -> int:
    """The largest count that a binomial number reaches with more than ``uniform``.

    Its chances start too small for doubles, so they are summed around the mean, as far
    out as any number of 53 bits can tell.
    """
    mean = slots * share
    reach = math.ceil(12 * math.sqrt(mean)) + 1
    low, high = max(math.floor(mean) - reach, 0), min(math.ceil(mean) + reach, slots)
    counts = np.arange(low + 1, high + 1)
    steps = np.log(slots - counts + 1.0) - np.log(counts) + math.log(share) - math.log1p(-share)
    heights = np.concatenate([[0.0], np.cumsum(steps)])
    chances = np.exp(heights - heights.max())
    above = np.cumsum(chances[::-1])[::-1] / chances.sum()  # of reaching low, low + 1, ...
    return low + int(np.count_nonzero(above > uniform)) - 1


def walk(tree: Tree, columns: Sequence[np.ndarray]) -> np.ndarray:
    """Bottom slot per row, following the splits level by level."""
    values = np.concatenate(columns)
    row = np.arange(len(columns[0]))
    first = tree.feature * len(row)
    inner = len(tree.threshold)
    node = np.zeros(len(row), np.int64)
    while len(row) and node[0] < inner:
        value = values.take(first.take(node) + row)
        node = 2 * node + 1 + (value > tree.threshold.take(node))
    return node - inner
