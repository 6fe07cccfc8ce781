"""The numpy helpers against plain recursion."""

from __future__ import annotations

import math
import subprocess
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from fleetpulse.functions.trees import (
    PathLengths,
    grow_tree,
    mean_path,
    tabulate,
    thresholds,
    tree_depth,
    walk,
)


def points(seed, rows, width=3):
    rng = np.random.default_rng(seed)
    cloud = rng.normal(0, 1, (rows, width))
    cloud[:, 0] = np.round(cloud[:, 0], 1)
    return cloud


def descend(tree, row):
    """Path length of one row by following the splits one at a time."""
    node = 0
    while node < len(tree.threshold):
        right = row[tree.feature[node]] > tree.threshold[node]
        node = 2 * node + (2 if right else 1)
    return tree.path[node - len(tree.threshold)]


def leaves(tree, rows, node=0, level=0):
    """(rows, depth, path) of every branch end."""
    if node >= len(tree.threshold) or tree.threshold[node] == np.inf:
        while node < len(tree.threshold):
            node = 2 * node + 1
        return [(rows, level, tree.path[node - len(tree.threshold)])]
    right = rows[:, tree.feature[node]] > tree.threshold[node]
    return leaves(tree, rows[~right], 2 * node + 1, level + 1) + leaves(
        tree, rows[right], 2 * node + 2, level + 1
    )


@pytest.mark.parametrize(
    ("samples", "length"),
    [(0, 0.0), (1, 0.0), (2, 1.0), (3, 1.20739236), (256, 10.24477092)],
)
def test_mean_path(samples, length):
    assert mean_path(samples) == pytest.approx(length, abs=1e-8)


@pytest.mark.parametrize("samples", [1, 2, 3, 4, 5, 255, 256, 257])
def test_depth_is_ceil_log2(samples):
    assert tree_depth(samples) == math.ceil(math.log2(samples))


@pytest.mark.parametrize("rows", [1, 2, 3, 17, 256])
def test_every_split_divides_and_every_end_is_isolated_equal_or_deep(rows):
    cloud = points(rows, rows)
    tree = grow_tree(cloud, np.random.default_rng(1))
    ends = leaves(tree, cloud)
    assert sum(len(members) for members, _, _ in ends) == rows
    for members, level, path in ends:
        assert len(members) > 0
        distinct = len(np.unique(members, axis=0))
        assert distinct == 1 or level == tree_depth(rows)
        assert path == pytest.approx(level + mean_path(len(members)))


def test_constant_features_are_never_split():
    cloud = points(4, 64)
    cloud[:, 1] = 7.0
    tree = grow_tree(cloud, np.random.default_rng(2))
    assert len(thresholds(tree, 1)) == 0
    assert len(thresholds(tree, 0)) > 0 and len(thresholds(tree, 2)) > 0


def test_equal_points_make_one_leaf():
    tree = grow_tree(np.ones((8, 3)), np.random.default_rng(0))
    assert np.isinf(tree.threshold).all()
    assert tree.path == pytest.approx(np.full(8, mean_path(8)))


def test_neighbouring_doubles_are_still_divided():
    low, high = 1.0, np.nextafter(1.0, 2.0)
    for seed in range(20):
        tree = grow_tree(np.array([[low], [high]]), np.random.default_rng(seed))
        assert tree.threshold.tolist() == [low]
        assert tree.path.tolist() == [1.0, 1.0]


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 200), st.integers(1, 4))
def test_tables_walks_and_recursion_agree(seed, sample, width):
    rng = np.random.default_rng(seed)
    cloud = points(seed, 300, width)
    trees = [
        grow_tree(cloud[rng.choice(300, sample, replace=False)], rng) for _ in range(5)
    ]
    # Rows on the thresholds themselves, and beyond the sampled range.
    probe = np.concatenate([cloud, cloud * 3.0, np.full((1, width), np.nan)])
    for tree in trees:
        for feature in range(width):
            cuts = thresholds(tree, feature)[:20]
            on_cut = np.repeat(cloud[:1], len(cuts), axis=0)
            on_cut[:, feature] = cuts
            probe = np.concatenate([probe, on_cut])
    columns = [np.ascontiguousarray(c) for c in probe.T]
    expected = np.mean([[descend(t, r) for r in probe] for t in trees], axis=0)
    known = ~np.isnan(probe).any(axis=1)
    tabulated = [tabulate(tree, width) for tree in trees]
    mixed = [tabulated[0], trees[1], *tabulated[2:]]
    for forest in (tabulated, trees, mixed):
        found = PathLengths(forest, width)(columns)
        assert found[known] == pytest.approx(expected[known], abs=1e-12)


def test_large_trees_get_no_table():
    cloud = points(5, 256)
    tree = grow_tree(cloud, np.random.default_rng(0))
    assert tabulate(tree, 3, 10).table is None
    assert tabulate(tree, 3).table is not None
    # Twelve features with a dozen splits each cut more boxes than can be numbered.
    wide = grow_tree(points(7, 256, 12), np.random.default_rng(0))
    assert tabulate(wide, 12).table is None


def test_no_rows():
    tree = grow_tree(points(6, 16), np.random.default_rng(0))
    nothing = [np.empty(0)] * 3
    assert len(walk(tree, nothing)) == 0
    for forest in ([tree], [tabulate(tree, 3)]):
        assert len(PathLengths(forest, 3)(nothing)) == 0


def test_tasks_need_no_installed_package(tmp_path):
    """Executors run the helpers from what is pickled with the function."""
    cloud = points(8, 64)

    def task():
        tree = tabulate(grow_tree(cloud, np.random.default_rng(0)), 3)
        return PathLengths([tree], 3)(list(cloud.T)).sum()

    (tmp_path / "task").write_bytes(cloudpickle.dumps(task))
    run = subprocess.run(
        [sys.executable, "-I", "-c",
         "import pickle, sys; print(pickle.load(open('task', 'rb'))());"
         "assert 'fleetpulse' not in sys.modules"],
        cwd=tmp_path, capture_output=True, text=True, check=False,
    )
    assert run.returncode == 0, run.stderr
    assert float(run.stdout) == pytest.approx(task())
