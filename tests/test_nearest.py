"""KD-trees and nearest neighbours against brute force."""

import numpy as np
import pytest

from punctum.functions import trees
from punctum.operators import compare
from punctum.params import AXES

NONE = np.iinfo(np.int64).max


def brute(q, p, numbers):
    found = trees.distances(q[:, None], p[None])
    least = found.min(axis=1)
    return least, np.where(found == least[:, None], numbers, NONE).min(axis=1)


def clouds(seed, n, ndim):
    draw = np.random.default_rng(seed)
    kinds = [draw.random((n, ndim)) * 50, 20 + draw.random((n, ndim)) * 1e-7, np.repeat(draw.random((1, ndim)), n, axis=0), draw.integers(0, 6, (n, ndim)).astype(float)]
    return np.concatenate([k[: n // (1 + i)] for i, k in enumerate(kinds)])


@pytest.mark.parametrize("ndim", [2, 3])
@pytest.mark.parametrize("n", [1, 16, 17, 200])
def test_tree_equals_brute_force(ndim, n, monkeypatch):
    points, queries = clouds(1, n, ndim), clouds(2, n, ndim)
    numbers = np.random.default_rng(3).permutation(len(points)) * 7
    want = brute(queries, points, numbers)
    for slice_, open_ in ((4096, 1 << 18), (50, 40)):
        monkeypatch.setattr(trees, "SLICE", slice_), monkeypatch.setattr(trees, "OPEN", open_)
        got = trees.Tree(points, numbers).nearest(queries, np.full(len(queries), np.inf), np.full(len(queries), NONE))
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_points_on_a_circle_around_the_queries(monkeypatch):
    turn = np.linspace(0, 2 * np.pi, 3000, endpoint=False)
    points = np.stack([np.cos(turn), np.sin(turn)], axis=1)
    monkeypatch.setattr(trees, "OPEN", 100)
    queries = np.zeros((40, 2))
    got = trees.Tree(points, np.arange(3000)).nearest(queries, np.full(40, np.inf), np.full(40, NONE))
    assert (got[1] == brute(queries, points, np.arange(3000))[1]).all()


def test_what_is_given_stays_if_it_is_nearer():
    tree = trees.Tree(np.array([[0.0, 0.0]]), np.array([5]))
    distance, number = tree.nearest(np.array([[1.0, 0.0]] * 4), np.array([0.5, 1.0, 1.0, 2.0]), np.array([9, 9, 3, 1]))
    assert distance.tolist() == [0.5, 1.0, 1.0, 1.0] and number.tolist() == [9, 5, 3, 5]


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("ndim, apart, taken", [(2, 0.0, 1 << 20), (3, 0.0, 20), (2, 400.0, 10)])
def test_ranges_hot_places_and_far_queries(spark, many_ranges, monkeypatch, ndim, apart, taken):
    monkeypatch.setattr(compare, "TAKEN", taken), monkeypatch.setattr(compare, "PACKED", 30)
    axes = AXES[ndim]
    points, queries = clouds(4, 120, ndim), clouds(5, 120, ndim) + apart
    queries[:80] = queries[0]
    schema = "id long, " + ", ".join(f"{a} double" for a in axes)
    a = spark.createDataFrame([(k % 100, *map(float, p)) for k, p in enumerate(queries)] + [(7, *[None] * ndim)], schema)
    b = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(points)] + [(-1, None, *[1.0] * (ndim - 1))], schema)
    distance, number = brute(queries, points, np.arange(len(points)))
    want = sorted([(k % 100, n, d) for k, (n, d) in enumerate(zip(number.tolist(), distance.tolist()))] + [(7, None, None)], key=repr)
    got = sorted(((r.id, r.match_id, r.distance) for r in compare.nearest(a, b, axes).collect()), key=repr)
    assert [x[:2] for x in got] == [x[:2] for x in want] and all(x[2] == y[2] for x, y in zip(got, want))


def test_no_points_and_no_queries(spark):
    some, none = spark.createDataFrame([(1, 0.0, 0.0)], "id long, x double, y double"), spark.createDataFrame([], "id long, x double, y double")
    assert [tuple(r) for r in compare.nearest(some, none, AXES[2]).collect()] == [(1, None, None)]
    assert compare.nearest(none, some, AXES[2]).collect() == []
    assert [tuple(r) for r in compare.nearest(some, some, AXES[2]).collect()] == [(1, 1, 0.0)]
