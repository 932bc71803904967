"""Batched fits against a plain loop over spots."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from punctum.operators import batched
from punctum.params import BG_MEAN, BG_MEDIAN, BG_RANSAC_MEAN, BG_RANSAC_MEDIAN, MULTICONSENSUS, NO_RANSAC, RANSAC, SpotParams


def centre_of(p, g):
    m = sum((np.eye(len(x)) - np.outer(x, x) for x in g), np.zeros((p.shape[1],) * 2))
    b = sum(((np.eye(len(x)) - np.outer(x, x)) @ y for x, y in zip(g, p)), np.zeros(p.shape[1]))
    return np.linalg.solve(m, b) if len(g) and abs(np.linalg.det(m)) >= 1e-9 else None


def agreeing(image, at, k, p, g, params):
    n = len(g)
    if n < 2:
        return []
    digest = hashlib.md5("|".join(map(str, [image, *at, k])).encode()).hexdigest()
    s = [int(digest[8 * i : 8 * i + 8], 16) for i in range(3)]
    best = []
    for t in range(params.hypotheses):
        i = (s[0] + t * s[1]) % batched.PRIME % n
        j = (i + 1 + (s[1] + t * s[2]) % batched.PRIME % (n - 1)) % n
        c = centre_of(p[[i, j]], g[[i, j]])
        if c is not None:
            off = ((c - p) ** 2).sum(axis=1) - ((c - p) * g).sum(axis=1) ** 2
            near = np.flatnonzero(off <= params.max_error**2 + 1e-9)
            best = near if len(near) > len(best) else best
    return best


def one_by_one(images, at, p, g, mask, stretch, params):
    out = []
    for s, image in enumerate(images):
        norm = np.sqrt((g[s] ** 2).sum(axis=1))
        keep = mask[s] & (norm > 1e-9)
        q, h = p[s][keep] * stretch, g[s][keep] / norm[keep, None]
        n, left, k = len(h), np.arange(keep.sum()), 0
        while True:
            used = left if params.ransac == NO_RANSAC else left[agreeing(image, at[s].tolist(), k, q[left], h[left], params)]
            least = {NO_RANSAC: 1, RANSAC: max(params.inlier_ratio * n, 0), MULTICONSENSUS: params.min_inliers}[params.ransac]
            if not n or len(used) < least:
                break
            c = centre_of(q[used], h[used])
            if c is not None and (params.max_shift is None or (np.abs(c / stretch) <= params.max_shift).all()):
                out.append((s, k, n, len(used), *np.round(c / stretch, 6)))
            if params.ransac != MULTICONSENSUS:
                break
            left, k = np.setdiff1d(left, used), k + 1
    return sorted(out)


def spots(seed, ndim, count=60):
    """Lines through one or two points with noise, some spots with few, no or zero gradients."""
    draw = np.random.default_rng(seed)
    members = 7**ndim if ndim == 2 else 60
    p = draw.integers(-3, 4, (count, members, ndim)).astype(float)
    centre = draw.normal(0, 0.5, (count, 2, ndim))[np.arange(count)[:, None], draw.integers(0, 2, (count, members))]
    g = (centre - p) * draw.normal(1, 0.2, (count, members, 1)) + draw.normal(0, 0.3, p.shape)
    g[draw.random((count, members)) < 0.1] = 0
    mask = draw.random((count, members)) < 0.9
    mask[0], mask[1], mask[2, 1:] = False, np.arange(members) < 2, False
    g[3] = 0
    g[4, :] = [1.0] * ndim  # parallel lines meet nowhere
    return [f"i{s % 3}" for s in range(count)], draw.integers(0, 500, (count, ndim)), p, g, mask


@pytest.mark.parametrize("ndim", [2, 3])
@pytest.mark.parametrize("settings", [
    dict(ransac=NO_RANSAC), dict(ransac=RANSAC, inlier_ratio=0.0), dict(ransac=RANSAC, inlier_ratio=0.6), dict(ransac=RANSAC, max_shift=0.4),
    dict(ransac=MULTICONSENSUS, min_inliers=6), dict(ransac=MULTICONSENSUS, min_inliers=1, max_error=0.4)])
def test_fits_equal_a_loop_over_spots(ndim, settings, monkeypatch):
    params = SpotParams(hypotheses=40, **settings)
    images, at, p, g, mask = spots(ndim, ndim)
    stretch = np.array([1.0, 1.0, 1.4][:ndim])
    want = one_by_one(images, at, p, g, mask, stretch, params)
    for cells in (batched.CELLS, 5_000):
        monkeypatch.setattr(batched, "CELLS", cells)
        f = batched.fit(images, at, p, g, mask, stretch, params)
        got = sorted(zip(f.spot.tolist(), f.round.tolist(), f.gradients.tolist(), f.inliers.tolist(), *f.centre.T.tolist()))
        assert [x[:4] for x in got] == [x[:4] for x in want]
        assert not want or np.allclose([x[4:] for x in got], [x[4:] for x in want], atol=1e-5, rtol=1e-5)


def test_no_spots_and_no_members():
    params = SpotParams()
    empty = batched.fit([], np.zeros((0, 2), int), np.zeros((0, 0, 2)), np.zeros((0, 0, 2)), np.zeros((0, 0), bool), np.ones(2), params)
    assert len(empty.spot) == 0 and empty.centre.shape == (0, 2)
    for width in (0, 1):
        lone = batched.fit(["i"], np.zeros((1, 2), int), np.zeros((1, width, 2)), np.ones((1, width, 2)), np.ones((1, width), bool), np.ones(2), params)
        assert len(lone.spot) == 0


def test_padded_lists():
    lists = [pa.array([[1, 2], [], [3]], pa.list_(pa.float64())).slice(1), pa.array([[4, 5], [], [6]], pa.list_(pa.float64())).slice(1)]
    values, mask = batched.padded(lists)
    assert mask.tolist() == [[False], [True]] and values.tolist() == [[[0, 0]], [[3, 6]]]


@pytest.mark.parametrize("method", [BG_MEAN, BG_MEDIAN, BG_RANSAC_MEAN, BG_RANSAC_MEDIAN])
def test_background_equals_a_loop(method):
    draw = np.random.default_rng(method)
    cube = np.stack(np.meshgrid(*[np.arange(-2, 3)] * 2, indexing="ij"), axis=-1).reshape(-1, 2)
    g, mask = np.round(draw.normal(0, 0.05, (30, 25, 2)), 2), draw.random((30, 25)) < 0.8
    mask[0] = False
    params = SpotParams(background=method, background_min_inlier_ratio=0.6)
    got = batched.subtract(cube, g, mask, 2, params)
    for s in range(30):
        outer = g[s][mask[s] & (np.abs(cube).max(axis=1) == 2)]
        for d in range(2):
            v, level = np.sort(outer[:, d]), 0.0
            if len(v) and method in (BG_MEAN, BG_MEDIAN):
                level = v.mean() if method == BG_MEAN else np.median(v)
            elif len(v):
                near = [v[np.abs(v - x) <= params.background_max_error + 1e-9] for x in v]
                most = max(near, key=len)
                if len(most) >= 0.6 * len(v):
                    level = most.mean() if method == BG_RANSAC_MEAN else np.median(most)
            assert np.allclose(got[s, :, d], g[s, :, d] - level)


def test_raster_gradients_and_interpolation():
    raw = np.arange(60.0).reshape(3, 4, 5) ** 1.5
    raster = batched.Raster(raw)
    value = lambda x, y, z: raw[z, y, x]
    got = raster.gradients(np.array([[2, 2, 1]]), np.array([[0, 0, 0], [1, -1, 0]]), [1, 1, 2.0])
    assert np.allclose(got[0, 1], [(value(4, 1, 1) - value(2, 1, 1)) / 2, (value(3, 2, 1) - value(3, 0, 1)) / 2, value(3, 1, 2) - value(3, 1, 0)])
    found, here = raster.interpolated(np.array([[4.0, 3.0, 2.0], [0.5, 0.0, 0.25], [4.1, 0.0, 0.0], [-0.1, 0.0, 0.0]]))
    assert here.tolist() == [True, True, False, False]
    assert np.allclose(found[:2], [value(4, 3, 2), 0.75 * (value(0, 0, 0) + value(1, 0, 0)) / 2 + 0.25 * (value(0, 0, 1) + value(1, 0, 1)) / 2])
