"""Radial symmetry fits of many spots at once.

Spots are padded to arrays ``(spot, gradient, axis)`` with a mask of their members; every step is an array operation over
all spots of a slice, whose size bounds the memory. Definitions are those of ``localize.py``.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from punctum.functions.numeric import SINGULAR, SLACK, ZERO_NORM
from punctum.params import BG_MEAN, BG_MEDIAN, BG_NONE, BG_RANSAC_MEAN, MULTICONSENSUS, NO_RANSAC, SpotParams

# Fixed value: modulus of the hypothesis sampling.
PRIME = 4294967291
#: Numbers in the largest array of a slice: hypotheses times gradients times spots.
CELLS = 1 << 19


class Fits(NamedTuple):
    """Found centres: the number of the spot, the offset from it, all its gradients, those that agree, and the round."""

    spot: np.ndarray
    centre: np.ndarray
    gradients: np.ndarray
    inliers: np.ndarray
    round: np.ndarray


def joined(parts: list[Fits], ndim: int) -> Fits:
    none = Fits(np.zeros(0, np.int64), np.zeros((0, ndim)), *(np.zeros(0, np.int64) for _ in range(3)))
    return Fits(*map(np.concatenate, zip(none, *parts)))


def slices(spots: int, members: int, params: SpotParams) -> Iterator[slice]:
    step = max(1, CELLS // max(1, members * (1 if params.ransac == NO_RANSAC else params.hypotheses)))
    return (slice(at, min(at + step, spots)) for at in range(0, spots, step))


def padded(lists: list[pa.ListArray]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of equal lengths, one per axis, as ``(spot, member, axis)`` and the mask of members."""
    lengths = np.asarray(lists[0].value_lengths(), np.int64)
    mask = np.arange(int(lengths.max(initial=0))) < lengths[:, None]
    out = np.zeros((*mask.shape, len(lists)))
    for d, column in enumerate(lists):
        out[mask, d] = column.flatten().to_numpy(zero_copy_only=False)
    return out, mask


def fit(images: list[str], at: np.ndarray, p: np.ndarray, g: np.ndarray, mask: np.ndarray, stretch: np.ndarray, params: SpotParams) -> Fits:
    """Centres of spots at the integer positions ``at``, from gradients ``g`` at offsets ``p`` that count as ``stretch`` says."""
    parts = []
    for part in slices(len(at), mask.shape[1], params):
        found = _fit(images[part], at[part], p[part], g[part], mask[part], stretch, params)
        parts.append(found._replace(spot=found.spot + part.start))
    return joined(parts, at.shape[1])


def _fit(images, at, p, g, mask, stretch, params: SpotParams) -> Fits:
    norm = np.sqrt((g * g).sum(axis=2))
    rest = mask & (norm > ZERO_NORM)
    g = np.where(rest[..., None], g / np.where(rest, norm, 1.0)[..., None], 0.0)
    p = np.where(rest[..., None], p * stretch, 0.0)
    n, open_, parts, k = rest.sum(axis=1), np.arange(len(at)), [], 0
    # Multi-consensus ends by itself: every round uses up at least min_inliers gradients of a spot that stays open.
    while len(open_):
        left = rest[open_]
        used = left if params.ransac == NO_RANSAC else _consensus([images[s] for s in open_], at[open_], k, p[open_], g[open_], left, params)
        inliers = used.sum(axis=1)
        enough = {NO_RANSAC: n[open_] > 0, MULTICONSENSUS: inliers >= params.min_inliers}.get(params.ransac, (n[open_] > 0) & (inliers >= params.inlier_ratio * n[open_]))
        centre, sound = _intersection(p[open_], g[open_], used)
        centre = centre / stretch
        good = enough & sound
        if params.max_shift is not None:
            good &= (np.abs(centre) <= params.max_shift).all(axis=1)
        parts.append(Fits(open_[good], centre[good], n[open_[good]], inliers[good], np.full(good.sum(), k)))
        if params.ransac != MULTICONSENSUS:
            break
        rest[open_] = left & ~used
        open_, k = open_[enough], k + 1
    return joined(parts, at.shape[1])


def _solve(m: dict[tuple[int, int], np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Solutions of symmetric 2x2 or 3x3 systems held by component, and which are not singular."""
    a = lambda i, j: m[min(i, j), max(i, j)]
    if len(b) == 2:
        adjugate = [[a(1, 1), -a(0, 1)], [-a(0, 1), a(0, 0)]]
    else:
        minor = lambda i, j: [a(r, c) for r in range(3) if r != i for c in range(3) if c != j]
        cofactor = lambda i, j: (1 if (i + j) % 2 == 0 else -1) * (lambda w, x, y, z: w * z - x * y)(*minor(i, j))
        adjugate = [[cofactor(i, j) for j in range(3)] for i in range(3)]
    det = sum(a(0, j) * adjugate[0][j] for j in range(len(b)))
    sound = np.abs(det) >= SINGULAR
    return np.stack([sum(x * y for x, y in zip(row, b)) for row in adjugate], axis=-1) / np.where(sound, det, 1.0)[..., None], sound


def _normal_form(p, g):
    """Components of I - g g' and of its product with p."""
    axes = range(p.shape[-1])
    m = {(i, j): (1.0 if i == j else 0.0) - g[..., i] * g[..., j] for i in axes for j in axes if i <= j}
    return m, [sum(m[min(i, j), max(i, j)] * p[..., j] for j in axes) for i in axes]


def _intersection(p, g, used):
    m, b = _normal_form(p, g)
    return _solve({key: (v * used).sum(axis=1) for key, v in m.items()}, [(v * used).sum(axis=1) for v in b])


def sampled_pairs(images, at, k: int, n: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ranks below ``n`` (at least 2) per spot: arithmetic progressions seeded by a hash of the spot and round."""
    names = ["|".join(map(str, (image, *place, k))) for image, place in zip(images, at.tolist())]
    digests = b"".join(md5(name.encode()).digest()[:12] for name in names)
    s0, s1, s2 = np.frombuffer(digests, ">u4").reshape(-1, 3).astype(np.int64).T[:, :, None]
    t, n = np.arange(count, dtype=np.int64), n[:, None]
    i = (s0 + t * s1) % PRIME % n
    return i, (i + 1 + (s1 + t * s2) % PRIME % (n - 1)) % n


def _consensus(images, at, k: int, p, g, rest, params: SpotParams) -> np.ndarray:
    """Mask of the gradients that agree with each spot's best two-gradient hypothesis (ties: lowest)."""
    n = rest.sum(axis=1)
    order = np.argsort(~rest, axis=1, kind="stable")
    if rest.shape[1] < 2:
        return np.zeros_like(rest)
    first, second = (np.take_along_axis(order, ranks, axis=1) for ranks in sampled_pairs(images, at, k, np.maximum(n, 2), params.hypotheses))
    pair = lambda v: np.take_along_axis(v, first, axis=1) + np.take_along_axis(v, second, axis=1)
    m, b = _normal_form(p, g)
    centre, sound = _solve({key: pair(v) for key, v in m.items()}, [pair(v) for v in b])
    square = along = 0.0
    for d in range(p.shape[2]):
        step = centre[:, :, None, d] - p[:, None, :, d]
        along = along + step * g[:, None, :, d]
        step *= step
        square = square + step
    along *= along
    square -= along
    agrees = (square <= params.max_error**2 + SLACK) & rest[:, None, :] & (sound & (n >= 2)[:, None])[:, :, None]
    best = np.argmax(np.count_nonzero(agrees, axis=2), axis=1)
    return agrees[np.arange(len(at)), best]


# --- pixels around spots -------------------------------------------------------------------


class Raster:
    """A block of pixels, indexed by positions in the order of the axes (the array's are reversed)."""

    def __init__(self, raw: np.ndarray):
        self.flat, self.size = np.ascontiguousarray(raw).ravel(), np.array(raw.shape[::-1])
        self.stride = np.concatenate([[1], np.cumprod(self.size[:-1])])

    def gradients(self, inner: np.ndarray, cube: np.ndarray, factors) -> np.ndarray:
        """Central differences at each spot's cube of offsets, per axis times its factor."""
        at = (inner @ self.stride)[:, None] + (cube @ self.stride)[None]
        return np.stack([(self.flat[at + s] - self.flat[at - s]) / 2.0 * f for s, f in zip(self.stride, factors)], axis=-1)

    def interpolated(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-linear values at sub-pixel positions, and which of these lie in the block."""
        here = ((at >= 0) & (at <= self.size - 1)).all(axis=1)
        at = np.where(here[:, None], at, 0.0)
        base = np.floor(at).astype(np.int64)
        part, out = at - base, np.zeros(len(at))
        for corner in np.ndindex(*(2,) * at.shape[1]):
            weight = np.where(corner, part, 1.0 - part).prod(axis=1)
            out += weight * self.flat[np.minimum(base + corner, self.size - 1) @ self.stride]
        return out, here


def subtract(cube: np.ndarray, g: np.ndarray, mask: np.ndarray, r: int, params: SpotParams) -> np.ndarray:
    """Background subtraction (see ``support.background``) for spots that share a cube of offsets."""
    outer = np.abs(cube).max(axis=1) == r
    v, inside = g[:, outer], mask[:, outer]
    count = inside.sum(axis=1)
    if params.background == BG_NONE or not outer.any():
        return g
    some = np.maximum(count, 1)[:, None]
    if params.background == BG_MEAN:
        level = (v * inside[..., None]).sum(axis=1) / some
    else:
        v = np.sort(np.where(inside[..., None], v, np.inf), axis=1)
        level = _middle(v, count) if params.background == BG_MEDIAN else _frequent(v, count, params)
    return g - np.where(count[:, None] > 0, level, 0.0)[:, None]


def _middle(v: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Median of the first ``count`` of sorted values, ``(spot, value, axis)``; counts per spot or per spot and axis."""
    count = np.broadcast_to(count[:, None] if count.ndim == 1 else count, (len(v), v.shape[2]))
    pick = lambda at: np.take_along_axis(v, np.clip(at, 0, v.shape[1] - 1)[:, None], axis=1)[:, 0]
    return (pick((count - 1) // 2) + pick(count // 2)) / 2.0


def _frequent(v: np.ndarray, count: np.ndarray, params: SpotParams) -> np.ndarray:
    """Mean or median of the largest set of sorted values near one of them (the smallest of these), 0 where it is too small."""
    level = np.zeros((len(v), v.shape[2]))
    known = np.arange(v.shape[1]) < count[:, None]
    step = max(1, CELLS // v.shape[1] ** 2)
    for d in range(v.shape[2]):
        for lo in range(0, len(v), step):
            x, ok = v[lo : lo + step, :, d], known[lo : lo + step]
            x = np.where(ok, x, 0.0)
            near = (np.abs(x[:, None, :] - x[:, :, None]) <= params.background_max_error + SLACK) & ok[:, None, :] & ok[:, :, None]
            best = np.argmax(near.sum(axis=2), axis=1)
            members = near[np.arange(len(x)), best]
            size = members.sum(axis=1)
            if params.background == BG_RANSAC_MEAN:
                value = (x * members).sum(axis=1) / np.maximum(size, 1)
            else:
                value = _middle(np.sort(np.where(members, x, np.inf), axis=1)[..., None], size)[:, 0]
            level[lo : lo + step, d] = np.where(size >= params.background_min_inlier_ratio * ok.sum(axis=1), value, 0.0)
    return level
