"""Detection settings. The defaults from ``anisotropy`` to ``n_stdev2`` are fixed values that users expect."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

AXES = {2: ("x", "y"), 3: ("x", "y", "z")}

# Default block sizes per dimensionality.
DEFAULT_BLOCK = {2: (512, 512), 3: (128, 128, 64)}

# Fixed value: ratio between the two blurs of a difference of Gaussians.
SIGMA_RATIO = 2.0 ** 0.25

NO_RANSAC, RANSAC, MULTICONSENSUS = 0, 1, 2
BG_NONE, BG_MEAN, BG_MEDIAN, BG_RANSAC_MEAN, BG_RANSAC_MEDIAN = range(5)


@dataclass(frozen=True)
class SpotParams:
    """One detection run.

    ``min_intensity == max_intensity`` means the range is taken from the data, per
    block (``range_scope="block"``) or per image (``range_scope="image"``).
    ``crop_min`` / ``crop_max`` are inclusive and default to the whole image.
    ``hypotheses`` is the number of two-gradient samples of a robust fit: more change a centre, but drop no spot.
    ``max_shift`` drops centres farther than that from their candidate on any axis; by default none is dropped.
    """

    min_intensity: float = 0.0
    max_intensity: float = 0.0
    range_scope: str = "block"
    anisotropy: float = 1.0
    ransac: int = RANSAC
    sigma: float = 1.5
    threshold: float = 0.007
    support_radius: int = 3
    inlier_ratio: float = 0.1
    max_error: float = 1.5
    intensity_threshold: float = 0.0
    background: int = BG_NONE
    background_max_error: float = 0.05
    background_min_inlier_ratio: float = 0.75
    min_inliers: int = 20
    n_stdev1: float = 8.0
    n_stdev2: float = 6.0
    hypotheses: int = 100
    max_shift: float | None = None
    block_size: tuple[int, ...] | None = None
    crop_min: tuple[int, ...] | None = None
    crop_max: tuple[int, ...] | None = None

    def __post_init__(self):
        if self.ransac not in (NO_RANSAC, RANSAC, MULTICONSENSUS):
            raise ValueError(f"ransac must be 0, 1 or 2, not {self.ransac}")
        if self.background not in range(5):
            raise ValueError(f"background must be 0 to 4, not {self.background}")
        if self.range_scope not in ("block", "image"):
            raise ValueError(f"range_scope must be 'block' or 'image', not {self.range_scope!r}")
        if self.max_intensity < self.min_intensity:
            raise ValueError("max_intensity is below min_intensity")
        if self.sigma <= 0 or self.anisotropy <= 0:
            raise ValueError("sigma and anisotropy must be positive")
        if self.support_radius < 1 or self.hypotheses < 1 or self.min_inliers < 1:
            raise ValueError("support_radius, hypotheses and min_inliers must be at least 1")
        if self.max_error < 0 or self.background_max_error < 0:
            raise ValueError("errors must not be negative")
        if not (0 <= self.inlier_ratio <= 1 and 0 <= self.background_min_inlier_ratio <= 1):
            raise ValueError("inlier ratios lie between 0 and 1")
        if self.max_shift is not None and self.max_shift < 0:
            raise ValueError("max_shift must not be negative")
        if self.block_size is not None and min(self.block_size) < 3:
            raise ValueError("a block needs at least 3 pixels in every dimension")

    @property
    def auto_range(self) -> bool:
        return self.min_intensity == self.max_intensity

    def sigmas(self, ndim: int, wide: bool = False) -> tuple[float, ...]:
        """Blur width per axis; z is scaled by the anisotropy."""
        s = self.sigma * (SIGMA_RATIO if wide else 1.0)
        return tuple(s * (self.anisotropy if d == 2 else 1.0) for d in range(ndim))

    def block(self, ndim: int) -> tuple[int, ...]:
        block = self.block_size or DEFAULT_BLOCK[ndim]
        if len(block) != ndim:
            raise ValueError(f"block size {block} does not have {ndim} dimensions")
        return tuple(block)

    def crop(self, ndim: int):
        for c in (self.crop_min, self.crop_max):
            if c is not None and len(c) != ndim:
                raise ValueError(f"crop bound {c} does not have {ndim} dimensions")
        return self.crop_min, self.crop_max

    def halo(self, ndim: int) -> tuple[int, ...]:
        """Pixels needed beyond a block's bounds: its outermost pixels get a blur, its inner ones a support region."""
        return tuple(max(radius(s), self.support_radius) for s in self.sigmas(ndim, wide=True))

    def with_(self, **changes) -> "SpotParams":
        return replace(self, **changes)


def radius(sigma: float) -> int:
    return math.ceil(3 * sigma)


def gauss_weights(sigma: float) -> list[float]:
    """Normalized weights for offsets -radius..radius."""
    r = radius(sigma)
    raw = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-r, r + 1)]
    total = sum(raw)
    return [w / total for w in raw]
