"""Small numeric Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Below these a system counts as singular, a gradient as zero.
SINGULAR = 1e-9
ZERO_NORM = 1e-9
# Slack on inlier tests, so that distances that equal the limit count on every engine.
SLACK = 1e-9


def rounded(c: Column, digits: int = 6) -> Column:
    """Half-up rounding in plain double arithmetic; never yields a negative zero."""
    scale = F.lit(float(10 ** digits))
    return F.floor(c * scale + F.lit(0.5)) / scale


def total(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out + c
    return out


def solve(m: dict[tuple[int, int], Column], b: list[Column]) -> tuple[Column, list[Column]]:
    """Determinant and solution of a symmetric 2x2 or 3x3 system (Cramer)."""
    a = lambda i, j: m[(min(i, j), max(i, j))]
    if len(b) == 2:
        det = a(0, 0) * a(1, 1) - a(0, 1) * a(0, 1)
        num = [b[0] * a(1, 1) - a(0, 1) * b[1], a(0, 0) * b[1] - b[0] * a(0, 1)]
    else:
        cof = lambda i, j: _cofactor(a, i, j)
        det = a(0, 0) * cof(0, 0) + a(0, 1) * cof(0, 1) + a(0, 2) * cof(0, 2)
        num = [total([cof(i, j) * b[j] for j in range(3)]) for i in range(3)]
    return det, [F.when(F.abs(det) >= SINGULAR, n / F.when(det == 0, F.lit(1.0)).otherwise(det)) for n in num]


def _cofactor(a, i, j):
    r = [k for k in range(3) if k != i]
    c = [k for k in range(3) if k != j]
    minor = a(r[0], c[0]) * a(r[1], c[1]) - a(r[0], c[1]) * a(r[1], c[0])
    return minor if (i + j) % 2 == 0 else -minor
