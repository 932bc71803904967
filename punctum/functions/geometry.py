"""Block geometry and mirrored borders as SQL text (for ``expr``), option parsing as Columns.

Blocks of an inclusive interval ``[lo, hi]`` overlap by two pixels: block ``i`` covers
``[lo + i*(size-2), min(lo + i*(size-2) + size-1, hi)]``. The outermost pixel of a block
is read but never evaluated, so every pixel of ``lo+1..hi-1`` has exactly one owner.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from punctum.params import DEFAULT_BLOCK


def block_count(lo: str, hi: str, size: int) -> str:
    if size < 3:
        raise ValueError("a block needs at least 3 pixels in every dimension")
    return f"greatest(0L, ceil(({hi} - 1 - ({lo})) / {size - 2}))"


def block_start(index: str, lo: str, size: int) -> str:
    return f"(({lo}) + ({index}) * {size - 2}L)"


def block_end(index: str, lo: str, hi: str, size: int) -> str:
    return f"least({block_start(index, lo, size)} + {size - 1}, {hi})"


def block_owner(p: str, lo: str, hi: str, size: int) -> str:
    """Index of the block that evaluates ``p``; null on the outermost pixels."""
    return f"(CASE WHEN {p} BETWEEN ({lo}) + 1 AND ({hi}) - 1 THEN floor(({p} - ({lo}) - 1) / {size - 2}) END)"


def blocks_reading(first: str, last: str, lo: str, hi: str, size: int, halo: int) -> str:
    """Array of the block indices that read any pixel of ``first..last``."""
    low = f"greatest(0L, ceil(({first} - {halo + size - 1} - ({lo})) / {size - 2}))"
    high = f"least({block_count(lo, hi, size)} - 1, floor(({last} + {halo} - ({lo})) / {size - 2}))"
    # Plain arithmetic, so it stays in generated code where an optimizer moves or repeats it.
    return f"CASE WHEN {within_reach(first, last, lo, hi, halo)} AND {low} <= {high} THEN sequence({low}, {high}) END"


def within_reach(first: str, last: str, lo: str, hi: str, halo: int) -> str:
    return f"({first} <= ({hi}) + {halo} AND {last} >= ({lo}) - {halo})"


def linear_id(indices: list[str], counts: list[str]) -> str:
    """Dimension 0 runs fastest."""
    return reduce(lambda acc, d: f"({indices[d]} + {counts[d]} * {acc})", range(len(indices) - 2, -1, -1), indices[-1])


def mirror(i: str, n: str) -> str:
    """Pixel that stands in for position ``i`` when the border mirrors without repeating the edge."""
    return f"(CASE WHEN {n} > 1 THEN {n} - 1 - abs(pmod({i}, greatest(2 * ({n} - 1), 1L)) - ({n} - 1)) ELSE 0L END)"


def mirror_images(p: str, n: str, reach: int) -> str:
    """Array of all positions in ``-reach..n-1+reach`` that mirror back to pixel ``p``; may hold nulls.

    Only a reach of a whole image or more needs the general form; the others stay in generated code.
    """
    period = f"(2 * ({n} - 1))"
    turns = f"(ceil({reach} / greatest({period}, 1L)) + 1)"
    copies = f"flatten(transform(sequence(-{turns}, {turns}), t -> array({p} + {period} * t, {period} * t - {p})))"
    left = f"CASE WHEN {p} BETWEEN 1 AND {reach} THEN -{p} END"
    right = f"CASE WHEN {p} BETWEEN {n} - 1 - {reach} AND {n} - 2 THEN {period} - {p} END"
    return (
        f"CASE WHEN {p} > {reach} AND {p} < {n} - 1 - {reach} THEN array({p}) "
        f"WHEN {reach} < {n} THEN array({p}, {left}, {right}) "
        f"WHEN {n} = 1 THEN sequence({-reach}L, {reach}L) "
        f"ELSE array_distinct(filter({copies}, q -> q BETWEEN {-reach} AND {n} - 1 + {reach})) END"
    )


def parse_int_list(text: Column, ndim: Column | int) -> Column:
    """``"128,128,64"`` to an array of BIGINT; a wrong arity or a bad number raises."""
    parts = F.split(text, ",", -1)
    numbers = F.transform(parts, lambda t: t.try_cast("bigint"))
    ndim = ndim if isinstance(ndim, Column) else F.lit(ndim)
    bad = F.raise_error(F.concat(F.lit("not a list of "), ndim.cast("string"), F.lit(" integers: "), text))
    ok = (F.size(numbers) == ndim) & ~F.exists(numbers, lambda v: v.isNull())
    return F.when(text.isNull() | ok, numbers).otherwise(bad.cast("array<bigint>"))


def block_size_or_default(given: Column, ndim: Column) -> Column:
    default = {d: F.array(*[F.lit(s).cast("bigint") for s in size]) for d, size in DEFAULT_BLOCK.items()}
    return F.coalesce(given, F.when(ndim == 2, default[2]).otherwise(default[3]))


def intensity_mode(low: Column, high: Column) -> Column:
    return F.when(low == high, F.lit("auto")).otherwise(F.lit("fixed"))
