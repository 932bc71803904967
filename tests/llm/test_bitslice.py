import math
import random

import numpy as np
import pyarrow as pa
import pytest

from punctum.llm import bitslice

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def brute(rows, k=5, scale=256, every=50):
    sound = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in sound:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in sound if j != i)[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 1, 0.5, 1) for i, v in rows], SCHEMA)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in bitslice.top_inner_products(frame, frame.filter("vec_id % 50 = 0"), **options).collect())


@pytest.mark.parametrize("spread", [0.1, 1.0, 30.0, 2000.0, 0.002])
def test_same_as_brute_force(spark, spread):
    draw = random.Random(spread)
    rows = [(i, [draw.gauss(0, spread) for _ in range(24)]) for i in range(700)]
    assert found(spark, rows) == brute(rows)


def test_ties_copies_and_passes(spark):
    draw = random.Random(4)
    hot = [draw.gauss(0, 0.2) for _ in range(16)]
    rows = [(i, hot if i % 3 == 0 else [round(draw.gauss(0, 0.2), 1) for _ in range(16)]) for i in range(600)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, pass_bytes=500) == brute(rows)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [float("nan"), 1.0]), (200, [float("inf"), 0.0]), (250, [0.5, -1.0]), (3, [-1.0, 1.0]), (None, [1.0, 1.0]), (300, []), (4, [2.0])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(50, [1.0])]) == []


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0])]
    one = [(0, 1, 1, 65536), (0, 2, 1, 65536), (0, 3, 2, 32768)]
    assert found(spark, rows) == sorted(one * 2)


def test_coarse_bound_holds():
    rng = np.random.default_rng(6)
    for spread in (3, 40, 900, 10**6):
        vectors = rng.normal(0, spread, (300, 20)).astype(np.int64)
        block, queries = bitslice.Block(np.arange(300), vectors), rng.normal(0, spread, (9, 20)).astype(np.int64)
        slices, off = block.coarse(queries)
        bits = np.stack([np.unpackbits(s.view(np.uint8), axis=1, bitorder="little")[:, :300] for s in slices])
        coarse = (bits.astype(np.int64) << np.arange(len(slices))[:, None, None]).sum(axis=0)
        exact = queries @ vectors.T
        unit = 2.0 ** (block.shift + max(0, int(np.abs(queries).max()).bit_length() - bitslice.BITS))
        for q in range(9):
            difference = exact[q] / unit - coarse[q]
            assert difference.max() - difference.min() <= off[q]


def test_vectors_of_unequal_length_whose_values_fill_the_block():
    column = pa.array([[1], [2, 3, 4]], pa.list_(pa.int64()))
    assert bitslice.matrix(column, 2).tolist() == [[1, 0], [2, 3]]
    assert bitslice.matrix(column).tolist() == [[1, 0, 0], [2, 3, 4]]
    assert bitslice.matrix(pa.array([], pa.list_(pa.int64())), 2).shape == (0, 2)


def test_columns_named_as_results_and_empty_tables(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    extra = plain.selectExpr("*", "1 AS query", "2L AS query_id", "'a' AS rank", "3.0 AS score", "4 AS pass", "array(1) AS v")
    search = lambda frame: sorted(map(tuple, bitslice.top_inner_products(frame, frame.filter("vec_id % 50 = 0")).collect()))
    assert search(extra) == search(plain) == brute(rows)
    assert search(extra.limit(0)) == []
