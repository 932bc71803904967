import re
from collections import Counter, defaultdict

import pytest

from punctum.llm import mixing
from tests.llm.conftest import SCHEMA, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(1, 2, 3), cap=3.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        weighed = sum(weight[s] for s in order if s not in full)
        share = {s: cap * sizes[s] if s in full else rest * weight[s] / weighed for s in order} if weighed else {s: cap * sizes[s] for s in order}
        above = {s for s in order if s not in full and share[s] > cap * sizes[s]}
        if not above:
            return share
        full |= above


def check(rows, result, near=True):
    sizes, most = defaultdict(int), defaultdict(int)
    for _, text, _, source, _ in rows:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
    targets = plain_targets(sizes)
    by_id = {(i, source): len(WORD.findall(text or "")) for i, text, _, source, _ in rows}
    source_of = {i: s for i, _, _, s, _ in rows}
    taken = Counter()
    for r in result:
        source = source_of[r.doc_id]
        assert r.size == by_id[r.doc_id, source] and r.source_size == sizes[source]
        assert abs(r.target - targets[source]) <= 1e-6 * max(1, targets[source])
        assert r.taken in {c * r.size for c in range(4)}
        taken[source] += r.taken
        most[source] = max(most[source], r.size)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= most[s] / 2 + 1e-6
    return taken, targets


def test_taken_words_are_near_the_targets(spark, docs):
    rows = [tuple(r) for r in docs.collect()]
    result = mixing.mixed(docs).collect()
    assert sorted(r.doc_id for r in result) == sorted(r[0] for r in rows)
    check(rows, result)
    assert sorted(map(tuple, mixing.mixed(docs.repartition(5)).collect())) == sorted(map(tuple, result))


@pytest.mark.parametrize("fan", [4, 64])
def test_hot_and_tiny_sources(spark, fan):
    rows = [(i, prose(1 + i * 7 % 60, i), "en", "hot" if i < 200 else f"s{i % 5}" if i % 4 else None, 1) for i in range(300)]
    rows += [(1000, prose(500, 1), "en", "one", 1), (1001, "", "en", "empty", 1), (1002, None, "en", "empty", 1)]
    result = mixing.mixed(spark.createDataFrame(rows, SCHEMA), fan=fan).collect()
    taken, targets = check(rows, result)
    # small documents settle what large ones are off
    assert abs(taken["hot"] - targets["hot"]) <= 31 / 2 + 1e-6


def test_odd_rows(spark, odd, none, clashing):
    rows = [tuple(r) for r in odd.collect()]
    result = mixing.mixed(odd).collect()
    assert Counter((r.doc_id, r.size) for r in result) == Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    assert all(r.taken <= 3 * r.size for r in result)
    assert sorted(map(repr, mixing.mixed(clashing).collect())) == sorted(map(repr, result))
    assert mixing.mixed(none).count() == 0
    blank = spark.createDataFrame([(1, "", "en", "s", 1), (2, None, "en", None, 1)], SCHEMA)
    assert {(r.doc_id, r.target, r.taken) for r in mixing.mixed(blank).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_repeated_rows_share_their_copies(spark):
    rows = [(7, "a b c d", "en", "s", 1)] * 40 + [(8, "e f", "en", "t", 1)] * 3 + [(9, "g " * 50, "en", "u", 1)]
    result = mixing.mixed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(r.doc_id for r in result) == {7: 40, 8: 3, 9: 1}
    copies = Counter(r.copies for r in result if r.doc_id == 7)
    assert len(copies) <= 2 and abs(sum(r.taken for r in result if r.doc_id == 7) - next(r.target for r in result if r.doc_id == 7)) <= 4


def test_mix_repeats_rows(spark, odd, clashing):
    for frame in (odd, clashing):
        out = mixing.mix(frame)
        assert out.columns[: len(frame.columns)] == frame.columns
    want = Counter()
    for r in mixing.mixed(odd).collect():
        want[r.doc_id] += r.copies
    got = Counter(r.doc_id for r in mixing.mix(odd).collect())
    assert got == +want


def test_half_step_keeps_the_mean():
    """Of two units, either is rounded with its own probability in the mean."""
    import random

    draw, total, trials = random.Random(1), 0, 20_000
    for _ in range(trials):
        (size_a, mass_a), (size_b, mass_b) = (10, 4.0), (6, 3.0)
        up, down = min(size_a - mass_a, mass_b), min(mass_a, size_b - mass_b)
        total += mass_a + up if draw.random() * (up + down) < down else mass_a - down
    assert abs(total / trials - 4.0) < 0.1
