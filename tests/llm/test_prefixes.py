import hashlib
import math
import random
import zlib

import pytest

from punctum.llm import prefixes, queries
from punctum.llm.common import table
from tests.llm.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string"


def order(turn, role, text):
    digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
    return turn is not None, turn or 0, digest, role, text


def brute(rows):
    convs, nodes = {}, {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(order(turn, role or "", text or ""))
    for turns in convs.values():
        turns.sort()
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        turns = [t[3:] for t in convs.get(c - int(math.fmod(c, 5)), [])[:h] + convs[c][h:]]
        for d in range(len(turns) + 1):
            node = nodes.setdefault(tuple(turns[:d]), {"in": [], "ends": [], "below": set()})
            node["in"].append(c)
            if d == len(turns):
                node["ends"].append(c)
            if d:
                nodes[tuple(turns[: d - 1])]["below"].add(tuple(turns[:d]))
    out = []
    for path in sorted(nodes, key=len, reverse=True):
        node = nodes[path]
        node["leaves"] = sum(nodes[b]["leaves"] for b in node["below"]) or 1
        node["saved"] = sum(nodes[b]["saved"] for b in node["below"]) + (len(path) > 0) * (len(node["in"]) - 1) * len(path[-1][1].encode() if path else b"")
        ends = hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()
        parent = min(nodes[path[:-1]]["in"]) if path else None
        out.append((min(node["in"]), len(path), parent, len(node["in"]), len(node["below"]), node["leaves"], node["saved"], ends))
    return sorted(out, key=repr)


def found(frame, **options):
    return sorted(map(tuple, prefixes.trie(frame, **options).collect()), key=repr)


def conversations(seed, convs=120, hot=40):
    """Many shared beginnings, copies in number, missing bases, negative ids, turns missing and shuffled."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-60, 400), convs):
        length = draw.choice([1, 2, 3, 5, 12, 30])
        rows += [(c, t, draw.choice(["user", "system"]), draw.choice(["a", "b", "é", ""])) for t in range(length)]
    rows += [(1000 + c, t, "user", f"copied {t}") for c in range(hot) for t in range(11)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, members", [(1, 1024), (2, 2), (3, 8)])
def test_equals_brute_force(spark, many_ranges, seed, members):
    rows = conversations(seed)
    assert found(spark.createDataFrame(rows, SCHEMA), members=members) == brute(rows)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op13_conversation_prefix_trie(spark, SF).collect()), key=repr) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "x"), (1, None, "user", "x"), (1, None, None, "y"), (1, 2, None, None), (1, 2, None, None), (2, 2, "", ""), (3, 1, "user", "t" * 200_000),
        (5, 1, "user", "x"), (6, 1, "user", "x"), (6, 1, "user", "x"), (-7, 1, "user", "x"), (-5, 1, "user", "z"), (0, 0, "user", "x"), (9, 5, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(frame) == brute(rows)
    extra = frame.selectExpr("*", "1 as depth", "'k' as key", "2 as part", "3 as at", "4 as n", "5 as salt")
    assert found(extra) == brute(rows)
    assert found(frame.limit(0)) == []
    assert found(frame.filter("conv_id IS NULL")) == []


def test_long_conversation_and_many_ends_at_one_node(spark, many_ranges, monkeypatch):
    monkeypatch.setattr(prefixes, "PIECE", 7)
    rows = [(5, t, "user", str(t % 3)) for t in range(600)] + [(10 * c, 0, "user", "same") for c in range(60)]
    assert found(spark.createDataFrame(rows, SCHEMA), members=4) == brute(rows)


def test_sweep_with_a_small_queue():
    nodes = [(bytes([d, k]), bytes([max(0, d - 1), k // 2]), k, d, 2, 2, 3, bytes([0, 0]), 0, 0, 0, 0) for d in range(5, -1, -1) for k in range(2**d)]
    assert list(map(prefixes.Sweep(1).node, nodes)) == list(map(prefixes.Sweep().node, nodes))
