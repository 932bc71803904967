import random

import pytest

from punctum.llm.spilling import SpillingQueue, placed


@pytest.mark.parametrize("held, runs", [(1, 1), (3, 2), (20, 4), (10_000, 32)])
def test_queue_gives_labels_in_order_and_equal_ones_as_they_came(held, runs):
    draw, queue, waiting, out = random.Random(held), SpillingQueue(held, runs), [], []
    for n in range(600):
        if waiting and draw.random() < 0.4:
            least = min(waiting)
            waiting.remove(least)
            assert queue.first() == least[0]
            out.append((queue.pop(), least))
        else:
            label = (draw.randrange(20), b"k" * draw.randrange(3))
            queue.push(label, (n, "text"))
            waiting.append((label, n))
    out += [(queue.pop(), entry) for entry in sorted(waiting)]
    assert not queue and queue.first() is None
    assert all(label == entry[0] and value[0] == entry[1] for (label, value), entry in out)
    assert (queue.spilled > 0) == (held < 100)
    assert len(queue.runs) == 0


def test_queue_takes_all_values_of_the_smallest_label():
    queue = SpillingQueue(2)
    for n in range(9):
        queue.push(n % 3, n)
    assert queue.take(1) == [] and queue.take(0) == [0, 3, 6] and queue.take(1) == [1, 4, 7]


def test_places_and_sums_of_a_hot_group(spark, many_ranges):
    draw = random.Random(3)
    rows = [("a" if n % 3 else f"g{n % 40}", n * 7919 % 1_000, draw.randrange(50)) for n in range(1_000)]
    ranged, starts = placed(spark.createDataFrame(rows, "g string, o long, v long"), ["g"], ["o"], "t", sums=("v",))
    assert ranged.select("part").distinct().count() > 1
    joined = ranged.join(starts, ["part", "g"]).selectExpr("g", "o", "at - first + start as pos", "n", "v_start", "first", "at", "part").collect()
    least = {}
    for r in joined:
        least[r.g, r.part] = min(r.o, least.get((r.g, r.part), r.o))
    groups = {g: sorted(o for x, o, _ in rows if x == g) for g in {g for g, _, _ in rows}}
    ahead = {(g, part): sum(v for x, o, v in rows if x == g and o < low) for (g, part), low in least.items()}
    for r in joined:
        assert groups[r.g][r.pos] == r.o and r.n == len(groups[r.g]) and r.v_start == ahead[r.g, r.part]
    assert placed(spark.createDataFrame([], "g string, o long"), ["g"], ["o"], "t")[1].count() == 0
