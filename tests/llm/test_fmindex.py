import random

import numpy as np

from punctum.llm import fmindex
from tests.llm.conftest import SCHEMA, prose


def brute(docs, items, window=10):
    wanted = {}
    for item, text in items:
        words = fmindex.WORD.findall((text or "").encode().lower())
        for at in range(max(1, len(words) - window + 1) if words else 0):
            wanted.setdefault(tuple(words[at : at + window]), set()).add(item)
    lengths, out = {len(p) for p in wanted}, []
    for doc_id, text in docs:
        words, hit, found = fmindex.WORD.findall((text or "").encode().lower()), set(), set()
        for at in range(len(words)):
            for n in lengths:
                phrase = tuple(words[at : at + n])
                if len(phrase) == n and phrase in wanted:
                    hit |= set(range(at, at + n))
                    found |= wanted[phrase]
        out.append((doc_id, len(words), sorted(hit), sorted(i for i in found if i is not None)))
    return out


def rows_of(frame):
    return sorted(((r.doc_id, r.n_words, [p for s in r.spans for p in range(s.start, s.end)], list(r["items"])) for r in frame.collect()), key=repr)


def test_index_finds_every_occurrence():
    draw = random.Random(3)
    for trial in range(20):
        runs = [[draw.randint(1, 4) for _ in range(draw.randint(1, 30))] for _ in range(15)]
        tokens = np.array([t for r in runs for t in [*r, 0]])
        index = fmindex.FMIndex(tokens, 5, sample=draw.choice((1, 3, 16)))
        phrases = np.zeros((30, 4), np.int64)
        lengths = np.array([draw.randint(1, 4) for _ in range(30)])
        for n, k in enumerate(lengths):
            phrases[n, 4 - k :] = [draw.randint(1, 4) for _ in range(k)]
        low, high = index.search(phrases, lengths)
        for n, k in enumerate(lengths):
            places = [p for p in range(len(tokens) - k + 1) if list(tokens[p : p + k]) == list(phrases[n, 4 - k :])]
            assert sorted(index.locate(np.arange(low[n], high[n])).tolist()) == places


def test_same_as_brute_force(spark, docs, benchmark):
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    assert rows_of(fmindex.contaminated(docs, benchmark)) == sorted(expected, key=repr)


def test_odd_rows_and_items(spark, odd, none, clashing):
    plain = odd.filter("doc_id = 5").first().text
    items = [(1, " ".join(plain.split()[10:30])), (1, " ".join(plain.split()[10:30])), (2, "a"), (3, None), (4, ""), (None, " ".join(plain.split()[40:55])), (5, "É ß Ü")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(brute([(r.doc_id, r.text) for r in odd.collect()], items), key=repr)
    assert rows_of(fmindex.contaminated(odd, bench)) == expected
    assert rows_of(fmindex.contaminated(odd, bench, pass_bytes=60)) == expected
    assert rows_of(fmindex.contaminated(clashing, bench)) == expected
    assert fmindex.contaminated(none, bench).count() == 0
    assert fmindex.contaminated(odd, bench.limit(0)).filter("size(spans) > 0 or size(items) > 0").count() == 0


def test_cut_documents_hold_no_phrase(spark, benchmark):
    item = benchmark.orderBy("item_id").first().text
    words = item.split()
    texts = [item, f"Before, {item} After.", " ".join(words[:5] + words + words[5:]), prose(40, 1), None, ""]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in fmindex.decontaminated(docs, benchmark).collect()}
    assert set(got) == {1, 3, 4, 5} and got[1].text.split() == ["Before,", "After."] or got[1].text.startswith("Before")
    assert got[3].text == texts[3] and got[4].text is None and got[5].text == ""
    clean = fmindex.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert fmindex.contaminated(clean, benchmark).filter("size(spans) > 0").count() == 0


def test_passes_cut_as_one(spark):
    """Passages of one pass that only meet, or that only break, where another pass cuts."""
    items = [prose(12, 700 + n).split() for n in range(6)]
    mixed = [" ".join([*a[:6], *b, *a[6:]]) for a in items for b in items if a is not b]
    mixed += [" ".join([*a[:-3], *a[-3:], *b[3:]]) for a in items for b in items] + [" ".join([*prose(3, 9).split(), *a, "left"]) for a in items]
    shared = [[*a[-5:], *b[:7]] for a, b in zip(items, items[1:])]
    mixed += [" ".join(["start", *a, *b, "end"]) for a, b in zip(items, items[1:])]
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in enumerate(items + shared)], "item_id long, text string")
    docs = spark.createDataFrame([(n, t, "en", "s", 1) for n, t in enumerate([*mixed, None, ""])], SCHEMA)
    of = lambda frame: sorted((r.doc_id, r.text) for r in frame.collect())
    apart = fmindex.decontaminated(docs, bench, pass_bytes=200)
    assert len(fmindex._passes(bench, 200)) > 1
    assert apart.columns == docs.columns
    assert of(apart) == of(fmindex.decontaminated(docs, bench))
