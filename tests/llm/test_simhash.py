import random

import numpy as np
import pytest
import xxhash

from punctum.llm import simhash
from punctum.llm.components import components
from tests.llm.conftest import SCHEMA, prose


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))] if words else []
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def classes_of(values, max_bits):
    """Smallest index reachable over pairs within the threshold."""
    values, parent = np.array(values, np.int64).view(np.uint64), list(range(len(values)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= max_bits):
            a, b = sorted((top(i), top(i + 1 + int(j))))
            parent[b] = a
    return [top(i) for i in range(len(values))]


def test_fingerprints_and_classes(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert all(got[i].fingerprint == plain_fingerprint(t) for i, t in rows)
    tops = classes_of([got[i].fingerprint for i, _ in rows], 2)
    assert [got[i].component_id for i, _ in rows] == [rows[t][0] for t in tops]


@pytest.mark.parametrize("max_bits, bucket", [(2, 64), (2, 1), (2, 8), (4, 64), (4, 4), (0, 64)])
def test_links_join_what_is_near(spark, max_bits, bucket):
    draw, values = random.Random(max_bits * 100 + bucket), set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(25):
            v = centre
            for _ in range(draw.randint(0, 5)):
                v ^= 1 << draw.randrange(64)
            values.add(v - (1 << 64) if v >> 63 else v)
    values = sorted(values)
    nodes = spark.createDataFrame([(0, v) for v in values], "which int, fingerprint long")
    links = simhash.links(nodes, max_bits, bucket).collect()
    assert all(bin((a ^ b) % (1 << 64)).count("1") <= max_bits for _, a, b in links)
    place = {v: i for i, v in enumerate(values)}
    parent = list(range(len(values)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for _, a, b in links:
        x, y = sorted((top(place[a]), top(place[b])))
        parent[y] = x
    assert [top(i) for i in range(len(values))] == classes_of(values, max_bits)


def test_ring_has_a_viable_chain_for_every_near_pair():
    draw = random.Random(5)
    for max_bits in (2, 4, 6):
        ring = simhash.Ring(max_bits)
        for _ in range(500):
            difference = sum({1 << draw.randrange(64) for _ in range(max_bits)})
            count = lambda start, n: bin(difference & ring.mask(start, n) % (1 << 64)).count("1")
            assert any(all(count(i, n) <= ring.budget(n) for n in range(1, ring.segments + 1)) for i in range(ring.segments))


def test_odd_rows(spark, odd, none, clashing):
    got = {(r.doc_id, r.text_key): r for r in simhash.near_duplicates(odd).collect()}
    assert simhash.near_duplicates(odd).count() == odd.count()
    by_id = {r.doc_id: r for r in got.values()}
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint == 0
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert {by_id[i].component_id for i in (5, 6, 7)} == {5}
    assert {r.component_id for r in got.values() if r.doc_id is None} == {1, 5}
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.near_duplicates(clashing).count() == clashing.count()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 100), (200, 201), (201, 200)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


def test_one_of_each_group_of_near_copies_stays(spark):
    rows, groups = [], []
    for g in range(6):
        words = prose(150, 500 + g).split()
        copies = [words] + [[*words[:k], "changed", *words[k + 1 :]] for k in (20, 90)]
        groups.append([len(rows) + n for n in range(4)])
        rows += [" ".join(c) for c in [*copies, words]]
    clean = [prose(150, 900 + n) for n in range(6)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(rows + clean)], SCHEMA)
    kept = {r.doc_id for r in simhash.deduplicated(docs).collect()}
    assert kept == {g[0] for g in groups} | {len(rows) + n for n in range(6)}


def test_deduplicated_odd_rows(spark, odd, none, clashing):
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == [1, 4, 5, 8, 9, 10, 11, *range(100, 112)]
    assert simhash.deduplicated(none).count() == 0
    assert simhash.deduplicated(clashing).columns == clashing.columns
    assert simhash.deduplicated(clashing).count() == len(ids)


def jaccard_groups(texts, similarity=0.8, k=5):
    """Smallest index reachable over pairs of the similarity, all pairs compared."""
    sets = []
    for text in texts:
        words = text.lower().split()
        n = min(k, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] == sets[j] or common * (1 + similarity) >= similarity * (len(sets[i]) + len(sets[j])) - 1e-9:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return [top(i) for i in range(len(texts))]


def kept_of(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    return sorted(r.doc_id for r in simhash.deduplicated(docs).collect())


def test_short_edited_and_lengthened_copies_are_found(spark):
    texts = []
    for g in range(40):
        words = prose(30 + 10 * (g % 5), 3000 + g).split()
        texts += [" ".join(words), " ".join([*words[:-1], "changed"]), " ".join([*words, *prose(len(words) // 8, 4000 + g).split()])]
    tops = jaccard_groups(texts)
    assert len(set(tops)) == 40
    assert kept_of(spark, texts) == sorted(set(tops))


def test_texts_meet_though_the_first_under_their_words_resembles_neither(spark, monkeypatch):
    forward = [f"q{n}" for n in range(100)]
    texts = [" ".join(reversed(forward)), " ".join(forward), " ".join([*forward, "q0"])]
    line = prose(14, 77).split()
    for g in range(12):
        words = prose(36, 5000 + g).split()
        texts += [" ".join([*line, *words]), " ".join([*line, *words[:-1], "other"]), " ".join([*line, *words[:-4], *prose(4, 6000 + g).split()])]
    tops = jaccard_groups(texts)
    assert tops[1] == tops[2] != tops[0]
    assert kept_of(spark, texts) == sorted(set(tops))


def test_pairs_across_groups_under_one_shingle(spark):
    """A chain of windows over one text: neighbours are near, the smallest node is near few."""
    words = prose(400, 88).split()
    texts = [" ".join(words[n : n + 100]) for n in range(0, 300, 7)]
    tops = jaccard_groups(texts)
    assert kept_of(spark, texts) == sorted(set(tops))


def test_repeats_do_not_tell_texts_of_equal_shingles_apart(spark):
    words, line = prose(300, 91), prose(10, 92)
    texts = [" ".join([words, *[line] * n]) for n in (2, 20, 100)] + [" ".join([prose(300, 93), *[line] * n]) for n in (1, 10)]
    assert jaccard_groups(texts) == [0, 0, 0, 3, 3]
    assert kept_of(spark, texts) == [0, 3]


def test_parity_rules_out_only_what_differs_more():
    draw = np.random.default_rng(4)
    for size in (1, 5, 40, 300, 3000):
        a = draw.integers(-(2**63), 2**63 - 1, size)
        b = np.concatenate((a[size // 10 :], draw.integers(-(2**63), 2**63 - 1, size // 8)))
        bits = int(np.bitwise_count((simhash.parity(np.unique(a)) ^ simhash.parity(np.unique(b))).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b))


def test_wide_parities_keep_what_is_near(spark):
    draw, rows = np.random.default_rng(6), []
    for size in (3, 500, 512, 513, 1000, 1030, 4000, 4090):
        for more in (0, size // 9, size // 5, size // 3, size):
            a = np.unique(draw.integers(-(2**63), 2**63 - 1, size))
            b = np.unique(np.concatenate((a, draw.integers(-(2**63), 2**63 - 1, more))))
            rows.append((len(a) / len(b), {"size": len(a), "wide": simhash.wide(a).tolist()}, {"size": len(b), "wide": simhash.wide(b).tolist()}))
    side = "struct<size:int,wide:array<long>>"
    frame = spark.createDataFrame(rows, f"similarity double, a {side}, b {side}")
    got = frame.selectExpr("similarity", f"{simhash._possible_wide(0.8, 'a', 'b')} AS possible").collect()
    assert all(r.possible for r in got if r.similarity >= 0.8)
    assert sum(r.possible for r in got if r.similarity < 0.6) == 0


def test_texts_of_the_similarity_share_a_leading_shingle():
    draw = np.random.default_rng(9)
    for size in (1, 2, 5, 9, 40, 300):
        for trial in range(60):
            a = np.unique(draw.integers(-(2**63), 2**63 - 1, size))
            gone, more = draw.integers(0, size // 6 + 1), draw.integers(0, size // 6 + 1)
            b = np.unique(np.concatenate((draw.permutation(a)[gone:], draw.integers(-(2**63), 2**63 - 1, more))))
            bits = draw.integers(0, 2**63, 4).astype(np.uint64) | draw.integers(0, 2**63, 4).astype(np.uint64)
            common = len(np.intersect1d(a, b))
            for similarity in (0.5, 0.8, 0.95, 1.0):
                if len(a) and len(b) and common * (1 + similarity) >= similarity * (len(a) + len(b)):
                    small, large = sorted((a, b), key=len)
                    keys, leading = simhash.prefixes(small, similarity, bits)
                    assert np.intersect1d(keys[:leading], simhash.prefixes(large, similarity, bits)[0]).size


def test_filter_holds_every_frequent_shingle(spark):
    texts = [f"{prose(8, 50)} {prose(6, n)}" for n in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    common = simhash.hashed_shingles(prose(8, 50).encode(), 5)
    own = np.concatenate([np.setdiff1d(simhash.hashed_shingles(t.encode(), 5), common) for t in texts])
    bits = simhash.frequent(docs, 5, part=1)
    assert simhash.listed(common, bits).all() and simhash.listed(own, bits).mean() < 0.1
    assert not simhash.frequent(docs, 5, part=1, least=61).any()
    assert not simhash.frequent(docs, 5, part=1, most=3).any()


@pytest.mark.parametrize("most", [1 << 24, 0])
def test_texts_of_one_template(spark, monkeypatch, most):
    """Below the similarity of each other, but for one copy: they do not meet if the template is known as frequent; if not, the result is the same."""
    find, counts, keep = simhash.frequent, {}, simhash.stored
    monkeypatch.setattr(simhash, "frequent", lambda docs, words: find(docs, words, part=1, most=most))

    def counting(frame, label):
        table = keep(frame, label)
        counts[label] = max(counts.get(label, 0), table.count())
        return table

    monkeypatch.setattr(simhash, "stored", counting)
    template = prose(100, 31)
    texts = [f"{template} {prose(17, 7000 + n)}" for n in range(150)] + [f"{template} {prose(17, 7000)} again"]
    tops = jaccard_groups(texts)
    assert len(set(tops)) == 150
    assert kept_of(spark, texts) == sorted(set(tops))
    assert most == 0 or counts["met"] < 40 and counts["across"] == 0 and counts["close"] == 1


def test_sizes_at_the_edge_of_a_class_meet(spark):
    texts, words = [], prose(130, 41).split()
    for n in (84, 104, 125):
        texts += [" ".join(words[:n])]
    for g in range(5):
        words = prose(400, 8000 + g).split()
        texts += [" ".join(words[: n + 4]) for n in (80, 100, 125, 156, 195, 244)]
    tops = jaccard_groups(texts)
    assert kept_of(spark, texts) == sorted(set(tops))


@pytest.mark.parametrize("lengthened", [False, True])
def test_many_near_copies_of_one_text_are_not_compared_pair_by_pair(spark, monkeypatch, lengthened):
    """Some are near each other, some only share most shingles with the others; the groups are those of all pairs."""
    draw, keep, counts, words = random.Random(3), simhash.stored, {}, prose(150, 61).split()

    def counting(frame, label):
        table = keep(frame, label)
        counts[label] = max(counts.get(label, 0), table.count())
        return table

    monkeypatch.setattr(simhash, "stored", counting)
    texts = []
    for n in range(500):
        copy = list(words)
        for m in range(draw.randint(0, 9)):
            at = draw.randrange(len(copy))
            copy[at : at + draw.randint(0, 2) if lengthened else at + 1] = [f"new{n}x{m}"]
        texts.append(" ".join(copy))
    tops = jaccard_groups(texts)
    assert kept_of(spark, texts) == sorted(set(tops))
    assert counts["open"] > 1000 and (lengthened or counts["across"] < 250)


def test_first_common_shingle_of_near_sets_is_where_both_sizes_allow():
    draw, part = np.random.default_rng(12), 0.8 / 1.8
    for size in (1, 5, 9, 40, 300):
        for trial in range(80):
            a = np.unique(draw.integers(-(2**63), 2**63 - 1, size))
            b = np.unique(np.concatenate((draw.permutation(a)[draw.integers(0, size // 6 + 1) :], draw.integers(-(2**63), 2**63 - 1, draw.integers(0, size // 6 + 1)))))
            bits = draw.integers(0, 2**63, 4).astype(np.uint64) | draw.integers(0, 2**63, 4).astype(np.uint64)
            if len(b) and len(np.intersect1d(a, b)) >= part * (len(a) + len(b)) - 1e-9:
                (keys_a, _), (keys_b, _) = simhash.prefixes(a, 0.8, bits), simhash.prefixes(b, 0.8, bits)
                at_a = int(np.flatnonzero(np.isin(keys_a, keys_b))[0])
                at_b = int(np.flatnonzero(keys_b == keys_a[at_a])[0])
                assert len(b) <= (len(a) - at_a) / part - len(a) + 1e-6 and len(a) <= (len(b) - at_b) / part - len(b) + 1e-6


def test_near_copies_are_linked_by_their_fingerprints(spark, monkeypatch):
    """Pairs within 2 bits are compared also where no shingle of a prefix is shared; the groups are those of all pairs."""
    texts = []
    for g in range(30):
        words = prose(400, 9000 + g).split()
        texts += [" ".join(words), " ".join([*words[:-1], "changed"]), " ".join([*words, words[0]]), " ".join([*words[:200], *words[:200], *words[200:]])]
    prints = [simhash.set_fingerprint(simhash.hashed_shingles(t.encode(), 5)) for t in texts]
    assert prints[0] == plain_fingerprint(texts[0], 5) and simhash.set_fingerprint(np.empty(0, np.int64)) == 0
    near = [bin((a ^ b) % (1 << 64)).count("1") <= 2 for a, b in zip(prints[::4], prints[1::4])]
    found, keep = {}, simhash.stored

    def watched(frame, label):
        found[label] = table = keep(frame, label)
        if label == "linked":
            found["pairs"] = {frozenset((r.a, r.b)) for r in table.collect()}
        return table

    monkeypatch.setattr(simhash, "stored", watched)
    tops = jaccard_groups(texts)
    assert kept_of(spark, texts) == sorted(set(tops)) == list(range(0, 120, 4))
    assert len(found["pairs"]) >= sum(near) > 5
    # The links alone: what they join stays joined if the prefixes find nothing.
    first = simhash.prefixes
    monkeypatch.setattr(simhash, "prefixes", lambda shingles, similarity, bits: (shingles[:0], first(shingles, similarity, bits)[1]))
    kept = kept_of(spark, texts)
    assert set(range(0, 120, 4)) <= set(kept) and len(kept) <= 120 - sum(near)
