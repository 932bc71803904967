from hashlib import sha256

import pytest

from punctum.llm import substrings
from tests.llm.conftest import SCHEMA, prose


def brute(rows, window=20):
    """Removal by what starts earlier in a smaller id, or earlier in the same text."""
    least = {}
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    for i, words in texts:
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            least[key] = min(least.get(key, order(i)), order(i))
    out = []
    for i, words in texts:
        gone, seen = set(), set()
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if least[key] < order(i) or key in seen:
                gone |= set(range(at, at + window))
            seen.add(key)
        out.append((i, len(words), len(gone), sha256(b" ".join(w for n, w in enumerate(words) if n not in gone)).hexdigest()))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("period", sorted(substrings.COVERS))
def test_covers_join_every_two_residues(period):
    cover = substrings.COVERS[period]
    assert all(any((a + d) % period in cover and (b + d) % period in cover for d in range(period)) for a in range(period) for b in range(period))


def test_same_as_brute_force(spark, docs):
    assert rows_of(substrings.repeated_passages(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("window, period", [(20, 13), (20, 7), (9, 7)])
def test_shifted_and_repeated_passages(spark, window, period):
    passage, again = prose(70, 1).split(), prose(25, 2).split()
    texts = [prose(k, 30 + k).split() + passage[k : k + 30 + k] + prose(9, 60 + k).split() for k in range(14)]
    texts += [again + prose(5, 3).split() + again, again * 4, ["the"] * 90, passage, passage, passage[:window], passage[: window - 1], []]
    rows = [(len(texts) - n, " ".join(t)) for n, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    assert rows_of(substrings.repeated_passages(docs, window, period)) == brute(rows, window)


def test_odd_rows(spark, odd, none, clashing):
    expected = brute([(r.doc_id, r.text) for r in odd.collect()])
    assert rows_of(substrings.repeated_passages(odd)) == expected
    assert rows_of(substrings.repeated_passages(clashing)) == expected
    assert substrings.repeated_passages(none).count() == 0
    spans = {r.doc_id: (r.n_removed, sum(s.end - s.start for s in r.spans)) for r in substrings.repeated_passages(odd).collect()}
    assert all(a == b for a, b in spans.values())


def test_repeated_rows_of_the_first_document(spark):
    text, rows = prose(30, 7), []
    rows = [(1, f"{text} {text}"), (1, f"{text} {text}"), (2, text), (2, text), (3, prose(25, 8))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    assert rows_of(substrings.repeated_passages(docs)) == brute(rows)
