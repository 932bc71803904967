import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from punctum.llm import merkle, queries
from punctum.llm.common import table
from tests.llm.conftest import SF


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def climbed(digests, fan):
    """The root, and per leaf its place and the digests of the others at each level."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for k, p in enumerate(at):
            run = digests[p // fan * fan :][:fan]
            paths[k].append((p % fan, run[: p % fan] + run[p % fan + 1 :]))
        at = [p // fan for p in at]
        digests = [sha("".join(digests[k : k + fan])) for k in range(0, len(digests), fan)]
    return digests[0], paths


def brute(rows, fan=16):
    coded = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    by = {}
    for r in rows:
        hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        leaf = sha("".join(map(coded, r)))
        tampered = sha("".join(map(coded, (*r[:4], r[4].translate(lower))))) if hit else leaf
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf, tampered, r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climbed([row[2] for row in sorted(by[s])], fan) for s in names]
    root, above = climbed([t[0] for t in trees], fan) if trees else (None, [])
    out = []
    for s, (subroot, paths), upper in zip(names, trees, above):
        for row, path in zip(sorted(by[s]), paths):
            digest = row[3]
            for place, others in path + upper:
                digest = sha("".join([*others[:place], digest, *others[place:]]))
            out.append((row[4], row[2], subroot, root, sha("".join(o for _, others in path + upper for o in others)), digest, digest == root))
    return out


def proofs(spark, frame, **options):
    digest = lambda text: merkle.leaf_digest(*map(F.col, merkle.FIELDS[:-1]), text)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = frame.select("doc_id", "source", digest(F.col("text")).alias("leaf"), F.when(hit, digest(merkle.lowered(F.col("text")))).otherwise(digest(F.col("text"))).alias("t"))
    rows = merkle.manifest(leaves, keep=("t",), **options).withColumn("f", merkle.folded(F.col("t"), F.col("places"), F.col("others")))
    proof = F.sha2(F.array_join("others", "").cast("binary"), 256)
    return sorted(map(tuple, rows.select("doc_id", "leaf", "subroot", "root", proof, "f", F.col("f") == F.col("root")).collect()), key=repr)


def fields(frame):
    return [tuple(r) for r in frame.select(*merkle.FIELDS).collect()]


def test_query_equals_brute_force(spark, docs):
    got = queries.op11_merkle_manifest(spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(fields(docs)), key=repr)
    assert 0 < sum(not r.verified for r in got) < len(got)


@pytest.mark.parametrize("fan, levels", [(2, 1), (3, 2), (16, 1)])
def test_many_rounds_and_a_hot_source(spark, many_ranges, fan, levels):
    rows = [(n * 37 % 1009, "hot" if n % 3 else f"s{n % 50}", "en", n, f"Text {n}") for n in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert proofs(spark, frame, fan=fan, levels=levels) == sorted(brute(rows, fan), key=repr)


def test_odd_rows(spark, odd, none, clashing):
    assert proofs(spark, odd) == sorted(brute(fields(odd)), key=repr)
    assert proofs(spark, clashing) == proofs(spark, odd)
    assert proofs(spark, none) == []
    one = odd.filter("doc_id = 5")
    (row,) = proofs(spark, one)
    assert row[1] == row[2] == row[3] and row[4] == sha("")


def test_small_queues_give_the_same_sweeps():
    digests = [sha(str(n)) for n in range(300)]
    for held in (1, 7, 1000):
        top, families = merkle.upward(iter(digests), 3, held=held)
        root, paths = climbed(digests, 16)
        assert top == root
        found = dict(merkle.downward(families, ((), ()), held=held))
        for k, path in enumerate(paths):
            assert found[k] == (tuple(p for p, _ in path), tuple("".join(o) for _, o in path))
