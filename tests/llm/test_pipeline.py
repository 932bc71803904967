import corpus_pipeline
from punctum.llm import fmindex, mixing, pii, queries, quality
from punctum.llm.common import table
from tests.llm.conftest import SF
from tests.llm.test_mixing import check


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_stages_against_brute_force(spark):
    """Each stage on what the one before kept; names, order and columns as promised."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "near_dedup", "benchmark_decontamination", "pii_masking", "source_mixing"]
    docs = table(spark, SF, "documents")
    columns, steps = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.stored(stage(spark, steps[-1], SF), "step"))
    assert all(step.columns == columns for step in steps[:-1])
    rows = [{r.doc_id: r for r in step.collect()} for step in steps[:-1]]
    good = {r.doc_id for r in queries.op4_quality_classifier(spark, SF).collect() if r.predicted}
    assert rows[1].keys() == good and all(rows[1][i] == rows[0][i] for i in good)
    sets, kept = {i: shingles(r.text) for i, r in rows[1].items()}, rows[2].keys()
    near = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
    for i in rows[1].keys() - kept:
        assert any(near(sets[i], sets[j]) for j in sets if j != i)
    assert not any(near(sets[i], sets[j]) for i in kept for j in kept if i < j)
    hit = {r.doc_id for r in fmindex.contaminated(steps[2], table(spark, SF, "benchmark")).collect() if r.spans}
    assert all(rows[3][i] == rows[2][i] for i in rows[2].keys() - hit) and rows[2].keys() - hit <= rows[3].keys()
    assert fmindex.contaminated(steps[3], table(spark, SF, "benchmark")).filter("size(spans) > 0").count() == 0
    assert rows[4].keys() == rows[3].keys() and all(rows[4][i].text == (r.text and pii.masked(r.text)) for i, r in rows[3].items())
    assert not any(pii.found(r.text or "") for r in rows[4].values())
    last = steps[5].collect()
    check([tuple(r) for r in rows[4].values()], mixing.mixed(steps[4]).collect())
    copies = {r.doc_id: r.copies for r in mixing.mixed(steps[4]).collect()}
    assert sorted((r.doc_id, r["copy"]) for r in last) == sorted((i, n + 1) for i, c in copies.items() for n in range(c))
    assert quality.ACCEPTED == 0.3


def test_stages_on_odd_rows(spark, odd, none, clashing):
    for frame in (odd, none, clashing):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, SF), "odd")
            assert docs.columns[: len(frame.columns)] == frame.columns
        assert docs.count() > 0 or frame is none


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries().keys()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")}
