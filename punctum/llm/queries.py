"""The registered queries of this folder over whole tables, and SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from punctum.llm import bilinear, bitslice, content, fmindex, langid, merkle, mixing, pii, prefixes, quality, simhash, substrings, wordpiece
from punctum.llm.common import table


def op1_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, sf, "documents"), words=3, max_bits=2)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return classes.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = fmindex.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10)
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op3_pii_spans(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: ~s["added"])
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op4_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classified(table(spark, sf, "documents"), table(spark, sf, "labels"), held_out=0)


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identified(table(spark, sf, "documents"), held_out=0)


def op6_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    return bitslice.top_inner_products(rows, rows.filter("vec_id % 50 = 0"), k=5, vector="embedding", scale=256)


def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf, "documents"))


def op8_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return bilinear.scored(table(spark, sf, "documents"), held_out=1)


def op9_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed(table(spark, sf, "documents"), weights=(1, 2, 3), cap=3.0).select("doc_id", "size", "source_size", "target", "taken")


def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf, "documents"), window=20, period=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs, digest = table(spark, sf, "documents"), lambda *text: merkle.leaf_digest(*map(F.col, merkle.FIELDS[:-1]), *text)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(hit, digest(merkle.lowered(F.col("text").cast("string")))).otherwise(digest(F.col("text")))
    leaves = docs.select("doc_id", "source", digest(F.col("text")).alias("leaf"), tampered.alias("tampered"))
    proofs = merkle.manifest(leaves, keep=("tampered",))
    found = proofs.withColumn("folded_root", merkle.folded(F.col("tampered"), F.col("places"), F.col("others")))
    proof = F.sha2(F.array_join("others", "").cast("binary"), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return content.extracted(table(spark, sf, "pages"))


def op13_conversation_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefixes.trie(table(spark, sf, "conversations"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ITEM_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {ITEM_WORDS} AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS p FROM b WHERE len(w) > 0)),
places AS (
  SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)),
met AS (SELECT r, p, n, item_id FROM places JOIN phrases USING (n, phrase)),
hits AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM met) GROUP BY r),
names AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN names USING (r)"""

OP10 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, p, array_to_string(w[p : p + 19], ' ') AS phrase
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, p) AS n FROM places) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM again),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS q, unnest(w) AS word FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS s
  FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


OP6 = """
WITH e AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


def _crc32(number: str) -> str:
    """SQL for the unsigned crc32 of a number's decimal text; the polynomial is a fixed value."""
    step = "list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(CAST({number} AS VARCHAR), '')]), lambda a, b: {step}), 4294967295)"


def _op11(levels: int = 6) -> str:
    """The tree of each source and the tree above, as many levels as 16 ** ``levels`` leaves need."""
    field = lambda v: f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR) END"
    start = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    parts = [f"""
d AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, sha256({start} || {field('text')}) AS leaf,
    CASE WHEN {_crc32('doc_id')} % 5 = 0 THEN sha256({start} || {field(f"translate(text, '{UPPER}', '{LOWER}')")}) END AS tampered
  FROM documents),
l0 AS (SELECT *, leaf AS h, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d)"""]

    def climb(name: str) -> None:
        for k in range(levels):
            parts.append(f"""
{name}{k + 1} AS (
  SELECT tree, pos // 16 AS pos, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h, (max(n) + 15) // 16 AS n
  FROM {name}{k} GROUP BY tree, pos // 16)""")
            others = lambda side: f"coalesce((SELECT string_agg(o.h, '' ORDER BY o.pos) FROM {name}{k} o WHERE o.tree = x.tree AND o.pos // 16 = x.pos // 16 AND o.pos {side} x.pos), '')"
            parts.append(f"{name}{k}s AS (SELECT tree, pos, n, {others('<')} AS l, {others('>')} AS r FROM {name}{k} x)")

    climb("l")
    parts.append(f"u0 AS (SELECT '' AS tree, tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM l{levels})")
    climb("u")
    parts.append("f0 AS (SELECT d.doc_id, d.leaf, u.pos AS up, u.h AS subroot, coalesce(d.tampered, d.leaf) AS h, '' AS proof, d.tree, d.pos FROM l0 d JOIN u0 u ON u.name = d.tree)")
    step = 0
    for name, tree in (("l", "f.tree"), ("u", "''")):
        for k in range(levels):
            pos = "f.up" if name == "u" and k == 0 else "f.pos"
            parts.append(f"""
f{step + 1} AS (
  SELECT doc_id, leaf, up, subroot, CASE WHEN s.n = 1 THEN f.h ELSE sha256(s.l || f.h || s.r) END AS h, f.proof || s.l || s.r AS proof, f.tree, s.pos // 16 AS pos
  FROM f{step} f JOIN {name}{k}s s ON s.tree = {tree} AND s.pos = {pos})""")
            step += 1
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f{step}.h AS folded_root, f{step}.h = root AS verified
FROM f{step}, (SELECT h AS root FROM u{levels})"""


OP13 = f"""
WITH RECURSIVE t AS (
  SELECT conv_id AS c, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS turn,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(turn ORDER BY p) AS turns, {_crc32('c')} % 9 AS h FROM t GROUP BY c),
rebuilt AS (
  SELECT o.c, coalesce(b.turns[1 : o.h], []) || o.turns[o.h + 1 :] AS turns FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 5),
steps AS (SELECT c, d, turns[1 : d] AS k, d = len(turns) AS ends FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS e FROM steps GROUP BY k, d),
family AS (SELECT k[1 : d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
whole AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n - 1) * strlen(k[d].x) ELSE 0 END AS own FROM nodes n LEFT JOIN family USING (k)),
sums AS (
  SELECT u.k[1 : a] AS k, count(*) FILTER (u.n_children = 0) AS n_leaves, sum(u.own) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM whole) u GROUP BY 1)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n AS n_convs, w.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, w.e AS ends_sha256
FROM whole w JOIN sums s USING (k) LEFT JOIN nodes p ON w.d > 0 AND p.k = w.k[1 : w.d - 1]"""


def oracle() -> dict[str, str]:
    return {"op11_merkle_manifest": _op11(), "op13_conversation_prefix_trie": OP13, "op2_benchmark_decontamination": OP2, "op6_exact_top_k": OP6, "op10_substring_dedup": OP10}
