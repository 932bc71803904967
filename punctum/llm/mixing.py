"""Copies of documents that bring every source to its target share, by pivotal dependent rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from punctum.llm.common import NO_ID, free_prefix, stored
from punctum.operators.worklist import numbered

WORD = r"[^\x20\x09-\x0D]+"
SEED = 9_176_203
UNIT = "struct<doc_id:bigint,text_key:bigint,size:bigint,n:bigint,mass:double>"
DONE = "array<struct<doc_id:bigint,text_key:bigint,size:bigint,n:bigint,extra:int>>"


def units_of(docs: DataFrame) -> DataFrame:
    """Documents of equal id, text and source, with their number ``n``; ``size`` is the number of words."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), source_key().alias("source_key"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return rows.groupBy("doc_id", "text_key", "source_key", "size").agg(F.count("*").alias("n"))


def source_key():
    """The source as a text that is never null and sorts by code point, null last."""
    source = F.col("source").cast("string")
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(units: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """Per source: its size, number of units, target, and the whole and fractional copies of a document.

    Sources in order weigh ``weights``, repeating, and share all sizes; none gets more than ``cap`` times its
    size, what is above goes to the others by weight until none is above. The level of words per weight
    is found over the table of sources, one sum per round.
    """
    sizes = units.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("units"), F.sum("n").alias("rows"))
    ranked = numbered(stored(sizes, "sources"), "source_key")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rn") % len(weights) + 1).cast("int"))
    sources = stored(ranked.withColumn("weight", weight), "sources")
    most = F.col("source_size") * F.lit(float(cap))
    total, level = None, None
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > most
        kept, weighed, every = sources.agg(F.sum(F.when(above, most).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.sum("source_size")).first()
        total = float(every or 0)
        after = (total - kept) / weighed if weighed else level or 0.0
        if level is not None and after <= level:
            break
        level = after
    target = F.least(F.col("weight") * F.lit(float(level)), most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = sources.withColumn("target", target).withColumn("ratio", ratio)
    return sources.select("source_key", "source_size", "units", "rows", "target", F.floor("ratio").cast("long").alias("base"), (F.col("ratio") - F.floor("ratio")).alias("part"))


def _fold() -> str:
    """SQL that rounds the units of a sorted chunk ``us`` one after the other.

    Of the carried unit and the next, one takes mass from the other until one of the two is whole or empty
    and done; the direction is drawn so that every unit keeps its probability in the mean, and the
    words of both together stay the same. What is left is carried on.
    """
    step = f"""aggregate(array(named_struct(
        'up', least(s.carry.size - s.carry.mass, x.mass), 'down', least(s.carry.mass, x.size - x.mass),
        'u', pmod(xxhash64({SEED}, s.carry.doc_id, s.carry.text_key, x.doc_id, x.text_key), 1000000007) / 1000000007D)), s, (t, m) ->
      CASE WHEN m.u * (m.up + m.down) < m.down THEN
        CASE WHEN t.carry.size - t.carry.mass <= x.mass THEN {{done_a_1}} ELSE {{done_b_0}} END
      ELSE CASE WHEN t.carry.mass <= x.size - x.mass THEN {{done_a_0}} ELSE {{done_b_1}} END END)"""

    def done(unit: str, extra: int, other: str, mass: str) -> str:
        row = f"named_struct('doc_id', {unit}.doc_id, 'text_key', {unit}.text_key, 'size', {unit}.size, 'n', {unit}.n, 'extra', {extra})"
        carry = f"named_struct('doc_id', {other}.doc_id, 'text_key', {other}.text_key, 'size', {other}.size, 'n', {other}.n, 'mass', {mass})"
        return f"named_struct('carry', {carry}, 'done', concat(t.done, array({row})))"

    step = step.format(
        done_a_1=done("t.carry", 1, "x", "x.mass - m.up"), done_b_0=done("x", 0, "t.carry", "t.carry.mass + m.up"),
        done_a_0=done("t.carry", 0, "x", "x.mass + m.down"), done_b_1=done("x", 1, "t.carry", "t.carry.mass - m.down"))
    first = f"named_struct('carry', us[0], 'done', cast(array() as {DONE}))"
    return f"aggregate(slice(us, 2, size(us)), {first}, (s, x) -> {step})"


def rounded(parts: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    """``source_key, doc_id, text_key, size, n, extra``: each unit of ``parts`` rounded to 0 or 1; and per source the words still ``owed``.

    A tree: units of a source meet in chunks of about ``fan`` by hash, each chunk is folded to the units that
    are done and one residual, and the residuals meet in the next level. No chunk grows with its source.
    The last residual of a source takes the nearer of 0 and 1, so at most half of it is owed.
    """
    parts = stored(parts, "parts")
    most = parts.agg(F.max("units")).first()[0] or 0
    finished, level, chunks = [], 0, most
    while most:
        chunks = -(-chunks // fan)
        count = F.ceil(F.col("units") / F.lit(float(fan) ** (level + 1))).cast("long")
        order = F.xxhash64(F.lit(SEED + level), "source_key", "doc_id", "text_key", "size")
        unit = F.struct("doc_id", "text_key", "size", "n", "mass").cast(UNIT)
        grouped = parts.groupBy("source_key", "units", F.pmod(order, count).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct(order.alias("h"), unit.alias("u")))).alias("us"))
        folded = grouped.withColumn("us", F.col("us.u")).select("source_key", "units", F.expr(_fold()).alias("f"))
        folded = stored(folded.select("source_key", "units", "f.carry", "f.done"), "rounded")
        finished.append(folded.select("source_key", F.explode("done").alias("d")).select("source_key", "d.*"))
        parts, level = folded.select("source_key", "units", "carry.*"), level + 1
        if chunks <= 1:
            break
    extra = F.when(F.col("mass") * 2 >= F.col("size"), 1).otherwise(0)
    result = parts.select("source_key", "doc_id", "text_key", "size", "n", extra.cast("int").alias("extra"))
    for rows in finished:
        result = result.union(rows)
    return result, parts.select("source_key", (F.col("mass") - extra * F.col("size")).alias("owed"))


def copies(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, fan: int = 64) -> DataFrame:
    """Per unit: ``doc_id, text_key, source_key, size, n, source_size, target, base, more, extra``.

    Documents above the mean size of their source are rounded first, the others afterwards with what the first are
    off, so that a source ends within about half of a small document of its target.

    The first ``more`` of the ``n`` equal rows take ``base + 1`` copies, the next ``base + extra``, the rest ``base``.
    """
    units = stored(units_of(docs), "units")
    per_source = stored(targets(units, weights, cap), "targets")
    shared = units.join(per_source, "source_key")
    whole = F.floor(F.col("n") * F.col("part"))
    shared = shared.withColumn("more", whole.cast("long")).withColumn("mass", (F.col("n") * F.col("part") - whole) * F.col("size"))
    open_ = (F.col("mass") > 0) & (F.col("mass") < F.col("size"))
    large = F.col("size") * F.col("rows") > F.col("source_size")
    columns = ["source_key", "units", "doc_id", "text_key", "size", "n", "mass"]
    first, owed = rounded(shared.filter(open_ & large).select(columns), fan)
    small = _moved(shared.filter(open_ & ~large).select(columns), stored(owed, "owed"))
    still = (F.col("mass") > 0) & (F.col("mass") < F.col("size"))
    second, _ = rounded(small.filter(still), fan)
    whole = small.filter(~still).select("source_key", "doc_id", "text_key", "size", "n", (F.col("mass") > 0).cast("int").alias("extra"))
    rest = shared.filter(~open_).select("source_key", "doc_id", "text_key", "size", "n", F.lit(0).alias("extra"))
    every = first.union(second).union(whole).union(rest).join(per_source, "source_key")
    return every.withColumn("more", F.floor(F.col("n") * F.col("part")).cast("long")).drop("part", "units", "rows")


def _moved(parts: DataFrame, owed: DataFrame) -> DataFrame:
    """``parts`` with the words owed to their source spread over them: up in proportion to what is free, down
    in proportion to what is there, as far as they reach."""
    room = parts.groupBy("source_key").agg(F.sum(F.col("size") - F.col("mass")).alias("free"), F.sum("mass").alias("held"))
    share = room.join(owed, "source_key").select("source_key", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("owed") / F.when(F.col("owed") > 0, F.col("free")).otherwise(F.col("held")))).alias("share"))
    # Stored, so that its measured size decides how the documents meet it: a source's own don't meet in one task for a row a source.
    share = stored(share, "shares")
    share_ = F.coalesce("share", F.lit(0.0))
    moved = F.col("mass") + share_ * F.when(share_ > 0, F.col("size") - F.col("mass")).otherwise(F.col("mass"))
    # a share of 1 or -1 must give a whole document exactly
    moved = F.when(share_ >= 1, F.col("size").cast("double")).when(share_ <= -1, 0.0).otherwise(moved)
    return stored(parts.join(share, "source_key", "left").withColumn("mass", moved).drop("share"), "small")


def _times(index) -> F.Column:
    return F.col("base") + F.when(index < F.col("more"), 1).otherwise(F.when(index == F.col("more"), F.col("extra")).otherwise(0))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, fan: int = 64) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken``, one row for each row of ``docs``.

    size: words of the text, null is 0; taken: words that the mix takes of the row, ``copies`` times its size.
    A null source is a source, the last. Sources without words have target 0 and take nothing. All draws
    are hashes of ids and texts, so reruns agree. An empty table gives an empty table. Only ``doc_id``, ``text`` and
    ``source`` are read.
    """
    rows = copies(docs, weights, cap, fan)
    block = 4096
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / block))))
    inside = F.sequence(F.col("block") * block, F.least(F.col("n"), (F.col("block") + 1) * block) - 1)
    rows = rows.withColumn("row", F.explode(inside)).withColumn("copies", _times(F.col("row")).cast("long"))
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, fan: int = 64) -> DataFrame:
    """``docs`` as the mix takes them: every row as many times as it has copies, numbered by ``copy`` from 1
    (``copy_`` and so on, where a column of ``docs`` begins like that)."""
    plan = copies(docs, weights, cap, fan).select("doc_id", "text_key", "source_key", "n", "base", "more", "extra")
    mix_ = free_prefix(docs.columns, "mix_")
    plan = plan.select(*[F.col(c).alias(mix_ + c) for c in plan.columns])
    of, keys = lambda c: F.col(mix_ + c), [mix_ + c for c in ("doc_id", "text_key", "source_key")]
    key = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NO_ID))
    rows = docs.withColumns({keys[0]: key("doc_id"), keys[1]: F.xxhash64("text"), keys[2]: source_key()})
    # The join and the numbering of equal rows share one shuffle.
    met = rows.join(plan.withColumn(keys[0], key(keys[0])), keys)
    same = Window.partitionBy(*keys).orderBy(of("n"))
    index = F.when(of("n") > 1, F.row_number().over(same) - 1).otherwise(0)
    times = of("base") + F.when(of("row") < of("more"), 1).otherwise(F.when(of("row") == of("more"), of("extra")).otherwise(0))
    met = met.withColumn(mix_ + "row", index).withColumn(mix_ + "times", times).filter(of("times") > 0)
    return met.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), of("times").cast("int"))).alias(free_prefix(docs.columns, "copy")))
