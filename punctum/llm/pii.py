"""Personal data in texts, plain or disguised, with places in the source text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from punctum.llm.common import chunks

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,added:boolean>>"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @ to the left over the local part, so a long run is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    double = [d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2])]
    return (sum(double) + sum(map(int, digits[-1::-2]))) % 10 == 0


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(digits := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}

# --- transducers: each rewrites a text and keeps, for every character, its place in the source ---

#: Letters of other scripts that look like these Latin ones (fixed values).
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
}
#: Characters that print nothing.
UNSEEN = "­​‌‍⁠﻿"
DIGITS = {w: str(n) for n, w in enumerate("zero one two three four five six seven eight nine".split())}

#: What the first transducer may rewrite: unseen characters, lookalikes, wide and mathematical forms, digits of other scripts.
ODD = re.compile("[%s%s٠-٩۰-۹०-९․！-～\U0001d400-\U0001d7ff]" % (UNSEEN, "".join(LOOKALIKES)))
DIGIT = "(?:%s|[0-9])" % "|".join(DIGITS)
SPELLED = re.compile(rf"(?i)(?<![A-Za-z0-9])(?:plus[\s,-]{{1,2}})?{DIGIT}(?:[\s,-]{{1,2}}(?:(?:dot|point)[\s,-]{{1,2}})?{DIGIT}){{6,}}(?![A-Za-z0-9])")
#: Four groups of up to three digits, plain or spelled, joined by dot words: an address, however few its digits.
GROUP = rf"(?:[0-9]{{1,3}}|{DIGIT}(?:[\s,-]{{1,2}}{DIGIT}){{0,2}})"
SPELLED_IP = re.compile(rf"(?i)(?<![A-Za-z0-9]){GROUP}(?:[\s,-]{{1,2}}(?:dot|point)[\s,-]{{1,2}}{GROUP}){{3}}(?![A-Za-z0-9])")
SPELLED_PART = re.compile(rf"(?i)(?P<digit>{DIGIT})|(?P<plus>plus)|(?P<dot>dot|point)|(?P<gap>[\s,-]+)")
BRACKETED = r"\s?[\[({{<]\s?{}\s?[\])}}>]\s?"
DOT = rf"(?:{BRACKETED.format(r'(?:dot|\.)')}|\sdot\s)"
AT = rf"(?:{BRACKETED.format(r'(?:at|@)')}|\sat\s)"
DOTTED = re.compile(rf"(?i)(?<=[A-Za-z0-9]){DOT}(?=[A-Za-z0-9])")
#: Ends of spelled-out addresses (fixed values): between plain words only these, and two letters of a host that
#: is not such a word, tell an address from prose.
ENDS = "com|org|net|edu|gov|mil|info|biz|io|uk|eu"
NO_HOST = "the|an?|this|that|these|those|each|every|any|one|no|its?|his|her|their|your|my|our"
LABEL = "[A-Za-z0-9-]+"
#: A domain of which one dot at least is spelled.
SPELLED_DOMAIN = rf"(?={LABEL}(?:\.{LABEL})*{DOT}){LABEL}(?:(?:{DOT}|\.){LABEL})*?(?:{DOT}|\.)"
#: A bracketed at sign before a domain, or a plain one before a domain with a spelled dot; real mail signs stay as they are.
ATTED = re.compile(rf"(?i)(?<=[A-Za-z0-9._%+-])(?:{BRACKETED.format(r'(?:at|@)')}(?=[A-Za-z0-9-]+(?:{DOT}|\.)[A-Za-z0-9])|\sat\s(?={SPELLED_DOMAIN}(?:{ENDS})(?![A-Za-z0-9-])|(?!(?:{NO_HOST})\s){SPELLED_DOMAIN}[A-Za-z]{{2}}(?![A-Za-z0-9-])))")
HINT = re.compile(r"(?i)[\[({<]\s?(?:at|dot|@|\.)\s?[\])}>]")
SPLIT = bytes(c if bytes([c]).isalnum() else 32 for c in bytes(range(256)).lower())
NUMBER_WORDS = frozenset(w.encode() for w in DIGITS)


class Tape:
    """A rewritten text with the source range of each of its characters."""

    def __init__(self, text: str):
        self.text, self.start = text, np.arange(len(text), dtype=np.int64)
        self.end, self.edited = self.start + 1, np.zeros(len(text), bool)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Put a text in place of each range; its characters all come from the whole range."""
        texts, starts, ends, marks, at = [], [], [], [], 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[at:a], new]
            starts.append(self.start[at:a]), ends.append(self.end[at:a]), marks.append(self.edited[at:a])
            if new:
                starts.append(np.full(len(new), self.start[a])), ends.append(np.full(len(new), self.end[b - 1])), marks.append(np.ones(len(new), bool))
            elif a > 0 and b > a:
                marks[-1] = marks[-1].copy()
                marks[-1][-1:] = True
            at = b
        self.text, self.start, self.end, self.edited = "".join(texts), np.concatenate(starts), np.concatenate(ends), np.concatenate(marks)


def plain_character(c: str) -> str:
    if c in UNSEEN:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if c == "․":
        return "."
    number = unicodedata.decimal(c, None)
    if number is not None:
        return str(number)
    form = unicodedata.normalize("NFKC", c)
    return form if len(form) == 1 and form.isascii() else c


def homoglyphs(tape: Tape) -> None:
    tape.rewrite([(m.start(), m.end(), plain_character(m[0])) for m in ODD.finditer(tape.text)])


def spelled_digits(tape: Tape) -> None:
    """Runs of at least seven digits, four of them or more spelled out, and addresses with a spelled digit become digits without gaps."""
    parts_of = lambda run: list(SPELLED_PART.finditer(tape.text, *run.span()))
    spelled = lambda parts: sum(p.lastgroup == "digit" and len(p[0]) > 1 for p in parts)
    runs = [(run.span(), parts) for run in SPELLED.finditer(tape.text) if spelled(parts := parts_of(run)) >= 4]
    more = [(run.span(), parts) for run in SPELLED_IP.finditer(tape.text) if spelled(parts := parts_of(run))]
    ends = np.array([end for (_, end), _ in runs], np.int64)
    for (a, b), parts in more:
        after = int(np.searchsorted(ends, a, side="right"))
        if after == len(ends) or runs[after][0][0] >= b:
            runs.append(((a, b), parts))
    edits = []
    for _, parts in sorted(runs, key=lambda r: r[0]):
        for p in parts:
            new = {"digit": DIGITS.get(p[0].lower(), p[0]), "plus": "+", "dot": ".", "gap": ""}[p.lastgroup]
            if new != p[0]:
                edits.append((p.start(), p.end(), new))
    tape.rewrite(edits)


def signs(tape: Tape) -> None:
    tape.rewrite([(*m.span(), "@") for m in ATTED.finditer(tape.text)])
    tape.rewrite([(*m.span(), ".") for m in DOTTED.finditer(tape.text)])


def found(text: str) -> list[tuple[str, int, int, bool]]:
    """``kind, start, end, added`` in code points, end exclusive, by kind and start.

    Plain identifiers first. Then those of the rewritten text that need a rewritten character, mapped back to the
    source, unless they overlap one found before; a plain one of the same kind may lie inside, as a part of it.
    """
    spans = [(kind, a, b, False) for kind in KINDS for a, b in FINDERS[kind](text)]
    odd = not text.isascii() and ODD.search(text)
    words = text.encode("utf-8", "replace").translate(SPLIT).split()
    spelled = not NUMBER_WORDS.isdisjoint(words)
    if not (odd or spelled or b"dot" in words or HINT.search(text)):
        return spans
    tape = Tape(text)
    homoglyphs(tape)
    spelled_digits(tape)
    signs(tape)
    if not tape.edited.any():
        return spans
    owner = {kind: np.zeros(len(text) + 1, np.int32) for kind in KINDS}  # 1 + place of the span that covers a character
    for n, (kind, a, b, _) in enumerate(spans, 1):
        owner[kind][a:b] = n
    for kind in KINDS:
        for a, b in FINDERS[kind](tape.text):
            start, end = int(tape.start[a]), int(tape.end[b - 1])
            if not tape.edited[a:b].any() or any(owner[k][start:end].any() for k in KINDS if k != kind):
                continue
            if all(start <= x and y <= end and not added for _, x, y, added in (spans[n - 1] for n in np.unique(owner[kind][start:end]).tolist() if n)):
                spans.append((kind, start, end, True))
                owner[kind][start:end] = len(spans)
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())]))


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``, one row for each row of ``docs``: personal data in code points of the text.

    Null and empty texts have none. Spans of different kinds may overlap where the plain text matches
    both; spans that only the rewritten text shows (``added``) overlap nothing but plain parts of themselves.
    Only ``doc_id`` and ``text`` are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            spans = [[dict(zip(("kind", "start", "end", "added"), s)) for s in found(t)] if t else [] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _TYPE)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id long, spans {SPANS}")


def masked(text: str) -> str:
    """The text with each stretch of personal data replaced by the kind of its first span, as ``<EMAIL>``."""
    parts, at, last = [], 0, -1
    for kind, a, b, _ in sorted(found(text), key=lambda s: (s[1], -s[2])):
        if a < last:
            at = last = max(last, b)
            continue
        parts += [text[at:a], f"<{kind.upper()}>"]
        at = last = b
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text``; all rows and columns are kept."""
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType) for f in docs.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, "text", pa.array([t and masked(t) for t in batch.column(place).to_pylist()], pa.string()))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)
