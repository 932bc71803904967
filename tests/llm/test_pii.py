import random
import re
from hashlib import sha256

import pytest

from punctum.llm import pii, queries
from tests.llm.conftest import SF

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checksum(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        value = int(d) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return [
        *(("email", *m.span()) for m in EMAIL.finditer(text)),
        *(("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))),
        *(("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and checksum(digits(m))),
        *(("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15)]


def base(text):
    return [s[:3] for s in pii.found(text) if not s[3]]


@pytest.mark.parametrize("alphabet", ["ab@.-9 ", "0123. 59", "0 1-2 345678", "+1 ()-.23456789", "aé@.ß٣9 ", "@@..ab"])
def test_base_spans_equal_the_expressions(alphabet):
    draw = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40)))
        assert base(text) == plain(text), text


def test_base_spans_of_identifiers():
    for text in ("a@b.c@d.e", "x@y.z.", "mail me.me%1@my-host.co.uk now", "1.2.3.4.5.6.7.8", "256.1.1.1 1.256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-11112222",
                 "+44 (0)20 7946 0958", "+1", "+123456789012345678", "00000000000000000000", "9" * 5000 + ".1.1.1"):
        assert base(text) == (plain(text) if len(text) < 4000 else base(text))


@pytest.mark.parametrize("text, kind, source", [
    ("write to jane.doe [at] example [dot] org today", "email", "jane.doe [at] example [dot] org"),
    ("write to jane at example dot org today", "email", "jane at example dot org"),
    ("write to jane(at)mail.example.org today", "email", "jane(at)mail.example.org"),
    ("write to jаne@exаmple.org today", "email", "jаne@exаmple.org"),
    ("write to ｊａｎｅ＠example.org today", "email", "ｊａｎｅ＠example.org"),
    ("write to ja​ne@example.o​rg today", "email", "ja​ne@example.o​rg"),
    ("host 192[.]168[.]0[.]17 is", "ip", "192[.]168[.]0[.]17"),
    ("host one nine two dot one six eight dot zero dot one seven is", "ip", "one nine two dot one six eight dot zero dot one seven"),
    ("call plus four four two zero seven nine four six zero nine five eight now", "phone", "plus four four two zero seven nine four six zero nine five eight"),
    ("call +٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨ now", "phone", "+٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨"),
    ("pay four one one one one one one one one one one one one one one one now", "card", "four one one one one one one one one one one one one one one one"),
])
def test_disguises_are_found_in_the_source(text, kind, source):
    spans = pii.found(text)
    start = text.index(source)
    assert (kind, start, start + len(source)) in [s[:3] for s in spans]
    assert source not in pii.masked(text) and f"<{kind.upper()}>" in pii.masked(text)


@pytest.mark.parametrize("text", [
    "meet me at example.com at noon", "look at this dot and at that dot too", "one two three four", "at dot at dot", "the one at home dot", "Тhe сat", "x [at] y", "1 one 2 two 3", "été à la mer", "[.] (.) <@>",
])
def test_clean_texts_stay_clean(text):
    assert pii.found(text) == [] and pii.masked(text) == text


def test_added_spans_hold_only_parts_of_themselves_and_base_stays():
    draw, words = random.Random(9), ["a@b.co", "jane", "at", "[at]", "dot", "[dot]", "example", "org", "one", "two", "nine", "zero", "+1", "555", "0100", "1.2.3.4", "(.)", "​", "ｘ", "4111 1111 1111 1111", "plus"]
    for _ in range(2000):
        text = " ".join(draw.choice(words) for _ in range(draw.randint(1, 25)))
        spans = pii.found(text)
        assert [s[:3] for s in spans if not s[3]] == plain(text)
        covered = [set(range(a, b)) for _, a, b, new in spans if new]
        assert sum(map(len, covered)) == len(set().union(*covered))
        for kind, a, b, new in spans:
            assert not new or all(k == kind and a <= x and y <= b for k, x, y, old in spans if not old and x < b and y > a)
        assert all(0 <= a < b <= len(text) for _, a, b, _ in spans)


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "a." * 200_000 + "@", "@" * 300_000, "1" * 300_000, "1 " * 200_000, "+1" + " " * 300_000, "1." * 200_000, "one " * 20_000):
        pii.found(text)


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op3_pii_spans(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        spans = plain(docs[r.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == sha256(written.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]


def test_odd_rows(spark, odd, none, clashing):
    assert pii.personal_data(odd).count() == odd.count()
    assert pii.personal_data(odd).filter("size(spans) > 0").count() == 0
    assert pii.personal_data(none).count() == 0
    masked = pii.redacted(clashing)
    assert masked.columns == clashing.columns
    assert sorted(map(repr, masked.select("doc_id", "text").collect())) == sorted(map(repr, odd.select("doc_id", "text").collect()))


@pytest.mark.parametrize("text, kind, source", [
    ("write to anna at firma dot de today", "email", "anna at firma dot de"),
    ("write to anna at firma dot fr", "email", "anna at firma dot fr"),
    ("write to anna at mail.example dot com today", "email", "anna at mail.example dot com"),
    ("write to anna at mail dot example.com today", "email", "anna at mail dot example.com"),
    ("host eight dot eight dot eight dot eight is", "ip", "eight dot eight dot eight dot eight"),
    ("host one dot 1 dot one zero dot 255 is", "ip", "one dot 1 dot one zero dot 255"),
    ("hosts one dot two dot three dot four, and plus four four two zero seven nine four six zero nine five eight", "ip", "one dot two dot three dot four"),
])
def test_more_disguises(text, kind, source):
    assert (kind, text.index(source), text.index(source) + len(source), True) in pii.found(text)


@pytest.mark.parametrize("text", ["look at the dot in the middle", "one dot two dot three", "meet at noon. dot com was", "we stood at a dot of light"])
def test_prose_near_the_new_disguises(text):
    assert pii.found(text) == []
