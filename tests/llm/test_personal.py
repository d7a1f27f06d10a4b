from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from statpanel.llm import personal, queries
from tests.llm import texts

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = [int(c) for c in text if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return True


def brute(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]


def base(text):
    return [s for s in personal.find(text) if s[0] in personal.BASE]


@pytest.mark.parametrize("alphabet", ["ab.@ ", "01.2 5", "0123456789 -", "+1 ().-92", "a@b.c-+1 2\n9é漢😀"])
def test_equals_the_patterns_from_the_left(alphabet):
    rng = random.Random(len(alphabet))
    seen = 0
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        want = brute(text)
        assert base(text) == want, text
        seen += len(want)
    assert seen > 50


def test_cards_ips_and_phones_in_odd_places():
    for text in (
        "4111 1111-1111 1111", "41111111111111111234", "4111  1111 1111 1111", "1.2.3.4.5.6.7.8.9", "256.1.1.1.2.3.4.5", "01.002.0003.255",
        "1.2.3.4444", "+1 (017) 555-7713", "+1 (017) 555-7713 .", "+12", "++49 30 1234567", "a@b@c.de@f.gh", "x@y..z @a.b a@-.-", "9" * 4000 + ".1.1.1",
    ):
        assert base(text) == brute(text), text


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("IBAN: DE89 3704 0044 0532 0130 00 BIC X", "iban", "DE89 3704 0044 0532 0130 00"),
        ("my iban GB29NWBK60161331926819.", "iban", "GB29NWBK60161331926819"),
        ("SSN 123-45-6789 here", "ssn", "123-45-6789"),
        ("Account number: 1234 5678 90, thanks", "account", "1234 5678 90"),
        ("Kontonummer 0532013000", "account", "0532013000"),
        ("passport no. X1234567", "passport", "X1234567"),
        ("see https://me:secret@example.com/x", "login", "https://me:secret@example.com"),
        ("Twitter: @some_one.", "handle", "@some_one"),
        ("lives at 12 Old Mill Road in", "address", "12 Old Mill Road"),
        ("wohnt Hauptstraße 7b, Bonn", "address", "Hauptstraße 7b"),
    ],
)
def test_cues(text, kind, value):
    assert (kind, text.index(value), text.index(value) + len(value)) in personal.find(text)


@pytest.mark.parametrize(
    "text",
    [
        "", "no data here, 12 apples and 3.14", "IBAN DE89 3704 0044 0532 0130 01", "SSN 000-45-6789", "the road to 12 hills", "an account of 2019",
        "https://example.com/a@b", "the accounts 123456789", "@media print", "1234567812345678", "Broad street 5", "tribanal 12",
    ],
)
def test_clean_texts(text):
    assert personal.find(text) == []


def test_long_texts_cost_as_much_per_character():
    for text in ("@ " * 200_000, "1" * 400_000, "a@" * 200_000, "1.1." * 100_000, "+1 " * 130_000, "IBAN " * 80_000, "Road " * 80_000, "x" * 10**6):
        assert base(text) == brute(text) if text[0] in "@+IR" else personal.find(text) is not None


def test_spans_of_odd_rows(spark):
    docs = texts.odd(spark, [*texts.ODD, (11, "x a.b@c.de 漢 1.2.3.4", 0.5, 1, "x")])
    found = personal.find_personal(docs.withColumn("personal", F.lit(1)))
    assert found.columns == [*docs.columns, "personal"]
    rows = found.collect()
    assert len(rows) == len(texts.ODD) + 1
    for r in rows:
        assert [tuple(s) for s in r["personal"]] == personal.find(r["text"] or "")
    assert personal.find_personal(texts.odd(spark, [])).count() == 0


def test_query(spark):
    want = dict(texts.small(spark))
    rows = queries.QUERIES["op11_personal"](spark, texts.SMALL).collect()
    assert len(rows) == len(want)
    for r in rows:
        spans = brute(want[r["doc_id"]])
        kinds = [k for k, _, _ in spans]
        assert [r[f"n_{k}"] for k in personal.BASE] == [kinds.count(k) for k in personal.BASE]
        joined = ",".join(":".join(map(str, s)) for s in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"].startswith(joined)
