"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over the text: at-signs, plus signs, digits, schemes and cues such as `IBAN` or `account no`. At
an anchor a small parser expands to both sides, up to a boundary that the text alone decides, and validates what it holds. Every parser
reads each character a bounded number of times, so a long text costs as much per character as a short one.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans are listed: first those every user of the list relies on, then those that anchors add.
BASE = ("email", "ip", "card", "phone")
ADDED = ("account", "address", "handle", "iban", "login", "passport", "ssn")
SPANS = "array<struct<kind:string,start:int,end:int>>"

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Fixed cues, each with the parser that it starts.
CUES = {
    "account": "account no, account number, account id, account:, account #, acct, kontonummer, numéro de compte, número de cuenta",
    "address": "street, avenue, boulevard, road, lane, drive, straße, strasse",
    "handle": "twitter, instagram, telegram, github, tiktok, mastodon, handle, username",
    "iban": "iban",
    "passport": "passport, reisepass, passeport, pasaporte",
    "ssn": "ssn, social security",
}
_FILL = r"[\s#:.=]*+(?:(?:no|nr|number|is|id)\b[\s#:.=]*+)?+"
ACCOUNT = re.compile(_FILL + r"([0-9](?:[ -]?[0-9]){5,17}+)(?![0-9A-Za-z])")
HANDLE = re.compile(r"[\s:=]{0,4}+(@[A-Za-z0-9_](?:[A-Za-z0-9_.]{0,28}[A-Za-z0-9_])?)(?![A-Za-z0-9_@])")
IBAN = re.compile(_FILL + r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+)")
PASSPORT = re.compile(_FILL + r"([A-Z]{0,2}[0-9]{6,9})(?![0-9A-Za-z])")
SSN = re.compile(_FILL + r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
LOGIN = re.compile(r"[^\s/?#@:]++:[^\s/?#@]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+")
#: What may stand around the word for a street: a house number and capitalised words before it, or a name that it ends and a number after it.
NUMBERED = re.compile(r"(?<![\w.,-])[0-9]{1,5}[A-Za-z]?(?: [A-ZÄÖÜ]\w{0,24}){1,3} [A-Z]\w+\Z")
NAMED = re.compile(r"(?<!\w)[A-ZÄÖÜ]\w{0,40}stra(?:ß|ss)e\Z")
NUMBER = re.compile(r" [0-9]{1,4}[a-z]?(?!\w)")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for mark in "@+0123456789":
        found.add_word(mark, ("digit" if mark.isdigit() else mark, 1))
    found.add_word("://", ("login", 3))
    for kind, cues in CUES.items():
        for cue in cues.split(", "):
            for form in (cue, cue.upper(), cue.capitalize(), cue.title()):
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        twice = int(d) * (1 + i % 2)
        total += twice - 9 * (twice > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _iban(text: str, at: int, end: int) -> tuple[int, int] | None:
    """The longest start of the run that is a valid IBAN and ends at the end of a word."""
    for stop in range(end, at + 14, -1):
        if text[stop - 1] == " " or text[stop : stop + 1].isalnum():
            continue
        code = text[at:stop].replace(" ", "")
        if 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return at, stop
    return None


def _fits_octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def _value(pattern: re.Pattern):
    """A parser of what stands after its cue, if the pattern fits there."""

    def parse(text: str, at: int, end: int) -> tuple[int, int] | None:
        m = pattern.match(text, end)
        return m.span(1) if m else None

    return parse


def _after_iban(text: str, at: int, end: int) -> tuple[int, int] | None:
    m = IBAN.match(text, end)
    return _iban(text, *m.span(1)) if m else None


def _after_ssn(text: str, at: int, end: int) -> tuple[int, int] | None:
    m = SSN.match(text, end)
    valid = m and m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000"
    return (m.start(1), m.end(3)) if valid else None


def _around_street(text: str, at: int, end: int) -> tuple[int, int] | None:
    start = max(at - 90, 0)
    nearby = text[start:end]
    if m := NUMBERED.search(nearby):
        return start + m.start(), end
    m, number = NAMED.search(nearby), NUMBER.match(text, end)
    return (start + m.start(), number.end()) if m and number else None


def _around_scheme(text: str, at: int, end: int) -> tuple[int, int] | None:
    """A scheme and what it leads to, if that names a user and a password."""
    m, before = LOGIN.match(text, end), text[max(at - 12, 0) : at]
    scheme = len(before) - len(before.rstrip("abcdefghijklmnopqrstuvwxyz+"))
    return (at - scheme, m.end()) if m and scheme else None


PARSERS = {
    "account": _value(ACCOUNT),
    "address": _around_street,
    "handle": _value(HANDLE),
    "iban": _after_iban,
    "login": _around_scheme,
    "passport": _value(PASSPORT),
    "ssn": _after_ssn,
}


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by kind and start. Spans of the base kinds do not overlap within a kind."""
    out = set()
    email_from = card_from = ip_from = 0
    for last, (kind, size) in automaton().iter(text):
        at, end = last + 1 - size, last + 1
        if kind == "digit":
            # The first digit of a run stands where a search from the left would begin, and no later digit of it gives another match.
            if at >= card_from:
                m = GROUPED.match(text, at)
                card_from = m.end() if m else end
                if m and 16 <= card_from - at <= 37:
                    digits = _digits(m[0])
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        out.add(("card", at, card_from))
            if at >= ip_from:
                m = DOTTED.match(text, at)
                ip_from = m.end()
                if m[0].count(".") >= 3:
                    start, parts = at, m[0].split(".")
                    for i in range(0, len(parts) - 3, 4):
                        stop = start + sum(map(len, parts[i : i + 4])) + 3
                        if _fits_octets(parts[i : i + 4]):
                            out.add(("ip", start, stop))
                        start = stop + 1
        elif kind == "@":
            before = text[email_from:at]
            local = len(before) - len(before.rstrip(LOCAL))
            m = DOMAIN.match(text, end) if local else None
            if m:
                out.add(("email", at - local, m.end()))
            email_from = m.end() if m else end
        elif kind == "+":
            m = PHONE.match(text, at)
            if m and 8 <= len(_digits(m[0])) <= 15:
                out.add(("phone", at, m.end()))
        elif kind == "login" or not text[end : end + 1].isalpha() and (kind == "address" or not text[at - 1 : at].isalnum()):
            span = PARSERS[kind](text, at, end)
            if span:
                out.add((kind, *span))
    kinds = BASE + ADDED
    return sorted(out, key=lambda s: (kinds.index(s[0]), s[1], s[2]))


def personal_spans(text: Column) -> Column:
    """The spans of each text, array<struct<kind, start, end>>; null and empty texts have none.

    Base kinds hold all that a search for their patterns from the left gives after validation; anchors add the other kinds. Spans of
    different kinds may overlap. Texts are searched whole, whatever their length, each by itself: no key or copy can become hot.
    """

    @F.arrow_udf(SPANS)
    def found(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        spans = ([{"kind": k, "start": a, "end": b} for k, a, b in find(t.as_py() or "")] for t in texts)
        return pa.array(list(spans), kind)

    return found(text)


def find_personal(docs: DataFrame) -> DataFrame:
    """docs with a column `personal`, see personal_spans; a column of that name is replaced, all others stay.

    Repeated rows, equal texts and null ids are each searched; an empty table gives an empty table.
    """
    return docs.withColumn("personal", personal_spans(F.col("text")))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
