"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, digits, plus signs, schemes and cue words. A small
parser per kind expands an anchor to both sides, validates the span and moves on behind it.

Base kinds (leftmost, not overlapping within a kind; a span that fails its check is dropped and not
tried again from the inside): ``email``, ``ip``, ``card``, ``phone``. Further kinds, which never change
base spans: ``url`` (an address that carries a user: ``scheme://user[:password]@host``), ``iban`` (cue
``IBAN``, check digits by mod 97) and ``account`` (cue ``account`` or ``acct``, 6 to 17 digits). Words may
follow an IBAN: it ends at the length of its country, or else at the last word end where mod 97 holds.

Defined cases: a null text is empty; offsets count code points of the whole text, end exclusive; a null
doc_id is passed on; repeated rows each get a row; no other column is read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.llm.batches import map_batches, pieces, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account")

Span = tuple[int, int, int]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_USER = re.compile(r"[^\s/@:?#\"'<>]+(?::[^\s/@?#\"'<>]*)?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?")
_IBAN = re.compile(r"[\s:#]{0,3}([A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30})")
_WORD_END = re.compile(r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"\x20?(?:(?:no|nr|number|num)\b\.?)?[\x20:#]{0,3}([0-9]{6,17})(?![0-9])", re.IGNORECASE)

SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "postgres://", "mysql://", "redis://")
CUES = {"IBAN": "iban", "iban": "iban", "Iban": "iban"} | dict.fromkeys(
    ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT"), "account"
)

#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
        32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = 2 * value - 9 * (value > 4)
        total += value
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    value = value.replace(" ", "").upper()
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def iban_end(text: str, begin: int, longest: int) -> int | None:
    """Where the IBAN at ``begin`` ends: at the length of its country, or the last word end where mod 97 holds."""
    length = IBAN_LENGTHS.get(text[begin : begin + 2].upper())
    ends = [m.start() for m in _WORD_END.finditer(text, begin + 1, longest + 1) if m.start() <= longest]
    ends.sort(key=lambda end: (end - begin - text.count(" ", begin, end) != length, -end))
    return next((end for end in ends if iban_valid(text[begin:end])), None)


def automaton() -> ahocorasick.Automaton:
    """Anchors with what they may begin: @, +, digit, scheme, or the kind of a cue."""
    found = ahocorasick.Automaton()
    for digit in _DIGITS:
        found.add_word(digit, ("digit", 1))
    for word, kind in [("@", "@"), ("+", "+"), *((s, "scheme") for s in SCHEMES), *CUES.items()]:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _only_digits(value: str) -> str:
    return "".join(c for c in value if c in _DIGITS)


def find_spans(text: str, anchors: ahocorasick.Automaton) -> list[Span]:
    """(start, number of the kind in KINDS, end) of all spans, in that order."""
    spans: list[Span] = []
    behind = dict.fromkeys(KINDS, 0)

    def take(kind: str, begin: int, end: int, valid: bool) -> None:
        behind[kind] = end
        if valid:
            spans.append((begin, KINDS.index(kind), end))

    for last, (anchor, length) in anchors.iter(text):
        at = last - length + 1
        if anchor == "digit":
            if at >= behind["ip"] and (at == behind["ip"] or text[at - 1] not in _DIGITS) and (m := _IP.match(text, at)):
                take("ip", at, m.end(), all(len(p := part.lstrip("0")) < 4 and int(p or 0) < 256 for part in m[0].split(".")))
            if at >= behind["card"] and (m := _CARD.match(text, at)):
                digits = _only_digits(m[0])
                take("card", at, m.end(), 14 <= len(digits) <= 19 and luhn(digits))
        elif anchor == "@":
            begin, floor = at, behind["email"]
            while begin > floor and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at and (m := _DOMAIN.match(text, at + 1)):
                take("email", begin, m.end(), True)
        elif anchor == "+":
            if at >= behind["phone"] and (m := _PHONE.match(text, at)):
                take("phone", at, m.end(), 10 <= len(_only_digits(m[0])) <= 15)
        elif anchor == "scheme":
            if at >= behind["url"] and (m := _USER.match(text, last + 1)):
                take("url", at, m.end(), True)
        elif at >= behind[anchor] and not (at and text[at - 1].isalnum()):
            if anchor == "account":
                if m := _ACCOUNT.match(text, last + 1):
                    take(anchor, m.start(1), m.end(1), True)
            elif m := _IBAN.match(text, last + 1):
                end = iban_end(text, m.start(1), m.end(1))
                take(anchor, m.start(1), end or last + 1, end is not None)
    spans.sort()
    return spans


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{begin}:{end}" for begin, kind, end in spans)


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for piece in pieces(batches):
        rows = [
            [{"kind": KINDS[kind], "start": begin, "end": end} for begin, kind, end in find_spans(text, anchors)]
            for text in texts(piece)
        ]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end) of every row, by start and then kind as listed."""
    return docs.select(F.col("doc_id").cast("long"), "text").transform(
        map_batches,
        _scan, "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base: Callable = lambda s: s["kind"].isin(*BASE_KINDS)
    return found.select(
        "doc_id",
        *(count(kind) for kind in BASE_KINDS),
        F.sha2(line(F.filter("spans", base)), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
    )


def spans_sha256(text: str) -> str:
    """The base hash of one text; for tests and callers without Spark."""
    spans = [s for s in find_spans(text, automaton()) if s[1] < len(BASE_KINDS)]
    return hashlib.sha256(written(spans).encode()).hexdigest()
