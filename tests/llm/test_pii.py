import hashlib
import random
import re

import pytest
from scopewise.llm import pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub(r"\D", "", value, flags=re.ASCII)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    return sorted(
        (m.start(), k, m.end())
        for k, kind in enumerate(RULES)
        for m in re.finditer(RULES[kind], text)
        if valid(kind, m[0])
    )


def base(text):
    return [s for s in pii.find_spans(text, pii.automaton()) if s[1] < 4]


def test_random_texts():
    rnd = random.Random(5)
    alphabet = "0123459@@..+- ()aZ_%é\n:/"
    for _ in range(6000):
        text = "".join(rnd.choices(alphabet, k=rnd.randrange(60)))
        assert base(text) == brute(text), repr(text)


@pytest.mark.parametrize(
    "text",
    ["a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1.1.1", "4111 1111-1111 1111", "+1 (555) 123-4567.", "++4915112345678 9",
     "4111111111111111 4111111111111111", "x" * 9000 + "@" + "y." * 9000, "0" * 30000, "00000000000001.1.1.1"],
)
def test_edges(text):
    assert base(text) == brute(text)


def test_further_kinds():
    text = "see https://ann:pw@host.example/x IBAN: DE89 3704 0044 0532 0130 00, account no. 12345678 accounting 99"
    spans = [(pii.KINDS[k], text[b:e]) for b, k, e in pii.find_spans(text, pii.automaton())]
    assert ("url", "https://ann:pw@host.example") in spans
    assert ("iban", "DE89 3704 0044 0532 0130 00") in spans
    assert ("account", "12345678") in spans
    assert not any(value == "99" for _, value in spans)
    assert pii.find_spans("https://example.org/a is a page", pii.automaton()) == []
    assert pii.find_spans("IBAN DE00 3704 0044 0532 0130 00", pii.automaton())[:1] != [("iban",)]


DE, GB, NO = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO9386011117947"


def ibans(text):
    return [text[b:e] for b, k, e in pii.find_spans(text, pii.automaton()) if pii.KINDS[k] == "iban"]


@pytest.mark.parametrize(
    ("text", "found"),
    [(f"IBAN {DE} please pay by Friday", [DE]),
     ("IBAN DE89 3704 0044 0532 0130 00 is my account", ["DE89 3704 0044 0532 0130 00"]),
     (f"IBAN {GB} or iban {DE} by May 3", [GB, DE]), (f"iban: {NO} IBAN {NO} IBAN {NO}", [NO] * 3),
     (f"IBAN DE00370400440532013000 IBAN {DE} a b", [DE]), (f"IBAN of AB12 cd IBAN {DE}", [DE]),
     ("IBAN XX57 1234 5678 9012 345 and more", ["XX57 1234 5678 9012 345"]),
     (f"IBAN {DE}x and so on", []), (f"IBAN {DE}é", [DE]), (f"IBAN {'A1' * 17}{'b2' * 40} {DE}", [])],
)
def test_ibans_in_prose(text, found):
    assert ibans(text) == found


def test_ibans_of_no_known_length():
    """Any country and length, words behind: the number is found, or a longer one where mod 97 holds too."""
    rnd = random.Random(3)
    for _ in range(500):
        body = "".join(rnd.choices("0123456789ABC", k=rnd.randrange(11, 31)))
        check = 98 - int("".join(str(int(c, 36)) for c in f"{body}ZZ00")) % 97
        number = f"ZZ{check:02}{body}"
        (only,) = ibans(f"see IBAN {number} {rnd.choice(['is mine now', 'to be paid', '', 'or 12 34'])}")
        assert only.startswith(number) and pii.iban_valid(only)


def test_whole_table(odd_docs, documents, texts_of):
    for docs in (odd_docs, documents):
        found = {(r["doc_id"], r["base_sha256"]): r for r in pii.digest(pii.personal_data(docs)).collect()}
        for doc_id, text in texts_of(docs):
            line = ",".join(f"{pii.KINDS[k]}:{b}:{e}" for b, k, e in brute(text))
            row = found[doc_id, hashlib.sha256(line.encode()).hexdigest()]
            assert row["n_email"] == sum(k == 0 for _, k, _ in brute(text))
            if all(s[1] < 4 for s in pii.find_spans(text, pii.automaton())):
                assert row["spans"] == line


def test_empty(no_docs):
    assert pii.digest(pii.personal_data(no_docs)).collect() == []
