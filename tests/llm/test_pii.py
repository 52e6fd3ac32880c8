import hashlib
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from kindred.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for k, pattern, low, high in ((2, CARD, 12, 19), (3, PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (k == 3 or luhn(digits)):
                out.append((m.start(), k, m.end()))
    return sorted(out)


ANCHORS = P.automaton()
PARTS = ["@", ".", "-", " ", "+", "(", ")", "1", "9", "25", "256", "007", "4111", "1111", "a", "b.c", "x@y.z", "1.2.3.4", "é",
         "4111 1111-1111 1111", "+1 (555) 010-9999", "\n", "\U0001f600", "http://", "u:p@h", "iban ", "DE89370400440532013000", "0"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_kinds_equal_a_plain_search(text):
    found = P.find_spans(text, ANCHORS)
    assert [s for s in found if s[1] < 4] == plain(text)


def test_random_digits():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("0123456789 -.+()@ax") for _ in range(200))
        assert [s for s in P.find_spans(text, ANCHORS) if s[1] < 4] == plain(text)
    for text in ("1" * 20_000, "1." * 20_000, "a@" * 5000, "+" * 5000, "9 " * 9000, "x" * 100_000 + "@a.b"):
        assert [s for s in P.find_spans(text, ANCHORS) if s[1] < 4] == plain(text)


def kinds(text):
    return [(P.KINDS[k], text[a:b]) for a, k, b in P.find_spans(text, ANCHORS) if k > 3]


def test_more_kinds():
    assert ("login", "bob:secret") in kinds("see https://bob:secret@example.org/x")
    assert kinds("IBAN: DE89370400440532013000.") == [("iban", "DE89370400440532013000")]
    assert kinds("iban DE89370400440532013001") == []
    assert kinds("account no: 12345678 x") == [("account", "12345678")]
    assert kinds("SSN 123-45-6789, ssn 000-12-3456, ssn 666-12-3456") == [("ssn", "123-45-6789")]


def expected(rows):
    out = []
    for i, text in rows:
        spans = plain(text or "")
        n = Counter(k for _, k, _ in spans)
        base = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        out.append((i, n[0], n[1], n[2], n[3], hashlib.sha256(base.encode()).hexdigest()))
    return Counter(out)


def check(frame, rows):
    got = P.find_personal_data(frame).collect()
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == expected(rows)
    for r in got:
        base = [s for s in r["spans"].split(",") if s.split(":")[0] in P.BASE_KINDS]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r["base_sha256"]


def test_awkward_rows(odd, odd_rows):
    check(odd, [r[:2] for r in odd_rows])


def test_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    check(documents, rows)
    assert sum(n for k, n in expected(rows).items() if k[1]) > 10


def test_empty(empty):
    assert P.find_personal_data(empty).count() == 0
