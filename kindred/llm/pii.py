"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus
signs and digits, URL schemes, and words that announce an identifier.  From
each anchor a deterministic local parser expands to the left and right and
validates what it found:

* ``email``: local part to the left of an at-sign, dotted domain to the right.
* ``ip``: four dotted numbers of at most 255.
* ``card``: digits with single blanks or hyphens between them, 12 to 19 of them,
  passing Luhn.
* ``phone``: a plus sign and 9 to 15 digits with usual separators.
* ``login``: user and password in the authority of a URL with a scheme.
* ``iban``: after a cue, country, check digits and account, passing mod 97.
* ``account``: after a cue, 6 to 17 digits.
* ``ssn``: after a cue, three, two and four digits, without the groups never issued.

The first four are the base kinds.  Each equals a left-to-right, non-overlapping
search for its pattern: a parser never starts before the end of that kind's last
match, and a match that fails validation is dropped but used up.  The others
only add spans.  Anchors are independent of each other, so every text is worked
in time linear in its length, whole, on the executors.

Defined results: a null or empty text has no spans; spans of different kinds may
overlap; equal starts are ordered as the kinds are listed; repeated rows are
returned as often as they came; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from kindred.session import ship_package

#: Kinds in the order that breaks ties between equal starts.
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("login", "iban", "account", "ssn")
KINDS = BASE_KINDS + MORE_KINDS

SCHEMES = ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://", "mongodb://", "redis://", "amqp://")
#: Words that announce an identifier, and the kind that follows them.
CUES = {"iban": "iban", "account": "account", "acct": "account", "konto": "account", "cuenta": "account",
        "compte": "account", "ssn": "ssn", "social security": "ssn"}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"[0-9][ ().0-9-]+")
_LOGIN = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+(?=@)")
_GAP = r"[ \t]*(?:no|number|nr|nummer|num)?\.?[ \t]*[:#=]?[ \t]*"
_IBAN = re.compile(_GAP + r"(?P<x>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])", re.IGNORECASE)
_ACCOUNT = re.compile(_GAP + r"(?P<x>[0-9](?:[ -]?[0-9]){5,16})(?![0-9])", re.IGNORECASE)
_SSN = re.compile(_GAP + r"(?P<x>(?!000|666|9)[0-9]{3}([- ]?)(?!00)[0-9]{2}\2(?!0000)[0-9]{4})(?![0-9])", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved.upper())) % 97 == 1


def _low_number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, "digit")
    a.add_word("@", "email")
    a.add_word("+", "phone")
    for s in SCHEMES:
        a.add_word(s, "login")
    for cue, kind in CUES.items():
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            a.add_word(form, kind)
    a.make_automaton()
    return a


class _Finder:
    """The parsers of one text, with the end of each kind's last match."""

    def __init__(self, text: str):
        self.text, self.spans = text, []
        self.after = dict.fromkeys(KINDS, 0)

    def _add(self, kind: str, begin: int, end: int) -> None:
        self.spans.append((begin, KINDS.index(kind), end))

    def email(self, at: int) -> None:
        text, begin, floor = self.text, at, self.after["email"]
        while begin > floor and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            self._add("email", begin, m.end())
            self.after["email"] = m.end()

    def digit(self, at: int) -> None:
        """A digit outside earlier matches is the leftmost start of its kind."""
        if at >= self.after["ip"]:
            m = _DOTTED.match(self.text, at)
            parts = m[0].split(".")
            begin = at
            for k in range(0, len(parts) - 3, 4):
                four = parts[k:k + 4]
                end = begin + sum(map(len, four)) + 3
                if all(map(_low_number, four)):
                    self._add("ip", begin, end)
                begin = end + 1
            # Up to three numbers are left: no match can start at any of them.
            self.after["ip"] = m.end()
        if at >= self.after["card"]:
            m = _GROUPED.match(self.text, at)
            if m:
                self.after["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    self._add("card", at, m.end())

    def phone(self, at: int) -> None:
        if at < self.after["phone"] or not (m := _PHONE.match(self.text, at + 1)):
            return
        end = m.end()
        while self.text[end - 1] not in _DIGITS:
            end -= 1
        if end - at < 4:  # a digit, at least one character and a digit after the plus sign
            return
        self.after["phone"] = end
        if 9 <= sum(c in _DIGITS for c in self.text[at:end]) <= 15:
            self._add("phone", at, end)

    def login(self, at: int) -> None:
        if m := _LOGIN.match(self.text, at + 1):
            self._add("login", m.start(), m.end())

    def _cued(self, kind: str, pattern: re.Pattern, at: int, valid=lambda x: True) -> None:
        m = pattern.match(self.text, at + 1)
        if m and m.start("x") >= self.after[kind] and valid(m["x"]):
            self._add(kind, m.start("x"), m.end("x"))
            self.after[kind] = m.end("x")

    def iban(self, at: int) -> None:
        self._cued("iban", _IBAN, at, lambda x: mod97(x.replace(" ", "")))

    def account(self, at: int) -> None:
        self._cued("account", _ACCOUNT, at)

    def ssn(self, at: int) -> None:
        self._cued("ssn", _SSN, at)


def find_spans(text: str, anchors) -> list[tuple[int, int, int]]:
    """``(begin, index in KINDS, end)`` in order; code points, end exclusive."""
    finder = _Finder(text)
    parsers = {k: getattr(finder, k) for k in ("email", "digit", "phone", "login", "iban", "account", "ssn")}
    for at, kind in anchors.iter(text):
        parsers[kind](at)
    return sorted(finder.spans)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{begin}:{end}" for begin, k, end in spans)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_email, n_ip, n_card, n_phone,
    n_more, base_sha256, spans`` (all spans as ``kind:start:end``)."""
    ship_package(docs.sparkSession)
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("_text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    names = [f"n_{k}" for k in BASE_KINDS] + ["n_more"]

    def run(batches):
        anchors = automaton()
        for batch in batches:
            counts, digests, spans = [[] for _ in names], [], []
            for value in batch.column(1):
                found = find_spans(value.as_py() or "", anchors)
                base = [s for s in found if s[1] < len(BASE_KINDS)]
                for k, column in enumerate(counts[:-1]):
                    column.append(sum(s[1] == k for s in base))
                counts[-1].append(len(found) - len(base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string())], names=["doc_id", *names, "base_sha256", "spans"])

    longs = ", ".join(f"{n} long" for n in names)
    return slim.mapInArrow(run, f"doc_id {kind}, {longs}, base_sha256 string, spans string")
