"""Text of a document's fields as JSONB prints it.

VARIANT holds numbers by value, so the text of ``1.10`` is ``1.1`` there and that
of a number of 40 digits its nearest double; the text of a nested value has no
blanks and its keys are in byte order.  JSONB keeps a number's digits (without
an exponent: ``1e3`` is ``1000``), sets ``: `` and ``, ``, orders keys by length, then
bytes, and lets the last of equal keys win.

Few documents hold such values where their text is read.  :func:`needs_jsonb`
finds them by one expression; only their texts go through :func:`field_texts`, an
Arrow function, since no built-in walks values of any depth.
"""

from __future__ import annotations

import json
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred import model

TEXT_FIELDS = (model.KEY, model.VALUE, model.SCORE, model.EXPIRE, model.DATA)
ARRAY_FIELDS = (model.MEMBERS, model.ARRAY, model.LIST)
TYPE = ("struct<" + ", ".join([f"`{f}`: string" for f in TEXT_FIELDS]
                              + [f"`{f}`: array<string>" for f in ARRAY_FIELDS]) + ">")
#: Decimal exponents beyond the source type's stay as written.
MAX_EXPONENT = 131_072

# A number that a value behind ':', ',' or '[' begins with: negative zero, a fraction that ends in 0 or begins
# with six zeros, an exponent, or more digits than a decimal holds.  Runs are possessive: none is tried twice.
_NUMBER = (r"[:,\[]\s*+(?=[-0-9.])(?:-0(?![0-9.])|-?[0-9]++\.[0-9]++(?<=0)|-?0\.000000|-?[0-9]++(?:\.[0-9]++)?+[eE]|-?[0-9.]{38})")
# An object or array where a text is read, or as an element.
_NESTED = (r'"(?:' + "|".join(TEXT_FIELDS) + r')"\s*:\s*[\[{]|[\[,]\s*[\[{]')


class Number(str):
    """A number as the document writes it."""


def number_text(written: str) -> str:
    """Digits without exponent, fraction digits as written."""
    value = Decimal(written)
    if value and not -MAX_EXPONENT <= value.adjusted() <= MAX_EXPONENT:
        return written
    text = format(value, "f")
    return text[1:] if text[:1] == "-" and not value else text


def _key_order(key: str) -> tuple[int, bytes]:
    raw = key.encode("utf-8", "surrogatepass")
    return len(raw), raw


def jsonb_text(value: object) -> str:
    """A value as JSONB prints it."""
    if isinstance(value, Number):
        return number_text(value)
    if isinstance(value, str):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, list):
        return "[" + ", ".join(map(jsonb_text, value)) + "]"
    if isinstance(value, dict):
        return "{" + ", ".join(f"{jsonb_text(k)}: {jsonb_text(value[k])}" for k in sorted(value, key=_key_order)) + "}"
    return {None: "null", True: "true", False: "false"}[value]


def value_text(value: object) -> str | None:
    """A value as text: JSON null is none, a string its content."""
    if value is None:
        return None
    return str(value) if type(value) is str else jsonb_text(value)


def _no_number(name: str) -> None:
    raise ValueError(name)


def document_texts(text: str | None) -> dict | None:
    """The fields of :data:`TYPE`; none for what is not one JSON object."""
    if text is None:
        return None
    try:
        doc = json.loads(text, parse_int=Number, parse_float=Number, parse_constant=_no_number)
        if not isinstance(doc, dict):
            return None
        out: dict = {f: value_text(doc.get(f)) for f in TEXT_FIELDS}
        for f in ARRAY_FIELDS:
            out[f] = [value_text(x) for x in doc[f]] if isinstance(doc.get(f), list) else None
        for texts in (out.values()):
            for t in texts if isinstance(texts, list) else [texts]:
                if t is not None:
                    t.encode()  # half a surrogate pair is no text
        return out
    except (ValueError, RecursionError):
        return None


def needs_jsonb(text: Column) -> Column:
    """Whether some field's JSONB text may differ from its VARIANT's.  Only texts
    with a bracket behind their first brace are searched for nested values."""
    return text.rlike(_NUMBER) | ((text.contains("[") | (F.locate("{", text, 2) > 0)) & text.rlike(_NESTED))


def field_texts(text: Column) -> Column:
    """:data:`TYPE` of each document that needs it, null for all others."""
    struct = pa.struct([(f, pa.string()) for f in TEXT_FIELDS] + [(f, pa.list_(pa.string())) for f in ARRAY_FIELDS])

    @F.arrow_udf(TYPE)
    def texts(column: pa.Array) -> pa.Array:
        if column.null_count == len(column):
            return pa.nulls(len(column), struct)
        return pa.array([document_texts(t) for t in column.to_pylist()], struct)

    return texts(F.when(needs_jsonb(text), text))
