"""Column expressions over one parsed document.

A document is held as ``MAP<STRING,VARIANT>``: top-level fields are map
entries, values keep their JSON type (string, number, object, array, null).
Every helper returns a :class:`Column` built from Spark built-ins, so it stays
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred import model
from kindred.functions import numeric

DOC_TYPE = "map<string,variant>"

# The range of a microsecond timestamp: some 292,000 years on both sides of 1970.
MAX_EPOCH_MILLIS = 9.223372036854e15


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse(text: Column | str) -> Column:
    """JSON text -> document map; anything but exactly one JSON object
    (arrays, scalars, malformed text, a second value or any other text behind
    the first) gives NULL.  The parser by itself stops after the first value,
    so the text is parsed inside an object that ends with a check number of the
    text: only a text that is one value on its own leaves that number in place.

    A field written twice stays twice in the map, as parsed.  Lookups through
    :func:`get` / :func:`text` with ``unique=False`` and :func:`dedupe` give
    JSONB's answer (the last occurrence wins); :func:`unique_keys` tells which
    documents need that.  Keeping the parse this plain keeps the whole stage
    inside whole-stage code generation (no higher-order functions)."""
    t = _c(text)
    check = F.xxhash64(t)
    wrapped = F.from_json(F.concat(F.lit('{"d":['), t, F.lit('],"e":'), check.cast("string"), F.lit("}")),
                          f"d array<{DOC_TYPE}>, e bigint")
    one = F.filter(F.array(wrapped), lambda w: (w["e"] == check) & (F.size(w["d"]) == 1))
    return F.get(one, F.lit(0))["d"][0]


def unique_keys(m: Column | str) -> Column:
    """True when no top-level field occurs twice."""
    return F.size(F.array_distinct(F.map_keys(_c(m)))) == F.size(_c(m))


def get(m: Column | str, name: str, unique: Column | None = None) -> Column:
    """Field as VARIANT, last occurrence winning, on a map that may still
    hold repeated fields.  ``unique`` is the :func:`unique_keys` flag; where
    it is true a plain map lookup is used.  (The stage resolves repeats once
    with :func:`dedupe`, after which a plain ``m[name]`` is enough.)"""
    m = _c(m)
    pos = F.size(m) - F.array_position(F.reverse(F.map_keys(m)), F.lit(name)) + 1
    last = F.when(F.map_contains_key(m, name), F.element_at(F.map_values(m), pos.cast("int")))
    if unique is None:
        return last
    return F.when(unique, m[name]).otherwise(last)


def dedupe(m: Column | str, unique: Column | None = None) -> Column:
    """The document with repeated fields reduced to their last occurrence."""
    m = _c(m)
    keep_last = F.map_from_entries(F.filter(
        F.map_entries(m),
        lambda e, i: i == F.size(m) - F.array_position(F.reverse(F.map_keys(m)), e["key"])))
    return F.when(unique if unique is not None else unique_keys(m), m).otherwise(keep_last)


def object_without(m: Column | str, names: tuple[str, ...], unique: Column | None = None) -> Column:
    """VARIANT object of the document minus ``names`` (``data - 'a' - 'b'``),
    repeated fields resolved to their last occurrence."""
    return to_object(without(dedupe(m, unique), *names))


def has(m: Column | str, field: str) -> Column:
    """Field present, even when its value is JSON null (``data ? 'k'``)."""
    return F.map_contains_key(_c(m), field)


def field(m: Column | str, name: str) -> Column:
    """Field as VARIANT (``data -> 'k'``)."""
    return _c(m)[name]


def text(m: Column | str, name: str, unique: Column | None = None) -> Column:
    """Field as text (``data ->> 'k'``): JSON null and absent give NULL,
    strings their content, anything else its compact JSON text.  Without
    ``unique`` this is a plain lookup (first occurrence) - right for a
    de-duplicated document."""
    v = _c(m)[name] if unique is None else get(m, name, unique)
    return v.cast("string")


def without(m: Column | str, *names: str) -> Column:
    """Document with the given top-level fields removed (``data - 'k'``)."""
    if not names:
        return _c(m)
    return F.map_filter(_c(m), lambda k, v: ~k.isin(*names))


def to_object(m: Column | str) -> Column:
    """Document map -> VARIANT object (what a JSONB column stores)."""
    return F.to_variant_object(_c(m))


def n_keys(m: Column | str, *ignore: str) -> Column:
    """Number of distinct top-level fields, not counting ``ignore``."""
    m = _c(m)
    n = F.size(F.array_distinct(F.map_keys(m)))
    for name in ignore:
        n = n - F.map_contains_key(m, name).cast("int")
    return n


def keys(m: Column | str) -> Column:
    """Top-level field names (``jsonb_object_keys``)."""
    return F.map_keys(_c(m))


def elements_text(m: Column | str, name: str, unique: Column | None = None) -> Column:
    """Array field as ``ARRAY<STRING>``, element by element as text.

    NULL when the field is absent or not an array (a scalar, an object or JSON
    null), so callers can tell "no array" from "empty array"."""
    v = _c(m)[name] if unique is None else get(m, name, unique)
    return v.try_cast("array<string>")


def has_null(arr: Column) -> Column:
    """True when an array holds a NULL element."""
    return F.size(F.array_compact(arr)) < F.size(arr)


def epoch_millis_to_timestamp(text_col: Column) -> Column:
    """Numeric text of epoch milliseconds -> TIMESTAMP, rounded half-even to
    the microsecond like ``to_timestamp(ms::double precision / 1000)``.
    Non-numeric, infinite, NaN or out-of-range values give NULL."""
    ms = text_col.try_cast("double")
    ok = ms.isNotNull() & ~F.isnan(ms) & (F.abs(ms) <= F.lit(MAX_EPOCH_MILLIS))
    micros = F.bround((ms / F.lit(1000.0)) * F.lit(1000000.0), 0).cast("bigint")
    # whole milliseconds stay exact also where a double of microseconds is not
    whole = F.trim(text_col).try_cast("bigint")
    exact = F.trim(text_col).rlike(r"^[+-]?[0-9]+$")
    return F.when(ok, F.when(exact, F.timestamp_millis(whole)).otherwise(F.timestamp_micros(micros)))


def exact_score(text_col: Column) -> Column:
    """Numeric text -> score decimal, NULL where that type does not hold the
    number exactly (and for what is no number)."""
    return numeric.once(numeric.number_text(text_col), lambda number: F.when(
        numeric.has_fraction_within(number, model.SCORE_SCALE), number.try_cast(model.SCORE_TYPE)))


def expire_timestamp(text_col: Column, iso: bool = True) -> Column:
    """Expiry text -> TIMESTAMP: epoch millis first; with ``iso`` also ISO-8601
    strings (what a JSON export writes for date values).  NULL if neither."""
    numeric = epoch_millis_to_timestamp(text_col)
    if not iso:
        return numeric
    return F.coalesce(numeric, F.try_to_timestamp(text_col))


def imported_like(key: Column) -> Column:
    """``key LIKE '_imported_%:%'``."""
    return key.like(model.IMPORTED_LIKE)


# Java regex flags: (?s) lets '.' cross newlines and \z is the true end of
# input, matching the POSIX-style patterns of the source SQL.
IMPORTED_KEY_RE = r"(?s)^_imported_[^:]*:[^:]*\z"
IMPORTED_TYPE_RE = r"(?s)^_imported_(.*):"
IMPORTED_ID_RE = r"(?s):(.*)\z"


def imported_type(key: Column) -> Column:
    """Text between ``_imported_`` and the last ``:``."""
    return F.regexp_extract(key, IMPORTED_TYPE_RE, 1)


def imported_id_text(key: Column) -> Column:
    """Text after the first ``:``."""
    return F.regexp_extract(key, IMPORTED_ID_RE, 1)
