"""Numbers of any size, as column expressions over their text.

The score type of the source has no bounds.  A fixed decimal type has, so a
number is carried as text and, for sorting, ranges and ranks, as an order key: a
text whose byte order is the order of the numbers, whatever their sizes.

Order key: ``1`` for zero; else the value is ``0.d1d2d3... * 10**e`` with d1 not
0, and the key is ``2``, then ``e + 1000000`` in seven digits, then the digits without
trailing zeros.  For a negative number the key is ``0``, then ``1000000 - e``,
then the digits' complements to nine and ``~``, which sorts after all digits.
Equal numbers, however written, have one key.  Keys are ASCII, so Parquet's
column statistics prune files on them.

A number here is what JSON or a decimal literal writes: sign, digits with an
optional point, and an exponent of at most 131071 on either side of zero.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXPONENT = r"[+-]?0*(?:[0-9]{1,5}|1[0-2][0-9]{4}|130[0-9]{3}|1310[0-6][0-9]|13107[01])"
NUMBER = rf"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE]{_EXPONENT})?$"
_WHOLE = r"^[+-]?([0-9]*)"
_FRACTION = r"^[+-]?[0-9]*\.([0-9]*)"
_POWER = r"[eE](.*)$"
# Texts that are their own plain text, those of them of at least 1, and those with so many digits behind the point.
_PLAIN = r"^(?:-?(?:[1-9][0-9]*+(?:\.[0-9]++)?|0\.0*+[1-9][0-9]*+)|0(?:\.0++)?)\z"
_ABOVE_ONE = r"^[1-9][0-9]*+(?:\.[0-9]++)?\z"
_SHORT = r"^[+-]?[0-9]++(?:\.[0-9]{{0,{}}}+)?\z"
_OFFSET = 1_000_000
_ASCENDING, _DESCENDING = "0123456789", "9876543210"


def number_text(text: Column) -> Column:
    """The trimmed text if it is a number, else null."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(NUMBER), trimmed)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row.  Used several times in an
    expression it would be computed each time, and the generated method would grow
    beyond what the JVM compiles to machine code."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parts(number: Column) -> Column:
    """Whether below zero as written, digits before and behind the point, exponent."""
    power = F.when(number.rlike("[eE]"), F.regexp_extract(number, _POWER, 1).cast("int")).otherwise(F.lit(0))
    return F.struct(number.startswith("-").alias("below"), F.regexp_extract(number, _WHOLE, 1).alias("whole"),
                    F.regexp_extract(number, _FRACTION, 1).alias("fraction"), power.alias("power"))


def fraction_digits(number: Column) -> Column:
    """How many digits behind the point the number needs (below zero: it ends in
    so many zeros before it)."""
    def needed(p: Column) -> Column:
        digits = F.rtrim(F.concat(p["whole"], p["fraction"]), F.lit("0"))
        return F.when(digits == "", 0).otherwise(F.length(digits) - F.length(p["whole"]) - p["power"])

    return F.when(number.isNotNull(), once(_parts(number), needed))


def has_fraction_within(number: Column, most: int) -> Column:
    """Whether the number needs at most ``most`` digits behind the point."""
    return number.rlike(_SHORT.format(most)) | (fraction_digits(number) <= most)


def order_key(number: Column) -> Column:
    """The order key of a number's text (as :func:`number_text` gives it)."""
    whole = F.length(F.substring_index(number, ".", 1))
    above_one = F.concat(F.lit("2"), F.lpad((whole + _OFFSET).cast("string"), 7, "0"),
                         F.rtrim(F.translate(number, ".", ""), F.lit("0")))
    return F.when(number.rlike(_ABOVE_ONE), above_one).when(number.isNotNull(), once(_parts(number), _key_of_parts))


def _key_of_parts(p: Column) -> Column:
    below, whole, fraction, power = (p[c] for c in ("below", "whole", "fraction", "power"))
    written = F.concat(whole, fraction)
    leading = F.ltrim(written, F.lit("0"))
    digits = F.rtrim(leading, F.lit("0"))
    e = F.length(whole) - (F.length(written) - F.length(leading)) + power
    above = F.concat(F.lit("2"), F.lpad((e + _OFFSET).cast("string"), 7, "0"), digits)
    under = F.concat(F.lit("0"), F.lpad((F.lit(_OFFSET) - e).cast("string"), 7, "0"),
                     F.translate(digits, _ASCENDING, _DESCENDING), F.lit("~"))
    return F.when(digits == "", F.lit("1")).when(below, under).otherwise(above)


def plain_text(number: Column) -> Column:
    """The number without exponent, its fraction digits as written (``1.50e1``
    is ``15.0``, ``1e3`` is ``1000``, ``.5`` is ``0.5``, ``-0`` is ``0``)."""
    return F.when(number.rlike(_PLAIN), number).when(number.isNotNull(), once(_parts(number), _text_of_parts))


def _text_of_parts(p: Column) -> Column:
    below, whole, fraction, power = (p[c] for c in ("below", "whole", "fraction", "power"))
    written = F.concat(whole, fraction)
    scale = F.length(fraction) - power
    n = F.length(written)
    point = F.greatest(n - scale, F.lit(0))
    left = F.ltrim(F.when(scale <= 0, F.concat(written, F.repeat(F.lit("0"), -scale))).otherwise(F.substr(written, F.lit(1), point)),
                   F.lit("0"))
    right = F.when(scale <= 0, F.lit("")).otherwise(
        F.concat(F.repeat(F.lit("0"), F.greatest(scale - n, F.lit(0))), F.substr(written, point + 1)))
    body = F.concat(F.when(left == "", F.lit("0")).otherwise(left), F.when(right == "", right).otherwise(F.concat(F.lit("."), right)))
    zero = F.translate(body, "0.", "") == ""
    return F.concat(F.when(below & ~zero, F.lit("-")).otherwise(F.lit("")), body)


def key_text(key: Column) -> Column:
    """The number that an order key stands for, without exponent or trailing zeros."""
    below = key.startswith("0")
    e = F.when(below, F.lit(_OFFSET) - F.substr(key, F.lit(2), F.lit(7)).cast("int")).otherwise(
        F.substr(key, F.lit(2), F.lit(7)).cast("int") - _OFFSET)
    digits = F.when(below, F.translate(F.rtrim(F.substr(key, F.lit(9)), F.lit("~")), _DESCENDING, _ASCENDING)) \
        .otherwise(F.substr(key, F.lit(9)))
    n = F.length(digits)
    left = F.when(e <= 0, F.lit("0")).otherwise(F.rpad(F.substr(digits, F.lit(1), F.least(e, n)), e, "0"))
    right = F.when(e >= n, F.lit("")).otherwise(
        F.concat(F.repeat(F.lit("0"), F.greatest(-e, F.lit(0))), F.substr(digits, F.greatest(e, F.lit(0)) + 1)))
    body = F.concat(left, F.when(right == "", right).otherwise(F.concat(F.lit("."), right)))
    return F.when(key == "1", F.lit("0")).when(key.isNotNull(), F.concat(F.when(below, F.lit("-")).otherwise(F.lit("")), body))
