"""JSON array files in any layout, read by many tasks.

Where a range of bytes begins inside an array cannot be told from the range
alone: it depends on whether a string is open there and how deep brackets are
nested.  Both follow from sums over the ranges before it:

1. every range counts its unescaped quotation marks (whether its first byte is
   escaped shows in the backslashes just before it) and how brackets open and
   close, once for beginning outside a string and once inside;
2. running sums per file, over a row per range, give each range's state;
3. with it, a task finds the commas and brackets between elements that lie in its
   range and passes on the elements behind them, as they are written; the last
   one is read on beyond the range.

An element that is not valid JSON ends among the rejects; so does a line for every
file whose array is not closed, has text around it, or is no array.  A byte order
mark is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.session import scratch_path, ship_package
from kindred.sources.dump import _File, _ranges, range_per_task

#: Bytes looked at in one go.
BLOCK = 1 << 22
#: Bytes of a range at most, whatever Spark's splits: what a task parses is many times its text.
RANGE_BYTES = 1 << 25
_QUOTE, _BACKSLASH, _COMMA = ord('"'), ord("\\"), ord(",")
_OPEN, _CLOSE = (ord("["), ord("{")), (ord("]"), ord("}"))
_BLANK = b" \t\r\n"

_STEP = np.zeros(256, np.int8)
_STEP[list(_OPEN)], _STEP[list(_CLOSE)] = 1, -1


def escaped_at(f: _File, at: int) -> bool:
    """Whether an odd number of backslashes stands before ``at``."""
    n, size = 0, 64
    while at - n > 0:
        size = min(size * 2, at - n)
        before = bytes(f.bytes(at - n - size, size))
        run = len(before) - len(before.rstrip(b"\\"))
        n += run
        if run < size:
            break
    return n % 2 == 1


def quotes(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Places of the quotation marks that no backslash escapes, and whether the
    byte behind ``data`` is escaped."""
    slashes = np.flatnonzero(data == _BACKSLASH)
    taken = np.zeros(len(data) + 1, bool)  # escaped bytes
    taken[0] = escaped
    if len(slashes):
        # In a run of backslashes every second one escapes the next byte.
        first = np.concatenate(([True], np.diff(slashes) > 1))
        begin = np.maximum.accumulate(np.where(first, np.arange(len(slashes)), 0))
        place = np.arange(len(slashes)) - begin
        shift = (slashes[begin] == 0) & escaped  # the run's first backslash is itself escaped
        taken[slashes[(place + shift) % 2 == 0] + 1] = True
    marks = np.flatnonzero(data == _QUOTE)
    return marks[~taken[marks]], bool(taken[len(data)])


def blocks(f: _File, begin: int, end: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``place, bytes, strings``: the latter counts the quotation marks up to and
    including each byte."""
    escaped = escaped_at(f, begin)
    for at in range(begin, end, BLOCK):
        data = np.frombuffer(f.bytes(at, min(BLOCK, end - at)), np.uint8)
        marks, escaped = quotes(data, escaped)
        count = np.zeros(len(data), np.int64)
        count[marks] = 1
        yield at, data, np.cumsum(count)


_COUNTED = "file string, size long, begin long, end long, n_quotes long, outside long, inside long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            r |= {"n_quotes": 0, "outside": 0, "inside": 0}
            for _, data, strings in blocks(_File(r["file"], r["size"]), r["begin"], r["end"]):
                step = _STEP[data].astype(np.int64)
                open_ = (strings + r["n_quotes"]) % 2 == 1
                r["outside"] += int(step[~open_].sum())
                r["inside"] += int(step[open_].sum())
                r["n_quotes"] += int(strings[-1])
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.string() if c == "file" else pa.int64())
                                          for c in ("file", "size", "begin", "end", "n_quotes", "outside", "inside")],
                                         names=["file", "size", "begin", "end", "n_quotes", "outside", "inside"])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            out, held = [], 0
            for text in _range_elements(r):
                out.append(text)
                held += len(text)
                if held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["data"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["data"])


def _range_elements(r: dict) -> Iterator[str]:
    """Texts of the elements whose opening bracket or comma lies in the range, and
    what is wrong with the file there."""
    f, size, name = _File(r["file"], r["size"]), r["size"], r["file"]

    def text(parts: list[bytes]) -> str:
        return b"".join(parts).strip(_BLANK).decode("utf-8", "replace")

    mark = 3 if f.bytes(0, 3) == b"\xef\xbb\xbf" else 0  # byte order mark

    def around_array(at: int, raw: bytes) -> bytes:
        return raw[max(0, mark - at):]

    n_quotes, depth = r["quotes_before"], r["depth_before"]
    parts: list[bytes] | None = None  # of the element that is being read
    outer, first = [], False  # text around the array; whether the element follows the opening bracket
    for at, data, strings in blocks(f, r["begin"], size):
        beyond = at >= r["end"]
        if beyond and parts is None:
            break
        raw = data.tobytes()
        outside = (strings + n_quotes) % 2 == 0
        step = np.where(outside, _STEP[data], 0)
        deep = depth + np.cumsum(step)  # behind each byte
        cut = (deep == 1) & outside & ((data == _COMMA) | (step == 1)) | (deep == 0) & (step == -1)
        done = 0
        for i in np.flatnonzero(cut).tolist():
            here = at + i
            if parts is not None:
                parts.append(raw[done:i])
                found = text(parts)
                if found or not (first and data[i] != _COMMA):  # an array without elements has none
                    yield found
                parts = None
            elif depth == 0 and data[i] == _OPEN[0] and step[i] == 1:
                outer.append(around_array(at + done, raw[done:i]))
            done = i + 1
            if data[i] in _CLOSE:
                depth = 0
                continue
            depth = 1
            if here >= r["end"]:
                break
            parts, first = [], step[i] == 1
        else:
            if parts is not None:
                parts.append(raw[done:])
            elif deep[-1] == 0 and not beyond:
                outer.append(around_array(at + done, raw[done:min(len(raw), r["end"] - at)]))
            n_quotes += int(strings[-1])
            depth = int(deep[-1])
            continue
        break
    if parts is not None and (rest := text(parts)):
        yield rest  # the file ends inside an element
    if around := text(outer):
        yield f"text outside the array in {name}: {around[:200]}"
    if r["end"] == size and r["depth_after"] != 0:
        yield f"array not closed in {name}"


def read_arrays(spark: SparkSession, paths: list[str], split_bytes: int) -> DataFrame:
    """The elements of JSON array files as ``data STRING`` rows."""
    ship_package(spark)

    place = scratch_path(spark, "array-ranges")
    range_per_task(_ranges(spark, paths, min(split_bytes, RANGE_BYTES))).mapInArrow(_count, _COUNTED).write.parquet(place)
    counted = spark.read.schema(_COUNTED).parquet(place)
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    state = counted.withColumn("quotes_before", F.coalesce(F.sum("n_quotes").over(before), F.lit(0)))
    state = state.withColumn("change", F.when(F.col("quotes_before") % 2 == 0, F.col("outside")).otherwise(F.col("inside")))
    state = (state.withColumn("depth_before", F.coalesce(F.sum("change").over(before), F.lit(0)))
             .withColumn("depth_after", F.col("depth_before") + F.col("change")))
    return range_per_task(state).mapInArrow(_elements, "data string")
