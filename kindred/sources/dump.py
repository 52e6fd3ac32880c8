"""Binary dumps of a document store: files of BSON documents, one after another.

Each document begins with its length, so a dump has no marks to split at.  A file
is read in byte ranges all the same:

1. every range looks for the first place where a chain of documents seems to
   begin, and walks from there to the first document behind the range;
2. a range's guess is right if it is where the range before it ended; the
   others (a chain of lengths inside some binary value, say) walk again from
   that place, until all ranges of a file join;
3. the documents that begin in a range are decoded by its task.

The table of ranges has a row per ``SPLIT_BYTES``; nothing else leaves the tasks.

Documents become the JSON text a one-shot export writes: dates as ISO-8601, object
ids as hex text, binary values as base64, numbers that are no number as null;
whole numbers keep all digits.  Decimals, timestamps and the other rare kinds
become ``{"$kind": text}``.  Where a file breaks off or holds no document, a line
that names file and place takes the documents' place and ends among the
rejects; reading goes on with the next range.

Files are listed by Spark and opened through ``pyarrow.fs``, so both must know the
path's scheme.
"""

from __future__ import annotations

import base64
import json
import math
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.session import scratch_path, ship_package

SPLIT_BYTES = 64 << 20
#: The largest document; a length above it is none.
MAX_DOCUMENT = 48 << 20
#: Documents in a row that make a guess.
CHAIN = 4

_INT, _LONG, _DOUBLE = struct.Struct("<i"), struct.Struct("<q"), struct.Struct("<d")
# Fixed values of the format: the element kinds.
_KINDS = frozenset((*range(0x01, 0x14), 0x7F, 0xFF))


# -- documents ------------------------------------------------------------------

class Malformed(ValueError):
    """No document at this place."""


def _cstring(data: memoryview, at: int) -> tuple[str, int]:
    end = bytes(data[at:at + 256]).find(0)
    if end < 0:
        end = bytes(data[at:]).find(0)
        if end < 0:
            raise Malformed("name without end")
    return str(data[at:at + end], "utf-8"), at + end + 1


def _number(x: float) -> str:
    if not math.isfinite(x):
        return "null"
    if x == int(x) and abs(x) < 1e21:
        return str(int(x))
    text = repr(x)
    return re.sub(r"e([+-])0*", lambda m: "e" + m[1], text if "e" not in text or "e-" in text or "e+" in text else text.replace("e", "e+"))


def _date(ms: int) -> str:
    days, rest = divmod(ms, 86_400_000)
    # Civil date from days (proleptic Gregorian), for years that no library date holds.
    z = days + 719_468
    era, doe = divmod(z, 146_097)
    yoe = (doe - doe // 1460 + doe // 36_524 - doe // 146_096) // 365
    doy = doe - (365 * yoe + yoe // 4 - yoe // 100)
    mp = (5 * doy + 2) // 153
    day, month = doy - (153 * mp + 2) // 5 + 1, mp + 3 if mp < 10 else mp - 9
    year = yoe + era * 400 + (month <= 2)
    text = f"{year:04d}" if 0 <= year <= 9999 else f"{'-' if year < 0 else '+'}{abs(year):06d}"
    return (f'"{text}-{month:02d}-{day:02d}T{rest // 3_600_000:02d}:{rest // 60_000 % 60:02d}:{rest // 1000 % 60:02d}'
            f'.{rest % 1000:03d}Z"')


def _decimal(data: bytes) -> str:
    """The text of a 128-bit decimal."""
    low, high = struct.unpack("<QQ", data)
    sign = "-" if high >> 63 else ""
    if high >> 58 & 0x1F == 0x1F:
        return "NaN"
    if high >> 58 & 0x1E == 0x1E:
        return sign + "Infinity"
    if high >> 61 & 3 == 3:  # digits beyond the format's: zero
        exponent, digits = (high >> 47 & 0x3FFF) - 6176, 0
    else:
        exponent, digits = (high >> 49 & 0x3FFF) - 6176, (high & (1 << 49) - 1) << 64 | low
        digits = digits if digits < 10 ** 34 else 0
    return f"{sign}{digits}" + (f"E{exponent:+d}" if exponent else "")


def _kind(name: str, text: str) -> str:
    return json.dumps({f"${name}": text}, ensure_ascii=False)


def _value(kind: int, data: memoryview, at: int) -> tuple[str | None, int]:
    """JSON text of the element at ``at`` (None: not written) and where it ends."""
    if kind == 0x01:
        return _number(_DOUBLE.unpack_from(data, at)[0]), at + 8
    if kind in (0x02, 0x0D, 0x0E):  # text, code, symbol
        n = _INT.unpack_from(data, at)[0]
        if n < 1 or at + 4 + n > len(data):
            raise Malformed("text length")
        return json.dumps(str(data[at + 4:at + 3 + n], "utf-8"), ensure_ascii=False), at + 4 + n
    if kind in (0x03, 0x04):
        return document_json(data, at, kind == 0x04)
    if kind == 0x05:
        n = _INT.unpack_from(data, at)[0]
        if n < 0 or at + 5 + n > len(data):
            raise Malformed("binary length")
        return f'"{base64.b64encode(data[at + 5:at + 5 + n]).decode()}"', at + 5 + n
    if kind == 0x06:  # undefined
        return None, at
    if kind == 0x07:
        return f'"{bytes(data[at:at + 12]).hex()}"', at + 12
    if kind == 0x08:
        return ("true" if data[at] else "false"), at + 1
    if kind == 0x09:
        return _date(_LONG.unpack_from(data, at)[0]), at + 8
    if kind == 0x0A:
        return "null", at
    if kind == 0x0B:
        pattern, at = _cstring(data, at)
        flags, at = _cstring(data, at)
        return _kind("regularExpression", f"/{pattern}/{flags}"), at
    if kind == 0x0C:
        n = _INT.unpack_from(data, at)[0]
        return _kind("dbPointer", bytes(data[at + 4 + n:at + 16 + n]).hex()), at + 16 + n
    if kind == 0x0F:  # code with scope
        n = _INT.unpack_from(data, at)[0]
        return _value(0x0D, data, at + 4)[0], at + n
    if kind == 0x10:
        return str(_INT.unpack_from(data, at)[0]), at + 4
    if kind == 0x11:
        return _kind("timestamp", str(struct.unpack_from("<Q", data, at)[0])), at + 8
    if kind == 0x12:
        return str(_LONG.unpack_from(data, at)[0]), at + 8
    if kind == 0x13:
        return _kind("numberDecimal", _decimal(bytes(data[at:at + 16]))), at + 16
    if kind in (0x7F, 0xFF):
        return _kind("maxKey" if kind == 0x7F else "minKey", "1"), at
    raise Malformed(f"kind {kind}")


def document_json(data: memoryview, at: int = 0, array: bool = False) -> tuple[str, int]:
    """JSON text of the document (or array) at ``at`` and where it ends."""
    try:
        end = at + _INT.unpack_from(data, at)[0]
        if end < at + 5 or end > len(data) or data[end - 1]:
            raise Malformed("document length")
        at, parts = at + 4, []
        while at < end - 1:
            kind = data[at]
            name, at = _cstring(data, at + 1)
            text, at = _value(kind, data, at)
            if array:
                parts.append("null" if text is None else text)
            elif text is not None:
                parts.append(f"{json.dumps(name, ensure_ascii=False)}:{text}")
        if at != end - 1:
            raise Malformed("element length")
    except (struct.error, IndexError, UnicodeDecodeError) as e:
        raise Malformed(str(e)) from e
    return ("[" + ",".join(parts) + "]") if array else ("{" + ",".join(parts) + "}"), end


def document_bytes(value: dict | list) -> bytes:
    """A document of JSON values; whole numbers beyond 64 bits become doubles."""
    out = bytearray()
    for name, v in (value.items() if isinstance(value, dict) else ((str(i), x) for i, x in enumerate(value))):
        key = name.encode() + b"\0"
        if v is None:
            out += b"\x0a" + key
        elif isinstance(v, bool):
            out += b"\x08" + key + bytes([v])
        elif isinstance(v, int) and -1 << 31 <= v < 1 << 31:
            out += b"\x10" + key + _INT.pack(v)
        elif isinstance(v, int) and -1 << 63 <= v < 1 << 63:
            out += b"\x12" + key + _LONG.pack(v)
        elif isinstance(v, (int, float)):
            out += b"\x01" + key + _DOUBLE.pack(float(v))
        elif isinstance(v, str):
            raw = v.encode() + b"\0"
            out += b"\x02" + key + _INT.pack(len(raw)) + raw
        elif isinstance(v, (dict, list)):
            out += (b"\x03" if isinstance(v, dict) else b"\x04") + key + document_bytes(v)
        else:
            raise TypeError(type(v).__name__)
    return _INT.pack(len(out) + 5) + bytes(out) + b"\0"


# -- ranges ---------------------------------------------------------------------

def _open(path: str):
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", path))
    return system.open_input_file(inner)


class _File:
    """Bytes of a file, read ahead in one buffer."""

    def __init__(self, path: str, size: int, ahead: int = 4 << 20):
        self._file, self.size, self._ahead = _open(path), size, ahead
        self._begin, self._data = 0, b""

    def bytes(self, at: int, n: int) -> memoryview:
        """Up to ``n`` bytes from ``at``; fewer at the end of the file."""
        n = max(0, min(n, self.size - at))
        if at < self._begin or at + n > self._begin + len(self._data):
            self._begin = at
            self._data = self._file.read_at(max(n, min(self._ahead, self.size - at)), at)
        return memoryview(self._data)[at - self._begin:at - self._begin + n]

    def length(self, at: int) -> int | None:
        """The length of the document that begins at ``at``, if one can."""
        head = self.bytes(at, 5)
        if len(head) < 5:
            return None
        n = _INT.unpack_from(head)[0]
        if not 5 <= n <= min(MAX_DOCUMENT, self.size - at) or head[4] not in _KINDS and not (n == 5 and head[4] == 0):
            return None
        return n if self.bytes(at + n - 1, 1)[0] == 0 else None

    def seems_to_begin(self, at: int) -> bool:
        for _ in range(CHAIN):
            if at == self.size:
                return True
            n = self.length(at)
            if n is None:
                return False
            at += n
        return True

    def walk(self, at: int, end: int) -> int | None:
        """The first document at or behind ``end``, None if the chain breaks before."""
        while at < end:
            n = self.length(at)
            if n is None:
                return None
            at += n
        return at


def _ranges(spark: SparkSession, paths: list[str], split_bytes: int) -> DataFrame:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        for status in at.getFileSystem(conf).globStatus(at) or []:
            inside = at.getFileSystem(conf).listStatus(status.getPath()) if status.isDirectory() else [status]
            rows += [(s.getPath().toString(), s.getLen()) for s in inside
                     if s.isFile() and s.getLen() and not re.match(r"[._]", s.getPath().getName())]
    files = spark.createDataFrame(rows, "file string, size long")
    cut = F.lit(split_bytes)
    return (files.select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / cut))).alias("part"))
            .select("file", "size", (F.col("part") * cut).alias("begin"),
                    F.least((F.col("part") + 1) * cut, F.col("size")).alias("end")))


def range_per_task(rows: DataFrame) -> DataFrame:
    """Each range a task of its own.  Hashes would deal several to some tasks, the more
    the more there are; rows this few are all in the sample that sets the bounds."""
    return rows.repartitionByRange(max(1, rows.count()), "file", "begin")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``start, stop`` per range: where its first document begins (as ``start`` says, else as it seems) and where the walk ends."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            f = _File(r["file"], r["size"])
            if r["start"] is None:
                r["start"] = 0 if r["begin"] == 0 else next((p for p in range(r["begin"], r["end"]) if f.seems_to_begin(p)), None)
            r["stop"] = None if r["start"] is None else max(r["start"], r["end"]) if r["start"] >= r["end"] else f.walk(r["start"], r["end"])
        yield pa.RecordBatch.from_pylist(rows, schema=_SCANNED)


_SCANNED = pa.schema([("file", pa.string()), ("size", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("start", pa.int64()),
                      ("stop", pa.int64())])
_SCANNED_DDL = "file string, size long, begin long, end long, start long, stop long"


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            f, at, out, held = _File(r["file"], r["size"]), r["start"], [], 0
            while at is not None and at < r["end"]:
                n = f.length(at)
                try:
                    if n is None:
                        raise Malformed("length")
                    text = document_json(f.bytes(at, n))[0]
                except Malformed as e:
                    text = f"no document at byte {at} of {r['file']}: {e}"
                out.append(text)
                held += len(text)
                at = None if n is None else at + n
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["data"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["data"])


def read_dump(spark: SparkSession, path: str | list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The documents of dump files (or folders of them) as ``data STRING`` rows."""
    ship_package(spark)
    paths = [path] if isinstance(path, str) else list(path)

    def stored(rows: DataFrame) -> DataFrame:
        place = scratch_path(spark, "dump-ranges")
        rows.write.parquet(place)
        return spark.read.schema(_SCANNED_DDL).parquet(place)

    ranges = _ranges(spark, paths, split_bytes).withColumn("start", F.lit(None).cast("long"))
    scanned = stored(range_per_task(ranges).mapInArrow(_scan, _SCANNED_DDL))
    order = Window.partitionBy("file").orderBy("begin")
    while True:
        # A range that breaks off leaves the next one its own guess; one without a guess waits for the walk before it.
        joined = scanned.withColumn("due", F.lag("stop").over(order))
        wrong = joined.filter("due is not null and due is distinct from start")
        if wrong.isEmpty():
            break
        again = range_per_task(wrong.withColumn("start", F.col("due")).drop("due", "stop")).mapInArrow(_scan, _SCANNED_DDL)
        scanned = stored(joined.filter("due is null or due is not distinct from start").drop("due").unionByName(again))
    return range_per_task(scanned).mapInArrow(_decode, "data string")


def write_dump(docs: DataFrame, path: str) -> int:
    """Write JSON objects (``data``) as dump files, one a partition, and return how
    many there were.  A file appears under its name when it is whole; a task
    that runs again writes the same file."""
    ship_package(docs.sparkSession)
    target = re.sub(r"^file:/*", "file:///", path.rstrip("/"))
    target = target if re.match(r"[a-z0-9]+:", target) else "file://" + target

    def write(batches):
        from pyarrow import fs
        system, inner = fs.FileSystem.from_uri(target)
        system.create_dir(inner, recursive=True)
        context = TaskContext.get()
        name, n = f"{inner}/part-{context.partitionId():05d}.bson", 0
        with system.open_output_stream(f"{inner}/.{context.taskAttemptId()}.tmp") as out:
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    out.write(document_bytes(json.loads(text)))
                    n += 1
        system.move(f"{inner}/.{context.taskAttemptId()}.tmp", name)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return docs.select("data").where(F.col("data").isNotNull()).mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0
