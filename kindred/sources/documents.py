"""Reading and writing document collections (one JSON object per row).

Every reader returns a DataFrame with a single ``data STRING`` column holding
the document's JSON text; parsing happens once, later, in the stage step.

Formats
  ``jsonl`` / ``text``  JSON Lines: one document per line.  Splittable, so a
                        large file is read by many tasks.  The recommended
                        interchange format.
  ``json``              A JSON array of documents per file, in any layout; many
                        tasks read one file (:mod:`kindred.sources.arrays`).
                        Elements are passed on as they are written; one that
                        is not valid JSON ends among the rejects, as does a
                        line for every file whose array is not closed.
                        Compressed files, and file systems that only Spark
                        opens, go through Spark's text reader, which splits
                        arrays indented by two blanks (what a one-shot export
                        writes) and reads others whole.
  ``bson``              Dumps of a document store (:mod:`kindred.sources.dump`).
  ``parquet``           A table with a ``data`` column (string or variant).
  anything else         Passed through to ``spark.read.format(...)``; when the
                        result has no ``data`` column its rows are serialised
                        with ``to_json(struct(*))``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.sources.arrays import read_arrays
from kindred.sources.dump import read_dump

# Paths that ``pyarrow.fs`` opens and whose files are not compressed.
_OPENS = re.compile(r"(?:(?:file|hdfs|s3|gs):|(?![a-z0-9+]+:))(?!.*\.(?:gz|bz2|zst|lz4|snappy|deflate)\Z)", re.S)


def _as_text(col: F.Column, dtype: T.DataType) -> F.Column:
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.VariantType):
        return col.cast("string")
    return F.to_json(col)


def read_documents(spark: SparkSession, path: str | list[str], fmt: str = "jsonl",
                   column: str = "data", partitions: int | None = None,
                   **options: str) -> DataFrame:
    """Read a document collection as ``data STRING`` rows."""
    paths = [path] if isinstance(path, str) else list(path)
    fmt = fmt.lower()
    if fmt in ("jsonl", "text", "ndjson"):
        df = spark.read.options(**options).text(paths)
        out = df.select(F.col("value").alias("data")).where(F.trim("data") != "")
    elif fmt == "json":
        if not options and all(_OPENS.match(p) for p in paths):
            from kindred.operators.stage import _split_bytes
            out = read_arrays(spark, paths, _split_bytes(spark))
        else:
            out = _read_arrays(spark, paths, options)
    elif fmt == "bson":
        out = read_dump(spark, paths, **{k: int(v) for k, v in options.items()})
    elif fmt == "parquet":
        df = spark.read.options(**options).parquet(*paths)
        out = df.select(_as_text(F.col(column), df.schema[column].dataType).alias("data"))
    else:
        reader = spark.read.format(fmt).options(**options)
        df = reader.load(paths if len(paths) > 1 else paths[0])
        if column in df.columns:
            out = df.select(_as_text(F.col(column), df.schema[column].dataType).alias("data"))
        else:
            out = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("data"))
    if partitions:
        out = out.repartition(partitions)
    elif fmt not in ("json", "bson"):
        # a compressed JSON Lines file is unsplittable: spread few big inputs
        from kindred.operators.stage import spread
        out = spread(spark, out)
    return out


# Where one document of a two-blank array ends and the next begins.  Text inside a
# document cannot hold it: line ends in strings are escaped, and what is nested
# deeper is indented further.
_BETWEEN = "\n  },\n"


def _read_arrays(spark: SparkSession, paths: list[str], options: dict[str, str]) -> DataFrame:
    pieces = (spark.read.options(**options).option("lineSep", _BETWEEN).text(paths)
              .withColumn("file", F.input_file_name()))
    v = F.col("value")
    # Brackets of the array itself stand at the start of a line; those of a document's fields are indented.
    first = v.rlike(r"\A\[")
    one_line = v.rlike(r"\A\[[ \t]*[^ \t\r\n]")
    last = v.rlike(r"\n\]\s*\z") | (one_line & v.rlike(r"\]\s*\z"))
    # A piece is the inside of an array again once brackets go and the closing brace that was cut off comes back.
    body = F.when(first, F.regexp_replace(v, r"\A\[", "")).otherwise(v)
    closed = pieces.select("file", v.alias("piece"), last.alias("last"), body.alias("body")).withColumn(
        "body", F.when(F.col("last"), F.regexp_replace("body", r"\]\s*\z", ""))
        .otherwise(F.concat("body", F.lit("\n  }"))))
    # The check number behind the text shows that the parser read all of it.
    check = F.xxhash64("body")
    wrapped = F.from_json(F.concat(F.lit('{"d":['), "body", F.lit('],"e":'), check.cast("string"), F.lit("}")),
                          "d array<variant>, e bigint")
    listed = closed.select("file", "piece", "body", check.alias("check"), wrapped.alias("w")).select(
        "piece", "body", F.when(F.col("w.e") == F.col("check"), F.col("w.d")).alias("docs"))
    # One document: its own text, numbers as written.  Several: each one's text.  None: the piece, a reject later.
    texts = F.when(F.col("docs").isNull(), F.array("piece")).when(F.size("docs") == 1, F.array(F.trim("body"))) \
        .otherwise(F.transform("docs", lambda d: d.cast("string")))
    out = listed.select(F.explode(texts).alias("data"))
    open_files = (pieces.groupBy("file").agg(F.max(last).alias("closed"), F.max(F.trim("value") != "").alias("any"))
                  .filter(F.col("any") & ~F.col("closed")))
    return out.unionByName(open_files.select(F.concat(F.lit("array not closed in "), "file").alias("data")))


def write_array(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a collection as JSON arrays, one per partition, in the layout that
    :func:`read_documents` splits: two blanks before a document, its closing
    brace on a line of its own.  Only JSON objects of one line have a place in
    it; other texts are written as they are, each as an element of its own."""
    t = F.trim("data")
    inner = t.rlike(r"(?s)^\{.+\}\z")
    element = F.when(inner, F.concat(F.lit("  {\n    "), F.expr("substring(trim(data), 2, length(trim(data)) - 2)"), F.lit("\n  }"))) \
        .otherwise(F.concat(F.lit("  "), t))
    rows = docs.where(F.col("data").isNotNull()).select(element.alias("value"))

    def lines(batches):
        import pyarrow as pa
        held = None  # an element ends with a comma or closes the array
        for b in batches:
            out = []
            for v in b.column(0).to_pylist():
                if held is not None:
                    out.append(held + ",")
                held = v if held is not None else "[\n" + v
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held + "\n]"])], names=["value"])

    rows.mapInArrow(lines, "value string").write.mode(mode).text(path)


def write_documents(docs: DataFrame, path: str, fmt: str = "jsonl",
                    mode: str = "errorifexists", compression: str | None = None) -> None:
    """Write a collection: JSON Lines (one file per partition) or parquet."""
    fmt = fmt.lower()
    w = docs.select("data").write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if fmt in ("jsonl", "text", "ndjson"):
        w.text(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        w.format(fmt).save(path)
