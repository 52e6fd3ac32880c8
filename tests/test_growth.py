"""What a task computes and holds stays small however large the tables are."""

import contextlib
import io
import json
import random
import re

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from kindred.functions import jsonb as JB, numeric as N
from kindred.operators import stage as S, tables as TB
from kindred.sources.documents import read_documents
from kindred.sources.dump import document_bytes, read_dump

# The patterns as first written, with runs that are tried again from every length.
PLAIN_ODD = (r"[:,\[]\s*(?:-0(?![0-9.])|-?[0-9]+\.[0-9]*0(?![0-9])|-?0\.000000|-?[0-9]+(?:\.[0-9]+)?[eE]|-?[0-9.]{38})"
             r'|"(?:' + "|".join(JB.TEXT_FIELDS) + r')"\s*:\s*[\[{]|[\[,]\s*[\[{]')
JIT_LIMIT = 8000  # bytes: the JVM compiles no larger method to machine code


def explained(df, mode):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def method_sizes(df):
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", explained(df, "codegen"))]


def test_parts_of_a_number_are_found_once(spark):
    number = F.col("n")
    for found in (N.plain_text(number), N.order_key(number), N.fraction_digits(number)):
        plan = explained(spark.createDataFrame([("1",)], "n string").select(found.alias("x")), "simple")
        assert plan.lower().count("regexp_extract(") <= 3


def test_generated_methods_are_compiled(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(json.dumps({"_key": "z", "value": "a", "score": 1.5}),)], "data string").write.parquet(path)
    docs = spark.read.parquet(path)
    assert max(method_sizes(S.classify(docs))) < JIT_LIMIT
    assert max(method_sizes(TB.legacy_zset(S.stage(spark, docs)))) < JIT_LIMIT


def test_needs_jsonb_as_the_plain_pattern(spark):
    rnd = random.Random(3)
    bits = ['"_key"', '"x"', ":", ",", "[", "{", "]", "}", " ", "-", "0", "1.50", ".", "0.0000001", "e", "E5", "12", "\n", "9" * 20]
    texts = ["{" * (k % 2) + "".join(rnd.choice(bits) for _ in range(rnd.randrange(12))) for k in range(20000)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").repartition(8)
    both = df.select(JB.needs_jsonb(F.col("t")).alias("now"), F.col("t").rlike(PLAIN_ODD).alias("plain"))
    n = both.groupBy("plain").count().collect()
    assert both.where("not (now <=> plain)").count() == 0 and all(r["count"] > 2000 for r in n if r["plain"] is not None)


def test_stage_is_written_without_sorting_by_kind(spark, monkeypatch):
    seen, write = [], DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        seen.append(int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    docs = [{"_key": "z", "value": "a", "score": 1}, {"_key": "s", "members": ["a"]}, {"_key": "h", "a": 1, "b": 2}, {"x": 1}]
    st = S.stage(spark, spark.createDataFrame([(json.dumps(d),) for d in docs], "data string").coalesce(1))
    assert seen == [S.FOLDERS_AT_ONCE] and S.FOLDERS_AT_ONCE >= 6  # five kinds and none
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before
    assert sorted((r["kind"] or "", r["_key"] or "") for r in st.collect()) == [("", ""), ("hash", "h"), ("set", "s"), ("zset", "z")]


def per_partition(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_every_range_of_arrays_is_a_task(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"{k:02d}.json").write_text(json.dumps([{"_key": f"k{k}"}]))
    assert per_partition(read_documents(spark, str(tmp_path), "json")) == [1] * 40


def test_every_range_of_dumps_is_a_task(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"{k:02d}.bson").write_bytes(document_bytes({"_key": f"k{k}"}))
    assert per_partition(read_dump(spark, str(tmp_path))) == [1] * 40
