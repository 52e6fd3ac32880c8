"""Inputs that must never vanish without a trace: each is in an output or in the rejects."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kindred.functions import jsondoc as J
from kindred.operators import catalog as C, stage as S, tables as TB
from kindred.sources.documents import read_documents
from kindred.streaming.ingest import read_stage, stream_stage


def stage_of(spark, texts, **options):
    return S.stage(spark, spark.createDataFrame([(t,) for t in texts], "data string"), persist=False, **options)


def reasons(st):
    return sorted((r["_key"], r["reason"]) for r in TB.rejects(st).collect())


@pytest.mark.parametrize("tail", [' {"_key":"b"}', " x", ',{"_key":"b"}', "] x", '],"e":1} x'])
def test_text_behind_a_document(spark, tail):
    st = stage_of(spark, ['{"_key":"a","value":"1"}' + tail])
    assert [r["reason"] for r in TB.rejects(st).collect()] == ["not_an_object"]


def test_expiry_range(spark):
    ends = {"a": 8640000000000000, "b": 9223372036854000, "c": -62135596800000}
    st = stage_of(spark, [json.dumps({"_key": k, "value": "x", "expireAt": v}) for k, v in ends.items()]
                  + ['{"_key":"d","value":"x","expireAt":1e300}'])
    got = {r["_key"]: r["ms"] for r in C.legacy_object(st).select("_key", F.unix_millis("expireAt").alias("ms")).collect()}
    assert got == ends and reasons(st) == [("d", "bad_expire")]


def test_scores_are_exact(spark):
    texts = ["1e-13", "0.12345678901234567", "0.1234567890123456789", "1e30", "12345678901234567890", "x", "1.500", "NaN"]
    st = stage_of(spark, [json.dumps({"_key": "z", "value": t, "score": t}) for t in texts])
    rows = TB.legacy_zset(st).collect()
    assert {r["value"]: Decimal(r["score_text"]) for r in rows} == {t: Decimal(t) for t in texts if t not in ("x", "NaN")}
    # the decimal beside them is exact or null
    assert {r["value"]: r["score"] for r in rows if r["score"] is not None} \
        == {t: Decimal(t) for t in ("1e-13", "0.12345678901234567", "12345678901234567890", "1.500")}
    assert [r["reason"] for r in TB.rejects(st).collect()] == ["bad_score"] * 2


DOCS = [{"_key": f"k{i}", "array": ["x },\n y", [1]], "n": {"a": [{"b": 1}, {}]}} for i in range(300)]


@pytest.mark.parametrize("indent", [2, 4, None])
def test_array_file(spark, tmp_path, indent):
    (tmp_path / "a.json").write_text(json.dumps(DOCS, indent=indent))
    got = [json.loads(r["data"]) for r in read_documents(spark, str(tmp_path / "a.json"), "json").collect()]
    assert sorted(got, key=lambda d: d["_key"]) == sorted(DOCS, key=lambda d: d["_key"])


def test_array_file_is_split(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(DOCS * 20, indent=2))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = read_documents(spark, str(tmp_path / "a.json"), "json")
        assert df.rdd.getNumPartitions() > 4 and df.count() == 6000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_array_of_other_values(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{}, 5, [1, {"a": 2}], {"_key": "z"}, {"_key": "w", "o": {}}], indent=2))
    assert read_documents(spark, str(tmp_path / "a.json"), "json").count() == 5


@pytest.mark.parametrize("cut", [40, None])
def test_truncated_array_file(spark, tmp_path, cut):
    text = json.dumps(DOCS[:9], indent=2)
    text = text[:-cut] if cut else text[:text.index("\n  },\n", 300) + 6]
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json").write_text(json.dumps(DOCS[100:103], indent=2))
    st = S.stage(spark, read_documents(spark, str(tmp_path), "json"))
    whole = text.count('"_key"') - (1 if cut else 0)
    assert C.legacy_object(st).count() == whole + 3
    lost = [r["data"] for r in TB.rejects(st).collect()]
    assert len(lost) == (2 if cut else 1) and any("array not closed in" in t for t in lost)


def test_stream_restart(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for k in "ab":
        (src / f"{k}.jsonl").write_text(json.dumps({"_key": k, "value": "1"}) + "\n")
        stream_stage(spark, str(src), out, max_files_per_trigger=1).awaitTermination()
    assert sorted(r["_key"] for r in read_stage(spark, out).collect()) == ["a", "b"]


def test_join_mode(spark):
    texts = ['{"_key":"k","value":"1"}', '{"_key":"k","name":"x","more":1}', '{"_key":"one","value":"2"}']
    st = S.stage(spark, spark.createDataFrame([(t,) for t in texts], "data string"))
    joined = TB.Joined(C.legacy_object(st), st)
    assert sorted(map(tuple, joined.legacy_string().select("_key", "data").collect())) == [("k", "1"), ("one", "2")]
    assert joined.legacy_hash().count() == 2
    assert [tuple(r) for r in joined.rejects().collect()] == [("k", "legacy_string", "null_payload")]
    assert [r["_key"] for r in joined.mixed.collect()] == ["k"]
    plan = joined.legacy_string()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_join_mode_refuses_a_stage_without_its_documents(spark):
    text = [('{"_key":"k","value":"1"}',)]
    slim = S.stage(spark, spark.createDataFrame(text, "data string"), keep_documents="needed")
    full = S.stage(spark, spark.createDataFrame(text * 5, "data string"))
    with pytest.raises(ValueError):
        TB.mixed_keys(full.unionByName(slim))


def test_one_json_object(spark):
    rows = [(" {\"a\":1} ", True), ("{}", True), ("[1]", False), ("3", False), (None, False), ("", False), ("{\"a\":", False)]
    df = spark.createDataFrame(rows, "data string, ok boolean")
    assert df.filter(J.parse("data").isNotNull() != F.col("ok")).count() == 0
