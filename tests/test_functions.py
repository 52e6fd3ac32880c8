"""Per-expression tests of the document helpers (S1-S25) on hand-written documents."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from kindred.functions import jsondoc as J


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        ('{"_key":"a","s":"x","n":5,"f":1.5,"z":null,"o":{"b":1,"a":[1,"x"]},"arr":["p",null,2]}',),
        ('{"_key":"b","v":1,"v":2,"w":3}',),
        ('[1,2]',),
        ('{"_key":',),
    ]
    return spark.createDataFrame(rows, "data string").select(J.parse("data").alias("m")).collect()


def one(spark, doc, col):
    df = spark.createDataFrame([(doc,)], "data string").select(J.parse("data").alias("m"))
    return df.select(col.alias("r")).collect()[0]["r"]


def test_parse_non_objects_are_null(docs):
    assert docs[2]["m"] is None and docs[3]["m"] is None


def test_text_of_each_json_type(spark):
    d = '{"_key":"a","s":"x","n":5,"f":1.5,"z":null,"o":{"b":1,"a":[1,"x"]},"arr":["p",null,2]}'
    m = F.col("m")
    assert one(spark, d, J.text(m, "s")) == "x"
    assert one(spark, d, J.text(m, "n")) == "5"
    assert one(spark, d, J.text(m, "f")) == "1.5"
    assert one(spark, d, J.text(m, "z")) is None          # JSON null
    assert one(spark, d, J.text(m, "missing")) is None    # absent
    assert json.loads(one(spark, d, J.text(m, "o"))) == {"a": [1, "x"], "b": 1}
    assert one(spark, d, J.text(m, "arr")) == '["p",null,2]'


def test_has_is_true_for_json_null(spark):
    d = '{"_key":"a","z":null}'
    assert one(spark, d, J.has(F.col("m"), "z")) is True
    assert one(spark, d, J.has(F.col("m"), "y")) is False


def test_without_and_key_counts(spark):
    d = '{"_key":"a","expireAt":1,"_id":"x","v":2}'
    m = F.col("m")
    assert sorted(one(spark, d, J.keys(J.without(m, "_key", "expireAt")))) == ["_id", "v"]
    assert one(spark, d, J.n_keys(m, "expireAt", "_id")) == 2
    assert one(spark, '{"_key":"a","v":1,"v":2}', J.n_keys(m)) == 2   # distinct fields


def test_elements_text(spark):
    m = F.col("m")
    assert one(spark, '{"a":["p",null,2,{"q":1}]}', J.elements_text(m, "a")) == ["p", None, "2", '{"q":1}']
    assert one(spark, '{"a":"p"}', J.elements_text(m, "a")) is None
    assert one(spark, '{"a":null}', J.elements_text(m, "a")) is None
    assert one(spark, '{"a":[]}', J.elements_text(m, "a")) == []
    assert one(spark, '{"a":[null]}', J.has_null(J.elements_text(m, "a"))) is True


def test_repeated_fields_last_wins(spark):
    d = '{"_key":"b","v":1,"v":2,"w":3}'
    m = F.col("m")
    assert one(spark, d, J.unique_keys(m)) is False
    assert one(spark, d, J.text(m, "v", J.unique_keys(m))) == "2"
    deduped = one(spark, d, J.dedupe(m).cast("map<string,string>"))
    assert deduped == {"_key": "b", "v": "2", "w": "3"}
    assert one(spark, '{"_key":"c","v":1}', J.unique_keys(m)) is True


def test_expiry_parsing(spark):
    def ts(text, iso=True):
        return spark.range(1).select(J.expire_timestamp(F.lit(text), iso).alias("t")).collect()[0]["t"]
    assert ts("1700000000000") == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert ts("1700000000000.5") == dt.datetime(2023, 11, 14, 22, 13, 20, 500)
    assert ts("2024-01-01T00:00:00.000Z") == dt.datetime(2024, 1, 1)
    assert ts("2024-01-01T00:00:00.000Z", iso=False) is None
    assert ts("soon") is None and ts("NaN") is None and ts("1e300") is None


def test_imported_key_patterns(spark):
    def ext(key):
        r = spark.range(1).select(
            J.imported_like(F.lit(key)).alias("like"),
            F.lit(key).rlike(J.IMPORTED_KEY_RE).alias("ok"),
            J.imported_type(F.lit(key)).alias("t"),
            J.imported_id_text(F.lit(key)).alias("i")).collect()[0]
        return r["like"], r["ok"], r["t"], r["i"]
    assert ext("_imported_user:7") == (True, True, "user", "7")
    assert ext("_imported_topic:1:2") == (True, False, "topic:1", "1:2")     # T7: greedy vs first colon
    assert ext("ximportedy1:2") == (True, False, "", "2")                     # T6: '_' is a wildcard
    assert ext("_imported:_users") == (False, False, "", "_users")
    assert ext("_imported_user:1\n2") == (True, True, "user", "1\n2")          # T8: '.' crosses newlines
