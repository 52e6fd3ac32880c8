"""Field texts as JSONB prints them, against a table of cases."""

import json

import pytest
from pyspark.sql import functions as F

from kindred.functions import jsonb as JB
from kindred.operators import catalog as C, stage as S, tables as TB

#: What a value's JSON text is as text (``->>``).
CASES = [
    ("1.10", "1.10"), ("1e3", "1000"), ("1E+2", "100"), ("-0", "0"), ("-0.0", "0.0"), ("1.50e1", "15.0"), ("1e-7", "0.0000001"),
    ("0.0000001", "0.0000001"), ("12345678901234567890123456789012345678901", "12345678901234567890123456789012345678901"),
    ("1234567890123456789012345678901234567890.125", "1234567890123456789012345678901234567890.125"), ("12", "12"), ("1.5", "1.5"),
    ("true", "true"), ("false", "false"), ("null", None), ('"x"', "x"), ('"1.10"', "1.10"), ('""', ""),
    ('{"b":1,"a":2}', '{"a": 2, "b": 1}'), ('{"bb":1,"c":[1,2.50,null]}', '{"c": [1, 2.50, null], "bb": 1}'),
    ('{"a":1,"a":2}', '{"a": 2}'), ("[ ]", "[]"), ("{ }", "{}"), ("[1,[2,{}]]", "[1, [2, {}]]"),
    ('{"é":1,"zz":"q\\"\\\\\\n\\u0001\\u00e9\\/"}', '{"zz": "q\\"\\\\\\n\\u0001é/", "é": 1}'), ('[true,false,"a b"]', '[true, false, "a b"]'),
]


def stage_of(spark, texts, **options):
    return S.stage(spark, spark.createDataFrame([(t,) for t in texts], "data string").repartition(3), **options)


@pytest.mark.parametrize("blank", ["", " ", "\n\t"])
def test_string_payloads(spark, blank):
    texts = [f'{{"_key":"k{i}",{blank}"value"{blank}:{blank}{j}{blank}}}' for i, (j, _) in enumerate(CASES)]
    st = stage_of(spark, texts)
    got = {r["_key"]: r["data"] for r in TB.legacy_string(st).collect()}
    assert got == {f"k{i}": t for i, (_, t) in enumerate(CASES) if t is not None}
    assert [(r["_key"], r["reason"]) for r in TB.rejects(st).collect()] == [(f"k{i}", "null_payload") for i, (_, t) in enumerate(CASES) if t is None]


def test_data_field(spark):
    st = stage_of(spark, [f'{{"_key":"k{i}","data":{j}}}' for i, (j, _) in enumerate(CASES)])
    assert {r["_key"]: r["data"] for r in TB.legacy_string(st).collect()} == {f"k{i}": t for i, (_, t) in enumerate(CASES) if t is not None}


def test_members_and_items(spark):
    values = "[" + ",".join(j for j, t in CASES if t is not None) + "]"
    want = [t for _, t in CASES if t is not None]
    st = stage_of(spark, [f'{{"_key":"s","members":{values}}}', f'{{"_key":"l","array":{values}}}', '{"_key":"n","members":[1.10,null]}',
                          '{"_key":"m","members":{"a":1.10}}', '{"_key":"e","array":[1e1,null]}'])
    assert sorted(r["member"] for r in TB.legacy_set(st).filter("_key = 's'").collect()) == sorted(want)
    lists = {r["_key"]: r["array"] for r in TB.legacy_list(st).collect()}
    assert lists == {"l": want, "e": ["10", None]}
    assert sorted((r["_key"], r["reason"]) for r in TB.rejects(st).collect()) == [("m", "members_not_array"), ("n", "null_member")]


def test_keys_scores_and_expiry(spark):
    st = stage_of(spark, ['{"_key":1.10,"value":1e2,"score":1e1,"expireAt":1.7e12}', '{"_key":[1, 2],"value":"x"}'])
    row = TB.legacy_zset(st).first()
    assert (row["_key"], row["value"], row["score_text"]) == ("1.10", "100", "10")
    assert {r["_key"]: r["ms"] for r in C.legacy_object(st).select("_key", F.unix_millis("expireAt").alias("ms")).collect()} \
        == {"1.10": 1700000000000, "[1, 2]": None}


def test_only_documents_that_need_it(spark):
    plain = ['{"_key":"a","value":"1.10"}', '{"_key":"a","value":1.5}', '{"_key":"a","members":["x","y"]}', '{"_key":"a","n":{"b":{"c":1}}}',
             '{"_key":"a","score":10,"value":"v"}', '{"_key":"a","score":0.25,"value":"1e3"}', '{"_key":"a","array":[]}']
    odd = ['{"_key":"a","value":1.10}', '{"_key":"a","value":1e3}', '{"_key":"a","value":{}}', '{"_key":"a","members":[[1]]}',
           '{"_key":"a","value":-0}', '{"_key":"a","score":' + "1" * 40 + "}"]
    rows = spark.createDataFrame([(t, t in odd) for t in plain + odd], "data string, odd boolean")
    assert rows.filter(JB.needs_jsonb(F.col("data")) != F.col("odd")).count() == 0
    assert S.classify(rows.select("data")).filter(F.col("texts").isNotNull()).count() == len(odd)


def test_variant_text(spark):
    st = stage_of(spark, ['{"_key":"k","value":1.10}'], json_text="variant")
    assert TB.legacy_string(st).first()["data"] == "1.1"
    with pytest.raises(ValueError):
        stage_of(spark, ["{}"], json_text="xml")


def test_join_mode_has_the_same_texts(spark):
    st = stage_of(spark, ['{"_key":"k","value":1.10}', '{"_key":"k","members":[1e2]}', '{"_key":"k","array":[2.50]}'])
    joined = TB.Joined(C.legacy_object(st), st)
    assert [r["data"] for r in joined.legacy_string().collect()] == ["1.10"]
    assert [r["member"] for r in joined.legacy_set().collect()] == ["100"]
    assert ["2.50"] in [r["array"] for r in joined.legacy_list().collect()]


def test_what_the_reader_takes(spark):
    """Texts that the two readers might not agree on stay with VARIANT's."""
    for text in ('{"_key":"k","value":1.10} x', '[1.10]', '{"_key":"k","value":NaN,"x":1.10}', None):
        assert JB.document_texts(text) is None
    deep = '{"_key":"k","value":' + "[" * 50_000 + "]" * 50_000 + "}"
    assert JB.document_texts(deep) is None
    assert json.loads(JB.jsonb_text({"a": ["é\x7f "]})) == {"a": ["é\x7f "]}
