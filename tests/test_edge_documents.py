"""Edge documents (FIXTURES.md section 3): routing, kinds and reject reasons."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from kindred.operators import catalog as C
from kindred.operators import integrity as I
from kindred.operators import stage as S
from kindred.operators import tables as TB

EDGE = [
    '{"_key":"a","value":"x"}',
    '{"_key":"b","data":5}',
    '{"_key":"c","value":"x","expireAt":1700000000000}',
    '{"_key":"d"}',
    '{"_key":"e","expireAt":1700000000000}',
    '{"_key":"f","name":"n"}',
    '{"_key":"g","value":"x","data":"y"}',
    '{"_key":"h","list":["p"]}',
    '{"_key":"i","array":["b",null,"a",1]}',
    '{"_key":"j","array":[]}',
    '{"_key":"k","members":["x",2,{"q":1}]}',
    '{"_key":"l","members":[]}',
    '{"_key":"m","members":["x",null]}',
    '{"_key":"n","members":"x"}',
    '{"_key":"o","value":null}',
    '{"_key":"p","score":1,"value":"x"}',
    '{"_key":"p","score":2,"value":"y","expireAt":1700000000000}',
    '{"_key":"q","score":null,"value":"x"}',
    '{"_key":"r","score":1}',
    '{"_key":"s","score":"12.5","value":"x"}',
    '{"_key":"t","score":"abc","value":"x"}',
    '{"_key":"u","value":"x","expireAt":"2024-01-01T00:00:00.000Z"}',
    '{"_key":"v","value":"x","expireAt":"soon"}',
    '{"_key":"_imported_user:7","name":"n","expireAt":1}',
    '{"_key":"_imported_user:8","score":1,"value":"x"}',
    '{"_key":"_imported_topic:1:2"}',
    '{"_key":"_imported_alien:3"}',
    '{"_key":"_imported_user:1.5"}',
    '{"_key":"ximportedy1:2"}',
    '{"_key":"_imported:_users","score":1,"value":"x"}',
    '{"name":"no key"}',
    '{"_key":null,"value":"x"}',
    '{"_key":"w","value":1,"value":2}',
    '[1,2]',
    '"text"',
    '{"_key":',
    '{"_id":"abc","_key":"y","value":"x"}',
    '{"_key":"z","score":1,"value":"x"}',
    '{"_key":"z","name":"n","k":1}',
    '{"_key":"aa","value":"x"}',
    '{"_key":"aa","value":"x"}',
    '{"_key":"ab","array":null}',
]

T0 = dt.datetime(2023, 11, 14, 22, 13, 20)  # 1700000000000 ms, UTC


def _collect(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is not None, str(x)) for x in t))


@pytest.fixture(scope="module")
def out(spark):
    docs = spark.createDataFrame([(d,) for d in EDGE], "data string")
    st = S.stage(spark, docs)
    cat = C.legacy_object(st)
    res = {
        "catalog": _collect(cat, "_key", "type", "expireAt"),
        "string": _collect(TB.legacy_string(st), "_key", "data"),
        "zset": _collect(TB.legacy_zset(st), "_key", "value", "score"),
        "set": _collect(TB.legacy_set(st), "_key", "member"),
        "list": _collect(TB.legacy_list(st), "_key", "array"),
        "hash": sorted((r["_key"], json.loads(r["data"])) for r in
                       TB.legacy_hash(st).select("_key", F.col("data").cast("string").alias("data"))
                       .collect()),
        "imported": sorted((r["type"], r["id"], json.loads(r["data"])) for r in
                           TB.legacy_imported(st).select("type", "id", F.col("data").cast("string")
                                                         .alias("data")).collect()),
        "rejects": _collect(TB.rejects(st), "_key", "reason"),
        "mixed": _collect(I.mixed_kind_keys(st), "_key", "kinds", "n_docs"),
        "dup_plain": _collect(I.dup_plain_keys(st), "_key", "n"),
        "dup_kv": _collect(I.dup_key_value(st), "_key", "value", "n"),
    }
    exact = TB.exact_children(cat, st)
    res["exact_hash"] = _collect(exact["legacy_hash"], "_key")
    res["exact_string"] = _collect(exact["legacy_string"], "_key", "data")
    res["exact_zset"] = _collect(exact["legacy_zset"], "_key", "value")
    res["pk"] = _collect(I.pk_violations({"legacy_object": cat, **TB.children(st)}), "table_name", "key", "n")
    return res


def cat_of(out, key):
    return [r for r in out["catalog"] if r[0] == key]


def rej_of(out, key):
    return [r[1] for r in out["rejects"] if r[0] == key]


def test_strings(out):
    assert cat_of(out, "a") == [("a", "string", None)]
    assert ("a", "x") in out["string"]
    assert ("b", "5") in out["string"]
    assert cat_of(out, "c") == [("c", "string", T0)]
    assert ("w", "2") in out["string"]  # last duplicate field wins
    assert ("y", "x") in out["string"]  # the store's _id is dropped by default


def test_hashes(out):
    hashes = dict(out["hash"])
    assert hashes["d"] == {} and cat_of(out, "d") == [("d", "hash", None)]
    assert hashes["e"] == {} and cat_of(out, "e") == [("e", "hash", T0)]
    assert hashes["f"] == {"name": "n"}
    assert hashes["g"] == {"value": "x", "data": "y"}
    assert hashes["h"] == {"list": ["p"]}


def test_lists(out):
    lists = dict(out["list"])
    assert lists["i"] == ["b", None, "a", "1"]
    assert lists["j"] == []
    assert cat_of(out, "ab") == [("ab", "list", None)] and "ab" not in lists
    assert rej_of(out, "ab") == ["array_not_array"]


def test_sets(out):
    assert sorted(m for k, m in out["set"] if k == "k") == ["2", "x", '{"q": 1}']
    assert cat_of(out, "l") == [("l", "set", None)]
    assert not [m for k, m in out["set"] if k == "l"]
    assert [m for k, m in out["set"] if k == "m"] == ["x"]
    assert rej_of(out, "m") == ["null_member"]
    assert cat_of(out, "n") == [("n", "set", None)] and rej_of(out, "n") == ["members_not_array"]


def test_null_payload(out):
    assert cat_of(out, "o") == [("o", "string", None)]
    assert rej_of(out, "o") == ["null_payload"]
    assert not [r for r in out["string"] if r[0] == "o"]


def test_sorted_sets(out):
    assert cat_of(out, "p") == [("p", "zset", T0)]
    assert [(v, float(s)) for k, v, s in out["zset"] if k == "p"] == [("x", 1.0), ("y", 2.0)]
    assert not cat_of(out, "q") and rej_of(out, "q") == ["null_score"]
    assert not cat_of(out, "r") and rej_of(out, "r") == ["null_value"]
    assert [float(s) for k, v, s in out["zset"] if k == "s"] == [12.5]
    assert cat_of(out, "t") == [("t", "zset", None)] and rej_of(out, "t") == ["bad_score"]


def test_expiry(out):
    assert cat_of(out, "u") == [("u", "string", dt.datetime(2024, 1, 1))]
    assert not cat_of(out, "v") and rej_of(out, "v") == ["bad_expire"]


def test_imported(out):
    imp = {(t, i): d for t, i, d in out["imported"]}
    assert imp[("user", 7)] == {"name": "n", "expireAt": 1}
    assert not cat_of(out, "_imported_user:7")
    assert ("user", 8) in imp and cat_of(out, "_imported_user:8") == [("_imported_user:8", "zset", None)]
    assert rej_of(out, "_imported_topic:1:2") == ["bad_imported_key"]
    assert rej_of(out, "_imported_alien:3") == ["bad_imported_type"]
    assert rej_of(out, "_imported_user:1.5") == ["bad_imported_id"]
    assert rej_of(out, "ximportedy1:2") == ["bad_imported_key"]
    assert cat_of(out, "_imported:_users") == [("_imported:_users", "zset", None)]
    assert len(imp) == 2


def test_document_rejects(out):
    reasons = sorted(r for k, r in out["rejects"] if k is None)
    assert reasons == ["missing_key", "not_an_object", "not_an_object", "not_an_object", "null_key"]


def test_mixed_and_duplicates(out):
    assert out["mixed"] == [("z", "hash,zset", 2)]
    assert cat_of(out, "aa") == [("aa", "string", None)] * 2
    assert [d for k, d in out["string"] if k == "aa"] == ["x", "x"]
    assert ("aa", 2) in out["dup_plain"]
    assert ("aa", "x", 2) in out["dup_kv"]
    assert ("legacy_object", "aa", 2) in out["pk"] and ("legacy_string", "aa", 2) in out["pk"]


def test_exact_join_differs_on_dirty_keys(out):
    # both z documents land in hash under the literal join, only one join-free
    assert out["exact_hash"].count(("z",)) == 2
    assert [k for k, _ in out["hash"]].count("z") == 1
    # duplicate keys are not squared: one row per document, reported by I2/I4
    assert [r for r in out["exact_string"] if r[0] == "aa"] == [("aa", "x")] * 2
    assert [r for r in out["exact_zset"] if r[0] == "z"] == [("z", "x")]


def test_literal_mode(spark):
    docs = spark.createDataFrame([(d,) for d in (
        '{"_key":"i","array":["b",null,"a",1]}',
        '{"_id":"abc","_key":"y","value":"x"}',
        '{"_key":"u","value":"x","expireAt":"2024-01-01T00:00:00.000Z"}',
    )], "data string")
    st = S.stage(spark, docs, persist=False, list_field="list", drop_fields=(), iso_expire=False)
    lists = dict(_collect(TB.legacy_list(st), "_key", "array"))
    assert lists == {"i": []}
    assert _collect(C.legacy_object(st).where("_key = 'y'"), "type") == [("hash",)]
    assert _collect(TB.rejects(st), "_key", "reason") == [("u", "bad_expire")]


def test_live_view_is_strict(spark):
    cat = spark.createDataFrame(
        [("x", "hash", T0), ("y", "hash", None), ("z", "hash", dt.datetime(2030, 1, 1))],
        "_key string, type string, expireAt timestamp")
    assert _collect(TB.live_objects(cat, 1700000000000), "_key") == [("y",), ("z",)]
    assert _collect(TB.live_objects(cat, 1699999999999), "_key") == [("x",), ("y",), ("z",)]


def test_sessions_empty(spark):
    s = TB.sessions_empty(spark)
    assert s.count() == 0 and s.columns == ["sid", "sess", "expire"]


def test_keep_needed_documents_gives_the_same_outputs(spark):
    docs = spark.createDataFrame([(d,) for d in EDGE], "data string")
    full = S.stage(spark, docs, persist=False)
    slim = S.stage(spark, docs, persist=False, keep_documents="needed")
    for f in (TB.legacy_string, TB.legacy_zset, TB.legacy_set, TB.legacy_list, TB.rejects, C.legacy_object):
        a = sorted(map(repr, f(full).collect()))
        b = sorted(map(repr, f(slim).collect()))
        assert a == b, f.__name__
    for f in (TB.legacy_hash, TB.legacy_imported):
        a = sorted(map(repr, f(full).select([F.col(c).cast("string") for c in f(full).columns]).collect()))
        b = sorted(map(repr, f(slim).select([F.col(c).cast("string") for c in f(slim).columns]).collect()))
        assert a == b, f.__name__
    assert slim.where("m is not null and kind <> 'hash' and imp_type is null").count() == 0


def test_exact_join_refuses_a_slim_stage(spark):
    docs = spark.createDataFrame([('{"_key":"z","score":1,"value":"x"}',)], "data string")
    slim = S.stage(spark, docs, persist=False, keep_documents="needed")
    with pytest.raises(ValueError):
        TB.exact_legacy_hash(C.legacy_object(slim), slim)
