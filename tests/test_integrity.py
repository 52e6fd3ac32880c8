"""Integrity jobs on a relational fixture (FIXTURES.md section 4)."""

import datetime as dt

from pyspark.sql import functions as F

from kindred.operators import integrity as I

T = dt.datetime(2024, 1, 1)


def _fixture(spark):
    catalog = spark.createDataFrame(
        [("p", "zset", T), ("a", "string", None), ("d", "hash", None)],
        "_key string, type string, expireAt timestamp")
    kids = {
        "legacy_zset": spark.createDataFrame(
            [("p", "x", 1.0, "zset"), ("p", "y", 2.0, "zset"), ("gone", "z", 3.0, "zset")],
            "_key string, value string, score double, type string"),
        "legacy_string": spark.createDataFrame(
            [("a", "x", "string"), ("a", "y", "hash")], "_key string, data string, type string"),
        "legacy_hash": spark.createDataFrame(
            [("d", "{}", "hash"), ("d", "{}", "hash")], "_key string, data string, type string"),
    }
    return catalog, kids


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_orphans_and_types(spark):
    catalog, kids = _fixture(spark)
    assert rows(I.orphans(kids, catalog), "table_name", "_key", "type", "n_rows") == [
        ("legacy_string", "a", "hash", 1), ("legacy_zset", "gone", "zset", 1)]
    assert rows(I.type_violations(kids), "table_name", "_key", "type") == [
        ("legacy_string", "a", "hash")]


def test_primary_keys(spark):
    catalog, kids = _fixture(spark)
    got = rows(I.pk_violations({"legacy_hash": kids["legacy_hash"], "legacy_object": catalog}),
               "table_name", "key", "n")
    assert got == [("legacy_hash", "d", 2)]
    nulls = spark.createDataFrame([(None, "x", "set"), ("k", None, "set")],
                                  "_key string, member string, type string")
    got = rows(I.pk_violations({"legacy_set": nulls}), "table_name", "key", "n")
    assert got == [("legacy_set", None, 1), ("legacy_set", None, 1)]


def test_cascade_delete(spark):
    catalog, kids = _fixture(spark)
    cat, out = I.cascade_delete(catalog, kids, F.col("_key") == "p")
    assert rows(cat, "_key") == [("a",), ("d",)]
    assert rows(out["legacy_zset"], "_key", "value") == [("gone", "z")]
    assert out["legacy_string"].count() == 2 and out["legacy_hash"].count() == 2


def test_cascade_delete_null_predicate_keeps_row(spark):
    catalog, kids = _fixture(spark)
    cat, _ = I.cascade_delete(catalog, kids, F.col("expireAt") <= F.lit(T))
    assert rows(cat, "_key") == [("a",), ("d",)]


def test_cascade_rename(spark):
    catalog, kids = _fixture(spark)
    mapping = spark.createDataFrame([("a", "a2")], "_key string, new_key string")
    cat, out = I.cascade_rename(catalog, kids, mapping)
    assert rows(cat, "_key", "type") == [("a2", "string"), ("d", "hash"), ("p", "zset")]
    # the row typed 'string' follows its parent; the mistyped row is an orphan and stays
    assert rows(out["legacy_string"], "_key", "data") == [("a", "y"), ("a2", "x")]
    assert rows(out["legacy_zset"], "_key") == [("gone",), ("p",), ("p",)]


def test_null_and_domain_violations(spark):
    df = spark.createDataFrame([("k", None, "zset"), (None, "v", "nope")],
                               "_key string, value string, type string")
    assert rows(I.null_violations(df, ["_key", "value"], "t"), "column_name", "n") == [
        ("_key", 1), ("value", 1)]
    assert rows(I.domain_violations(df, {"type": ("zset",)}, "t"), "value", "n") == [("nope", 1)]


def test_dup_key_type(spark):
    cat = spark.createDataFrame([("a", "hash"), ("a", "hash"), ("a", "zset")], "_key string, type string")
    assert rows(I.dup_key_type(cat), "_key", "type", "n") == [("a", "hash", 2)]


def test_hot_key_split_equals_plain_join(spark):
    from kindred.operators import skew
    hot = [("h", "zset", f"m{i}") for i in range(500)]
    cold = [(f"k{i}", "zset", "x") for i in range(50)]
    big = spark.createDataFrame(hot + cold, "_key string, type string, value string").repartition(5)
    small = spark.createDataFrame([("h", "zset", "H"), ("k1", "zset", "K"), ("zz", "zset", "Z")],
                                  "_key string, type string, new_key string")
    found = skew.hot_keys([big], ["_key", "type"], 100)
    assert [tuple(r) for r in found.keys.collect()] == [("h", "zset")] and found.n == 1
    for how in ("inner", "left", "left_anti", "left_semi"):
        plain = sorted(map(tuple, big.join(small, ["_key", "type"], how).collect()))
        for max_hot in (10, 0):  # by broadcast, and salted
            split = skew.split_hot_join(big, small, ["_key", "type"], how, found, max_hot)
            assert plain == sorted(map(tuple, split.collect())), (how, max_hot)


def test_deleted_keys_are_broadcast_once_per_key(spark):
    """However often the catalog repeats a deleted pair."""
    catalog = spark.createDataFrame([("h", "zset", None)] * 500, "_key string, type string, expireAt timestamp")
    kids = {"legacy_zset": spark.createDataFrame([("h", f"m{i}", 1.0, "zset") for i in range(300)],
                                                 "_key string, value string, score double, type string")}
    kept, out = I.cascade_delete(catalog, kids, F.col("_key") == "h", hot_threshold=50)
    assert kept.count() == 0 and out["legacy_zset"].count() == 0


def test_rename_conflicts_are_reported_and_not_carried_out(spark):
    catalog = spark.createDataFrame([(k, "zset", None) for k in "abcdex"], "_key string, type string, expireAt timestamp")
    kids = {"legacy_zset": spark.createDataFrame([(k, "m", 1.0, "zset") for k in "abcdex"],
                                                 "_key string, value string, score double, type string")}
    mapping = spark.createDataFrame([("a", "A"), ("a", "B"), ("b", "x"), ("c", "N"), ("d", "N"), ("e", "E")],
                                    "_key string, new_key string")
    got = {(r["_key"], r["new_key"], r["reason"]) for r in I.rename_conflicts(catalog, mapping).collect()}
    assert got == {("a", "A", "ambiguous"), ("a", "B", "ambiguous"), ("b", "x", "collision"),
                   ("c", "N", "collision"), ("d", "N", "collision")}
    new, out = I.cascade_rename(catalog, kids, mapping)
    assert sorted(r["_key"] for r in new.collect()) == sorted(r["_key"] for r in out["legacy_zset"].collect()) \
        == ["E", "a", "b", "c", "d", "x"]


def test_cascades_with_a_hot_key(spark):
    catalog, kids = _fixture(spark)
    hot = spark.createDataFrame([("p", f"m{i}", float(i), "zset") for i in range(300)],
                                "_key string, value string, score double, type string")
    kids = dict(kids, legacy_zset=kids["legacy_zset"].unionByName(hot))
    _, out = I.cascade_delete(catalog, kids, F.col("_key") == "p", hot_threshold=50)
    assert rows(out["legacy_zset"], "_key") == [("gone",)]
    mapping = spark.createDataFrame([("p", "p2")], "_key string, new_key string")
    _, out = I.cascade_rename(catalog, kids, mapping, hot_threshold=50)
    assert out["legacy_zset"].where("_key = 'p2'").count() == 302


def test_rename_does_not_multiply_rows_on_repeated_catalog_pairs(spark):
    catalog = spark.createDataFrame([("a", "string", None), ("a", "string", None)],
                                    "_key string, type string, expireAt timestamp")
    kids = {"legacy_string": spark.createDataFrame([("a", "x", "string")], "_key string, data string, type string")}
    mapping = spark.createDataFrame([("a", "b")], "_key string, new_key string")
    _, out = I.cascade_rename(catalog, kids, mapping)
    assert rows(out["legacy_string"], "_key", "data") == [("b", "x")]
