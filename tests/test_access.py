"""Access-path jobs against brute force on the sf0.001 collection."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kindred.operators import access
from kindred.operators import catalog as C
from kindred.operators import tables as TB
from kindred.plans import registry

from testdata_paths import SF_SMALL


@pytest.fixture(scope="module")
def zset(spark):
    return TB.legacy_zset(registry.staged(spark, SF_SMALL))


def test_zset_rank_matches_window(spark, zset):
    brute = []
    members = {}
    for r in zset.select("_key", "value", "score_text").collect():
        members.setdefault(r["_key"], []).append((Decimal(r["score_text"]), r["value"]))
    for key, found in members.items():
        brute += [(key, v, s, rank) for rank, (s, v) in enumerate(sorted(found, reverse=True), 1)]
    brute.sort()
    got = sorted((r["_key"], r["value"], Decimal(r["score_text"]), r["rank"])
                 for r in access.zset_rank(spark, zset).collect())
    assert got == brute and len(got) == zset.count()


def test_zset_rank_one_hot_set(spark):
    # one set holding most rows, spread over many range partitions
    rows = [("hot", f"m{i:05d}", float(i % 97)) for i in range(3000)] + [("cold", "a", 1.0)]
    z = spark.createDataFrame(rows, "_key string, value string, score double").repartition(7)
    got = sorted((r["_key"], r["value"], r["rank"]) for r in access.zset_rank(spark, z).collect())
    # score descending, then member descending
    hot = sorted(((v, s) for k, v, s in rows if k == "hot"), key=lambda t: (t[1], t[0]), reverse=True)
    expect = sorted([("hot", v, i + 1) for i, (v, _) in enumerate(hot)] + [("cold", "a", 1)])
    assert got == expect


def test_top_n(spark, zset):
    top = access.zset_top_n(zset, 2)
    assert top.groupBy("_key").count().where("count > 2").count() == 0
    best = zset.groupBy("_key").agg(F.max("score").alias("mx"))
    firsts = top.where("rank = 1").join(best, "_key")
    assert firsts.where(F.col("score") != F.col("mx")).count() == 0


def test_range_and_expiry(spark):
    st = registry.staged(spark, SF_SMALL)
    cat = C.legacy_object(st)
    t0, t1 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 5)
    got = access.expiring_between(cat, t0, t1).collect()
    assert all(t0 <= r["expireAt"] < t1 for r in got)
    assert len(got) == cat.where((F.col("expireAt") >= F.lit(t0)) & (F.col("expireAt") < F.lit(t1))).count()
    nxt = access.next_to_expire(cat, 5, t0).collect()
    assert len(nxt) == 5 and [r["expireAt"] for r in nxt] == sorted(r["expireAt"] for r in nxt)
    z = TB.legacy_zset(st)
    rng = access.zset_range_by_score(z, 100, 200)
    assert rng.where((F.col("score") < 100) | (F.col("score") > 200)).count() == 0


def test_profile(spark, zset):
    prof = {r["column_name"]: r for r in access.profile(zset).collect()}
    assert prof["_key"]["n_rows"] == zset.count()
    assert prof["score_text"]["n_nulls"] == prof["score_key"]["n_nulls"] == 0
    # the decimal is null only where it does not hold the number
    numbers = [Decimal(r["score_text"]) for r in zset.select("score_text").collect()]
    assert prof["score"]["n_nulls"] == sum(len(str(n).partition(".")[2].rstrip("0")) > 18 or abs(n) >= 10 ** 20 for n in numbers) > 0
    assert prof["type"]["min_value"] == "zset" and prof["type"]["approx_distinct"] == 1


def test_write_clustered(spark, zset, tmp_path):
    out = str(tmp_path / "z")
    access.write_clustered(zset, out, ["_key", "value"])
    back = spark.read.parquet(out)
    assert back.count() == zset.count()


def test_clustered_zset_is_the_whole_table(spark, zset):
    """Every row is written and read back, not only the keys of clustered_lookup."""
    got = registry.QUERIES["clustered_zset"](spark, SF_SMALL).collect()
    want = zset.select("_key", "value", F.col("score_text").cast("double").alias("score")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert len(got) > registry.QUERIES["clustered_lookup"](spark, SF_SMALL).count() > 0
