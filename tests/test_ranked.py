"""Ranks from a stored order against the ranking of the whole table."""

import pytest
from pyspark.sql import functions as F

from kindred.operators import access, ranked, tables as TB
from kindred.plans import registry

from testdata_paths import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """One set of 3,000 members over many files, small ones, equal scores."""
    rows = [("hot", f"m{i:05d}", float(i % 97)) for i in range(3000)] + [(f"k{i}", "a", 1.0) for i in range(40)]
    zset = spark.createDataFrame(rows, "_key string, value string, score double").repartition(7)
    path = str(tmp_path_factory.mktemp("ranked"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked.write_ranked(spark, zset, path, 12)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    truth = {(r["_key"], r["value"]): (r["score"], r["rank"]) for r in access.zset_rank(spark, zset).collect()}
    return path, truth


def test_ranks_of_all(spark, stored):
    path, truth = stored
    got = {(r["_key"], r["value"]): (r["score"], r["rank"]) for r in ranked.ranks(spark, path).collect()}
    assert got == truth and len(got) == 3040
    assert spark.read.parquet(f"{path}/directory").where("_key = 'hot'").count() > 5


def test_ranks_of_some(spark, stored):
    path, truth = stored
    wanted = spark.createDataFrame([("hot", "m00005"), ("hot", "m00005"), ("k3", "a"), ("no", "a")], "_key string, value string")
    got = [(r["_key"], r["value"], r["rank"]) for r in ranked.ranks(spark, path, wanted).collect()]
    assert sorted(got) == [("hot", "m00005", truth["hot", "m00005"][1]), ("k3", "a", 1)]


def test_one_rank_reads_one_file(spark, stored):
    path, truth = stored
    for value in ("m00000", "m01234", "m02999"):
        score, rank = truth["hot", value]
        assert ranked.rank_of(spark, path, "hot", value) == rank
        assert ranked.rank_of(spark, path, "hot", value, score) == rank
        assert ranked.files_of(spark, path, "hot", value, score).count() == 1
    assert ranked.rank_of(spark, path, "hot", "m00000", 55.5) is None
    assert ranked.rank_of(spark, path, "hot", "nobody") is None and ranked.rank_of(spark, path, "no", "a") is None


def test_members_between_ranks(spark, stored):
    path, truth = stored
    by_rank = {rank: value for (key, value), (_, rank) in truth.items() if key == "hot"}
    for first, last in ((1, 5), (700, 1500), (2999, 4000), (1, 3000)):
        got = {r["rank"]: r["value"] for r in ranked.members_between(spark, path, "hot", first, last).collect()}
        assert got == {k: v for k, v in by_rank.items() if first <= k <= last}
    assert len(ranked.members_between(spark, path, "hot", 10, 12).inputFiles()) <= 2 + len(
        spark.read.parquet(f"{path}/directory").inputFiles())
    assert ranked.members_between(spark, path, "no", 1, 5).count() == 0
    assert ranked.members_between(spark, path, "hot", 5, 4).count() == 0


def test_numbers_without_bounds(spark, tmp_path):
    zset = TB.legacy_zset(registry.staged(spark, SF_SMALL))
    ranked.write_ranked(spark, zset, str(tmp_path))
    want = {tuple(r) for r in access.zset_rank(spark, zset).select("_key", "value", "score_text", "rank").collect()}
    assert {tuple(r) for r in ranked.ranks(spark, str(tmp_path)).select("_key", "value", "score_text", "rank").collect()} == want
    key, value, text, rank = max(want, key=lambda r: r[3])
    assert ranked.rank_of(spark, str(tmp_path), key, value, text) == rank


def test_repeated_rows_and_empty_tables(spark, tmp_path):
    zset = spark.createDataFrame([("a", "x", 1.0)] * 50 + [("a", "y", 2.0)], "_key string, value string, score double")
    ranked.write_ranked(spark, zset, str(tmp_path / "r"), 4)
    got = sorted((r["value"], r["rank"]) for r in ranked.ranks(spark, str(tmp_path / "r")).collect())
    assert got == [("x", i) for i in range(2, 52)] + [("y", 1)]
    assert ranked.rank_of(spark, str(tmp_path / "r"), "a", "x") == 2
    ranked.write_ranked(spark, zset.where(F.lit(False)), str(tmp_path / "e"))
    assert ranked.ranks(spark, str(tmp_path / "e")).count() == 0
    assert ranked.rank_of(spark, str(tmp_path / "e"), "a", "x") is None
