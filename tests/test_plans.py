"""Plan shape: parse once, no shuffle in children, one exchange in the catalog."""

import pytest

from kindred.operators import access
from kindred.operators import catalog as C
from kindred.operators import stage as S
from kindred.operators import tables as TB
from kindred.plans import registry

from testdata_paths import SF_SMALL


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


@pytest.fixture(scope="module")
def st(spark):
    return registry.staged(spark, SF_SMALL)


def test_classify_parses_once_in_codegen(spark):
    docs = spark.read.text(__file__).withColumnRenamed("value", "data")
    p = plan(S.classify(docs), "simple")
    assert p.count("from_json(") == 1
    assert "*(1) Project" in p  # whole-stage codegen covers the projection


def test_children_are_map_only(st):
    for name, df in TB.children(st).items():
        p = plan(df)
        assert "Exchange" not in p and "Join" not in p, name


def test_child_reads_only_its_kind_folder(st):
    p = plan(TB.legacy_hash(st))
    assert "PartitionFilters: [isnotnull(kind" in p and "(kind" in p and "= hash)" in p


def test_catalog_reads_no_documents(st):
    p = plan(C.legacy_object(st))
    assert "ReadSchema: struct<_key:string,expire_at:timestamp>" in p
    assert "m:map" not in p


def test_catalog_has_one_exchange(st):
    p = plan(C.zset_objects(st))
    assert p.count("hashpartitioning(") == 1
    assert "partial_min(" in p  # combined map-side before the shuffle
    assert "ReadSchema: struct<_key:string,expire_at:timestamp>" in p


def test_top_n_uses_window_group_limit(st):
    p = plan(access.zset_top_n(TB.legacy_zset(st), 3))
    assert "WindowGroupLimit" in p


def test_key_checks_read_no_documents(st):
    from kindred.operators import integrity as I
    for df in (I.dup_plain_keys(st), I.dup_key_value(st), I.mixed_kind_keys(st)):
        p = plan(df)
        assert "m:map" not in p and "ReadSchema" in p


def test_rank_range_partitions_instead_of_windowing_by_key(spark, st):
    ordered = access.zset_rank.__doc__
    assert "range-partition" in ordered
    z = TB.legacy_zset(st)
    rows = z.select("_key", "value", "score").repartitionByRange("_key")
    assert "rangepartitioning" in plan(rows).lower()
    p = plan(access.zset_rank(spark, z))
    # the only window by _key is the carry over boundary keys, ordered by
    # partition id; no window ranks a whole set by score in one task
    import re
    assert not re.search(r"windowspecdefinition\(_key#\d+L?, score", p)
    assert re.search(r"windowspecdefinition\(_pid#\d+L?, _key", p)


def test_objects_of_type_prunes_a_type_partitioned_catalog(spark, st, tmp_path):
    out = str(tmp_path / "cat")
    access.write_clustered(C.legacy_object(st), out, ["_key"], partition_by=["type"])
    p = plan(access.objects_of_type(spark.read.parquet(out), "string"))
    assert "PartitionFilters: [isnotnull(type" in p and "(type" in p and "= string)" in p


def test_range_filters_reach_the_scan(spark, st, tmp_path):
    out = str(tmp_path / "z")
    access.write_clustered(TB.legacy_zset(st), out, ["_key", "value"])
    p = plan(access.zset_range_by_score(spark.read.parquet(out), 100, 200))
    assert "PushedFilters: [IsNotNull(score_key), GreaterThanOrEqual(score_key," in p


def test_spread_rule_at_cluster_scale():
    from kindred.operators.stage import spread_target
    mb, gb, tb = 1 << 20, 1 << 30, 1 << 40
    split = 128 * mb
    # 1 TB already cut into 8000 splits on 8000 cores: never reshuffled
    assert spread_target(tb, 8000, 8000, split) is None
    # ten unsplittable 10 GB files: spread over the whole cluster (or one
    # split's worth per partition, when that gives more partitions)
    assert spread_target(100 * gb, 10, 8000, split) == 16000
    assert spread_target(100 * gb, 10, 100, split) == 800
    # a 3 MB one-row-group table on 8 cores: spread; on enough partitions: left
    assert spread_target(3 * mb, 1, 8, split) == 16
    assert spread_target(3 * mb, 16, 8, split) is None
