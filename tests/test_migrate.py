"""D11 end to end, and the streaming ingest."""

import json
import os

import pytest

from kindred.operators import catalog as C
from kindred.operators import stage as S
from kindred.plans.migrate import RejectedDocuments, migrate, rejects_by_reason
from kindred.sources.documents import write_documents
from kindred.sources.fixtures import SPARK_FAMILIES, fixture_documents
from kindred.streaming import read_stage, stream_stage

from testdata_paths import SF_SMALL


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("src") / "docs")
    write_documents(fixture_documents(spark, SF_SMALL), path)
    return path


def test_migrate_writes_every_table(spark, src, tmp_path):
    res = migrate(spark, src, str(tmp_path / "out"), cluster=True, partition_catalog_by_type=True)
    for name in ("legacy_object", "legacy_hash", "legacy_zset", "legacy_set", "legacy_list",
                 "legacy_string", "legacy_imported", "rejects", "session"):
        assert os.path.isdir(res.tables[name]), name
    cat = spark.read.parquet(res.tables["legacy_object"])
    folders = os.listdir(res.tables["legacy_object"])
    assert {"type=hash", "type=zset"} <= set(folders)
    assert cat.where("type = 'hash'").count() == 150
    assert spark.read.parquet(res.tables["legacy_zset"]).count() > 1901
    assert res.violations["orphans"] == 0 and res.violations["type_violations"] == 0
    assert res.violations["mixed_kind_keys"] > 0 and res.violations["dup_plain_keys"] > 0
    reasons = {r["reason"] for r in rejects_by_reason(spark, res).collect()}
    assert {"bad_score", "null_value", "not_an_object", "bad_imported_id"} <= reasons


def test_migrate_clean_source_has_no_violations(spark, tmp_path):
    docs = fixture_documents(spark, SF_SMALL, SPARK_FAMILIES)
    res = migrate(spark, docs, str(tmp_path / "out"), on_error="fail")
    assert all(v == 0 for v in res.violations.values()), res.violations
    assert spark.read.parquet(res.tables["legacy_object"]).count() == 375


def test_migrate_fails_on_rejects_when_asked(spark, src, tmp_path):
    with pytest.raises(RejectedDocuments):
        migrate(spark, src, str(tmp_path / "out"), on_error="fail", checks=False)


def test_exact_join_mode(spark, src, tmp_path):
    res = migrate(spark, src, str(tmp_path / "out"), exact_join=True, checks=False)
    hashes = spark.read.parquet(res.tables["legacy_hash"])
    # sorted-set documents under hash keys leak into the hash table in this mode
    assert hashes.count() > 150


def test_streaming_ingest_is_incremental(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    (land / "a.jsonl").write_text('{"_key":"a","value":"x"}\n{"_key":"z","score":1,"value":"m"}\n')
    stage_dir = str(tmp_path / "stage")
    ckpt = str(tmp_path / "ckpt")
    q = stream_stage(spark, str(land), stage_dir, checkpoint=ckpt)
    q.awaitTermination()
    st = read_stage(spark, stage_dir)
    assert sorted((r["_key"], r["type"]) for r in C.legacy_object(st).collect()) == [
        ("a", "string"), ("z", "zset")]
    (land / "b.jsonl").write_text('{"_key":"z","score":2,"value":"n"}\n{"_key":"h","f":1}\n')
    q = stream_stage(spark, str(land), stage_dir, checkpoint=ckpt)
    q.awaitTermination()
    st = read_stage(spark, stage_dir)
    assert st.count() == 4  # each file consumed exactly once
    assert sorted((r["_key"], r["type"]) for r in C.legacy_object(st).collect()) == [
        ("a", "string"), ("h", "hash"), ("z", "zset")]


def test_stage_folder_is_dropped(spark, tmp_path):
    docs = spark.createDataFrame([('{"_key":"a","value":"x"}',)], "data string")
    path = str(tmp_path / "stage-x")
    S.stage(spark, docs, path=path).count()
    assert os.path.isdir(path)
    S.delete_path(spark, path)
    assert not os.path.exists(path)


def test_command_line(spark, tmp_path, capsys):
    from kindred.__main__ import main
    src = tmp_path / "in.jsonl"
    src.write_text('{"_key":"a","value":"x"}\n{"_key":"z","score":1,"value":"m"}\n[1]\n')
    assert main([str(src), str(tmp_path / "out"), "--no-checks"]) == 0
    out = json.loads(capsys.readouterr().out)
    assert spark.read.parquet(out["tables"]["legacy_object"]).count() == 2
    assert spark.read.parquet(out["tables"]["rejects"]).count() == 1


def test_documents_as_text_readable_elsewhere(spark, tmp_path):
    import duckdb
    docs = spark.createDataFrame([('{"_key":"h","name":"n","k":1}',), ('{"_key":"_imported_user:3","x":1}',)],
                                 "data string")
    res = migrate(spark, docs, str(tmp_path / "out"), documents_as="text", checks=False)
    got = duckdb.sql(f"select _key, data from read_parquet('{res.tables['legacy_hash']}/*.parquet')").fetchall()
    assert [(k, json.loads(d)) for k, d in got] == [("h", {"k": 1, "name": "n"})]
    got = duckdb.sql(f"select type, id, data from read_parquet('{res.tables['legacy_imported']}/*.parquet')").fetchall()
    assert [(t, i, json.loads(d)) for t, i, d in got] == [("user", 3, {"x": 1})]
