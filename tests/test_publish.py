"""Tables published together and cascades that rewrite only what they touch."""

import pytest
from pyspark.sql import functions as F

from kindred.operators import integrity as I
from kindred.plans import migrate as M, publish as P


def docs(spark, n, extra=()):
    lines = [f'{{"_key":"s{i}","value":"v{i}"}}' for i in range(n)]
    lines += [f'{{"_key":"z{i % 3}","value":"m{i}","score":{i}}}' for i in range(n)]
    return spark.createDataFrame([(x,) for x in [*lines, *extra]], "data string")


def counts(spark, target):
    return {name: df.count() for name, df in P.read_tables(spark, target).items()}


def test_a_job_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    first = P.migrate_published(spark, docs(spark, 9), target, "one")
    assert first.number == 1
    before = counts(spark, target)
    assert before["legacy_string"] == 9 and before["legacy_zset"] == 9 and before["session"] == 0

    real = M._write

    def dies(df, path, *rest):
        if path.endswith("legacy_zset"):
            raise RuntimeError("killed")
        return real(df, path, *rest)

    monkeypatch.setattr(M, "_write", dies)
    with pytest.raises(RuntimeError):
        P.migrate_published(spark, docs(spark, 20), target, "two", checks=False)
    assert counts(spark, target) == before and P.current(spark, target) == first
    monkeypatch.undo()

    second = P.migrate_published(spark, docs(spark, 20), target, "two", checks=False)
    assert second.jobs == ("one", "two") and counts(spark, target)["legacy_zset"] == 20
    # the earlier version can still be read, and its session table is kept
    assert P.read_tables(spark, target, first)["legacy_string"].count() == 9
    assert second.files["session"] == first.files["session"]


def test_a_published_job_does_nothing_again(spark, tmp_path):
    target = str(tmp_path / "t")
    first = P.migrate_published(spark, docs(spark, 3), target, "one", checks=False)
    assert P.migrate_published(spark, docs(spark, 30), target, "one", checks=False) == first
    assert counts(spark, target)["legacy_string"] == 3


def test_one_of_two_jobs_from_the_same_version_is_published(spark, tmp_path):
    target = str(tmp_path / "t")
    base = P.publish_tables(spark, {"legacy_string": spark.createDataFrame([("a", "x", "string")], "_key string, data string, type string")},
                            target, "one")
    P._publish(spark, target, "two", base, {})
    with pytest.raises(P.PublishConflict):
        P._publish(spark, target, "three", base, {})
    assert P.current(spark, target).jobs == ("one", "two")


def test_rejected_documents_publish_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    with pytest.raises(M.RejectedDocuments):
        P.migrate_published(spark, docs(spark, 2, ["[1]"]), target, "one", checks=False, on_error="fail")
    assert P.read_tables(spark, target) == {} and P.current(spark, target) == P.NOTHING
    with pytest.raises(ValueError):
        P.migrate_published(spark, docs(spark, 2), target, "../one")
    with pytest.raises(ValueError):
        P.migrate_published(spark, docs(spark, 2), target, "one", output_format="jdbc")
    with pytest.raises(ValueError):
        P.delete_published(spark, target, "d", F.lit(True))


@pytest.fixture
def store(spark, tmp_path):
    """300 strings and 3 sets over eight files a table, one set holding most members."""
    catalog = spark.createDataFrame([(f"s{i:03d}", "string") for i in range(300)] + [(f"z{i}", "zset") for i in range(3)],
                                    "_key string, type string").withColumn("expireAt", F.lit(None).cast("timestamp"))
    kids = {"legacy_string": spark.createDataFrame([(f"s{i:03d}", f"x{i}", "string") for i in range(300)],
                                                   "_key string, data string, type string"),
            "legacy_zset": spark.createDataFrame([("z0" if i % 10 else f"z{1 + i % 20 // 10}", f"m{i:04d}", float(i), "zset") for i in range(2000)],
                                                 "_key string, value string, score double, type string")}
    target = str(tmp_path / "t")
    # small tables would be merged into one file by adaptive execution
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        version = P.publish_tables(spark, {"legacy_object": catalog, **kids}, target, "load")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert all(len(f) >= 6 for f in version.files.values())
    return target, version, catalog, kids


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("hot", [1_000_000, 50])
def test_delete_rewrites_touched_files_only(spark, store, hot):
    target, base, catalog, kids = store
    gone = F.col("_key").isin("s007", "z0")
    new = P.delete_published(spark, target, "purge", gone, hot)
    kept, left = I.cascade_delete(catalog, kids, gone)
    tables = P.read_tables(spark, target)
    assert rows(tables["legacy_object"]) == rows(kept)
    assert all(rows(tables[n]) == rows(left[n]) for n in left)
    # one key's file of the strings is replaced, all others keep their names
    old, now = set(base.files["legacy_string"]), set(new.files["legacy_string"])
    assert len(old - now) == 1 and len(old & now) == len(old) - 1
    again = P.delete_published(spark, target, "purge", gone, hot)
    assert again == new


def test_nothing_to_delete_rewrites_nothing(spark, store):
    target, base, *_ = store
    assert P.delete_published(spark, target, "none", F.col("expireAt") < F.current_timestamp()).files == base.files


def test_a_table_can_lose_all_rows(spark, store):
    target, base, catalog, kids = store
    P.delete_published(spark, target, "all", F.lit(True))
    tables = P.read_tables(spark, target)
    assert {n: df.count() for n, df in tables.items()} == dict.fromkeys(base.files, 0)
    assert tables["legacy_zset"].columns == kids["legacy_zset"].columns


def test_rename_rewrites_touched_files_only(spark, store):
    target, base, catalog, kids = store
    mapping = spark.createDataFrame([("s010", "t010"), ("z1", "y1"), ("s020", "s021"), ("no", "yes")], "_key string, new_key string")
    new = P.rename_published(spark, target, "rename", mapping)
    renamed, moved = I.cascade_rename(catalog, kids, mapping)
    tables = P.read_tables(spark, target)
    assert rows(tables["legacy_object"]) == rows(renamed)
    assert all(rows(tables[n]) == rows(moved[n]) for n in moved)
    old, now = set(base.files["legacy_string"]), set(new.files["legacy_string"])
    assert len(old - now) == 1
    assert tables["legacy_string"].where("_key = 's020'").count() == 1  # its new key is taken
