"""Repeated keys reported on arrival equal the batch checks."""

import json
import random

from pyspark.sql import functions as F

from kindred.operators import integrity as I, stage as S
from kindred.streaming.unique import read_repeats, stream_repeats


def documents(seed, n):
    rnd = random.Random(seed)
    for _ in range(n):
        d = {"_key": rnd.choice(["hot", None, *(f"k{i}" for i in range(30))])}
        if rnd.random() < 0.5:
            d["score"] = rnd.choice([1, None, "x"])
        if rnd.random() < 0.7:
            d["value"] = rnd.choice(["a", "b", 1, None])
        yield rnd.choice([json.dumps(d)] * 9 + ["[1]", '{"value":"a"}'])


def batch(spark, folder):
    st = S.stage(spark, spark.read.text(folder).select(F.col("value").alias("data")))
    want = {("I2", r["_key"], None): r["n"] - 1 for r in I.dup_plain_keys(st).collect()}
    return want | {("I3", r["_key"], r["value"]): r["n"] - 1 for r in I.dup_key_value(st).collect()}


def test_stream_equals_batch_across_restarts(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for run in range(3):
        for part in range(2):
            (src / f"{run}{part}.jsonl").write_text("\n".join(documents(10 * run + part, 60)) + "\n")
        stream_repeats(spark, str(src), out, max_files_per_trigger=1).awaitTermination()
        want = batch(spark, str(src))
        got = {(r["rule"], r["_key"], r["value"]): r["n_repeated"] for r in read_repeats(spark, out).collect()}
        assert got == want and want


def test_nothing_new_reports_nothing_again(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "a.jsonl").write_text('{"_key":"a","value":"x"}\n{"_key":"a","value":"x"}\n')
    for _ in range(2):
        stream_repeats(spark, str(src), out).awaitTermination()
    assert sorted((r["rule"], r["n_repeated"]) for r in read_repeats(spark, out).collect()) == [("I2", 1), ("I3", 1)]
