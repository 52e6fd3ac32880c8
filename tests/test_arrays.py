"""Arrays of any layout against the library's parser, at every way to cut them."""

import json
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kindred.sources import arrays as A
from kindred.sources.documents import read_documents

VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-10 ** 20, 10 ** 20) | st.text(alphabet='ab"\\[]{},: \n\té\U0001f600', max_size=12),
    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(alphabet='a"\\[{,', max_size=4), x, max_size=4), max_leaves=12)


def layouts(values, rnd):
    yield json.dumps(values)
    yield json.dumps(values, indent=2)
    yield json.dumps(values, indent=1, ensure_ascii=False)
    yield "\n\t " + json.dumps(values, separators=(",", ":")) + " \r\n"
    yield "﻿" + "[" + ",".join(" " * rnd.randrange(3) + json.dumps(v) + "\n" * rnd.randrange(2) for v in values) + "]"


class Range:
    """All ranges of one file, one after another, as the tasks see them."""

    def __init__(self, path):
        self.path, self.size = str(path), path.stat().st_size

    def read(self, cuts):
        edges = [0, *cuts, self.size]
        quotes = depth = 0
        out = []
        for b, e in zip(edges, edges[1:]):
            n = outside = inside = 0
            for _, data, strings in A.blocks(A._File(self.path, self.size), b, e):
                step = A._STEP[data].astype(int)
                open_ = (strings + n) % 2 == 1
                outside, inside, n = outside + step[~open_].sum(), inside + step[open_].sum(), n + int(strings[-1])
            change = int(outside if quotes % 2 == 0 else inside)
            out += A._range_elements({"file": self.path, "size": self.size, "begin": b, "end": e, "quotes_before": quotes,
                                      "depth_before": depth, "depth_after": depth + change})
            quotes, depth = quotes + n, depth + change
        return out


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("arrays")


@settings(max_examples=60, deadline=None)
@given(st.lists(VALUES, max_size=8), st.integers(0, 2 ** 32), st.sampled_from([7, 64, 1 << 22]))
def test_any_cut(folder, values, seed, block):
    rnd = random.Random(seed)
    old, A.BLOCK = A.BLOCK, block
    try:
        for text in layouts(values, rnd):
            path = folder / "a.json"
            path.write_bytes(text.encode())
            n = path.stat().st_size
            for cuts in (range(1, n), sorted(rnd.sample(range(1, n), min(n - 1, 3))), ()):
                got = Range(path).read(cuts)
                assert [json.loads(t) for t in got] == values, text
                assert all(t in text for t in got)  # as written
    finally:
        A.BLOCK = old


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(['"', "\\", "a"]), max_size=30), st.booleans())
def test_quotes(chars, escaped):
    text, want, open_ = "".join(chars), [], escaped
    for i, c in enumerate(text):
        if open_:
            open_ = False
        elif c == "\\":
            open_ = True
        elif c == '"':
            want.append(i)
    marks, last = A.quotes(np.frombuffer(text.encode(), np.uint8), escaped)
    assert marks.tolist() == want and last == open_


@pytest.mark.parametrize("text,good,bad", [
    ("[1,2", ["1", "2"], 1), ("[1,2,", ["1", "2"], 1), ('[{"a":1},{"b', ['{"a":1}', '{"b'], 1), ("[", [], 1), ("[]", [], 0), (" [ ] ", [], 0),
    ("[1] x", ["1"], 1), ("x [1]", ["1"], 1), ("[1][2]", ["1", "2"], 0), ("[1,,2]", ["1", "", "2"], 0), ("[1,]", ["1", ""], 0), ("5", [], 1),
    ("[[[]],{}]", ["[[]]", "{}"], 0),
])
def test_odd_files(folder, text, good, bad):
    path = folder / "b.json"
    path.write_text(text)
    for cuts in ((), range(1, len(text))):
        got = Range(path).read(cuts)
        wrong = [t for t in got if re.match("array not closed in|text outside the array", t)]
        assert [t for t in got if t not in wrong] == good and bool(wrong) == bool(bad)


def test_one_line_array_is_read_by_many_tasks(spark, tmp_path):
    docs = [{"_key": f"k{i}", "v": 'x"\\[{' * (i % 50), "n": [{"a": [i]}]} for i in range(20_000)]
    (tmp_path / "a.json").write_text(json.dumps(docs))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        rows = read_documents(spark, str(tmp_path / "a.json"), "json")
        assert rows.rdd.getNumPartitions() > 8
        assert sorted((json.loads(r["data"]) for r in rows.collect()), key=lambda d: int(d["_key"][1:])) == docs
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_numbers_stay_as_written(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"_key":"a","score":1.50e1},{"_key":"b","score":' + "9" * 45 + "}]")
    assert sorted(r["data"] for r in read_documents(spark, str(tmp_path), "json").collect()) \
        == ['{"_key":"a","score":1.50e1}', '{"_key":"b","score":' + "9" * 45 + "}"]
