"""Dumps of a document store: kinds of values, ranges, broken files."""

import json
import random
import struct

import pytest

from kindred.operators import catalog as C, stage as S, tables as TB
from kindred.sources import dump as D


def element(kind, name, raw):
    return bytes([kind]) + name.encode() + b"\0" + raw


def document(*elements):
    body = b"".join(elements)
    return struct.pack("<i", len(body) + 5) + body + b"\0"


def text(s):
    raw = s.encode() + b"\0"
    return struct.pack("<i", len(raw)) + raw


KINDS = [
    (0x01, struct.pack("<d", 1.0), "1"), (0x01, struct.pack("<d", -0.1), "-0.1"), (0x01, struct.pack("<d", 1e21), "1e+21"),
    (0x01, struct.pack("<d", 1.5e-7), "1.5e-7"), (0x01, struct.pack("<d", float("nan")), "null"), (0x02, text('a"é\n'), '"a\\"é\\n"'),
    (0x03, document(element(0x0A, "x", b"")), '{"x":null}'), (0x04, document(element(0x10, "0", struct.pack("<i", 5)), element(0x06, "1", b"")), "[5,null]"),
    (0x05, struct.pack("<iB", 3, 0) + b"abc", '"YWJj"'), (0x07, bytes(range(12)), '"000102030405060708090a0b"'), (0x08, b"\1", "true"), (0x08, b"\0", "false"),
    (0x09, struct.pack("<q", 1700000000123), '"2023-11-14T22:13:20.123Z"'), (0x09, struct.pack("<q", -1), '"1969-12-31T23:59:59.999Z"'),
    (0x09, struct.pack("<q", 253402300800000), '"+010000-01-01T00:00:00.000Z"'), (0x09, struct.pack("<q", -62198755200000), '"-000001-01-01T00:00:00.000Z"'),
    (0x0A, b"", "null"), (0x0B, b"^a\0i\0", '{"$regularExpression": "/^a/i"}'), (0x10, struct.pack("<i", -7), "-7"),
    (0x11, struct.pack("<Q", 9), '{"$timestamp": "9"}'), (0x12, struct.pack("<q", 2 ** 53 + 1), "9007199254740993"),
    (0x13, struct.pack("<QQ", 150, (6176 - 2) << 49), '{"$numberDecimal": "150E-2"}'), (0x13, struct.pack("<QQ", 0, 0x7800 << 48), '{"$numberDecimal": "Infinity"}'),
    (0x0D, text("f()"), '"f()"'), (0x0F, struct.pack("<i", 4 + 4 + 4 + 5) + text("f()") + document(), '"f()"'), (0x7F, b"", '{"$maxKey": "1"}'),
    (0xFF, b"", '{"$minKey": "1"}'),
]


@pytest.mark.parametrize("kind,raw,want", KINDS)
def test_kinds(kind, raw, want):
    data = document(element(0x02, "_key", text("k")), element(kind, "v", raw), element(0x08, "end", b"\1"))
    got, end = D.document_json(memoryview(data))
    assert got == f'{{"_key":"k","v":{want},"end":true}}' and end == len(data)
    json.loads(got)


def test_undefined_is_not_written():
    assert D.document_json(memoryview(document(element(0x06, "u", b""), element(0x0A, "n", b""))))[0] == '{"n":null}'


@pytest.mark.parametrize("cut", range(1, 30))
def test_malformed(cut):
    data = document(element(0x02, "_key", text("k")), element(0x10, "n", b"\1\0\0\0"))
    with pytest.raises(D.Malformed):
        D.document_json(memoryview(data[:-cut]))


def documents(n, seed=1):
    rnd = random.Random(seed)
    # Values that hold documents themselves lead guesses astray.
    inner = D.document_bytes({"_key": "inner", "a": 1}) * 9
    out = []
    for i in range(n):
        out.append({"_key": f"k{i}", "n": rnd.randrange(-2 ** 40, 2 ** 40), "f": rnd.random(), "t": "é" * rnd.randrange(40), "o": {"a": [1, None, "x"]},
                    "trap": inner.decode("latin-1") if i % 7 == 0 else "", "big": "y" * (5000 if i % 50 == 0 else 0)})
    return out


@pytest.mark.parametrize("split_bytes", [700, 10_000, 1 << 30])
def test_ranges(spark, tmp_path, split_bytes):
    docs = documents(400)
    (tmp_path / "a.bson").write_bytes(b"".join(map(D.document_bytes, docs[:100])))
    (tmp_path / "b.bson").write_bytes(b"".join(map(D.document_bytes, docs[100:])))
    (tmp_path / "c.bson").write_bytes(b"")
    rows = D.read_dump(spark, str(tmp_path), split_bytes)
    got = [json.loads(r["data"]) for r in rows.collect()]
    assert sorted(got, key=lambda d: int(d["_key"][1:])) == docs


def test_traps_are_guessed_and_mended(spark, tmp_path):
    """Raw documents inside a binary value look like the file's own."""
    inner = D.document_bytes({"_key": "inner", "a": 1}) * 40
    data = b"".join(document(element(0x02, "_key", text(f"k{i}")), element(0x05, "b", struct.pack("<iB", len(inner), 0) + inner)) for i in range(60))
    (tmp_path / "a.bson").write_bytes(data)
    for split_bytes in (1000, 5000):
        keys = [json.loads(r["data"])["_key"] for r in D.read_dump(spark, str(tmp_path), split_bytes).collect()]
        assert sorted(keys) == sorted(f"k{i}" for i in range(60))


def test_written_and_read_back(spark, tmp_path):
    docs = documents(300)
    rows = spark.createDataFrame([(json.dumps(d),) for d in docs], "data string").repartition(5)
    assert D.write_dump(rows, str(tmp_path / "out")) == 300
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.suffix == ".bson") == [f"part-{i:05d}.bson" for i in range(5)]
    got = [json.loads(r["data"]) for r in D.read_dump(spark, str(tmp_path / "out"), 3000).collect()]
    assert sorted(got, key=lambda d: int(d["_key"][1:])) == docs


@pytest.mark.parametrize("split_bytes", [500, 1 << 20])
def test_broken_files_are_reported(spark, tmp_path, split_bytes):
    docs = documents(60)
    data = b"".join(map(D.document_bytes, docs))
    (tmp_path / "a.bson").write_bytes(data[:-3])
    st = S.stage(spark, D.read_dump(spark, str(tmp_path / "a.bson"), split_bytes))
    assert C.legacy_object(st).count() == 59
    assert [(r["reason"], "a.bson" in r["data"]) for r in TB.rejects(st).collect()] == [("not_an_object", True)]


def test_a_hole_loses_no_more_than_its_range(spark, tmp_path):
    docs = [D.document_bytes({"_key": f"k{i}", "value": "x" * 30}) for i in range(200)]
    data = b"".join(docs)
    at = sum(map(len, docs[:50]))
    (tmp_path / "a.bson").write_bytes(data[:at] + b"\xff" * 20 + data[at + 20:])
    got = [r["data"] for r in D.read_dump(spark, str(tmp_path), 1000).collect()]
    assert sum("no document at byte" in t for t in got) == 1
    assert 150 < sum(t.startswith("{") for t in got) < 200


def test_no_files(spark, tmp_path):
    assert D.read_dump(spark, str(tmp_path / "*.bson")).count() == 0
