import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kindred.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(UPPER))


def brute(docs, bench, size=13):
    windows = {}
    for item, text in bench:
        w = words(text)
        n = min(len(w), size)
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, items = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k:k + n]))
                if found:
                    hit.update(range(k, k + n))
                    items |= found
        out.append((i, len(w), len(hit), tuple(sorted(items))))
    return Counter(out)


def run(docs, bench, **options):
    found = D.decontaminate(docs, bench, **options)
    rows = found.collect()
    for r in rows:  # spans are disjoint, in order, and cover the hit words
        assert sum(s["end"] - s["begin"] for s in r["spans"]) == r["n_hit"]
        assert all(a["end"] < b["begin"] for a, b in zip(r["spans"], r["spans"][1:]))
    return Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows)


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, "one two three four"), (2, "WORD"), (3, None), (4, ""), (None, "two three"), (5, "a b c " * 6),
            (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu alpha beta"), (7, "missing here now"),
            (7, "one two")]
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as key", "'y' as len", "1 as at")


@pytest.mark.parametrize("options", [{}, {"max_broadcast": 0}])
def test_awkward_rows(odd, odd_rows, bench, options):
    expected = brute([r[:2] for r in odd_rows], [tuple(r)[:2] for r in bench.collect()])
    assert run(odd, bench, **options) == expected
    assert sum(n for k, n in expected.items() if k[2]) >= 6


@pytest.mark.parametrize("options", [{}, {"max_broadcast": 0}])
def test_documents(spark, documents, small, options):
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    expected = brute([tuple(r) for r in documents.select("doc_id", "text").collect()], [tuple(r) for r in bench.collect()])
    assert run(documents, bench, **options) == expected
    assert any(k[2] for k in expected)


def test_drop(odd, bench):
    kept = D.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == ["3", "4", "5", "9", "None"]


def test_empty(odd, empty, bench):
    assert D.decontaminate(empty, bench).count() == 0
    none = D.decontaminate(odd, bench.filter("1 = 0")).select(F.sum("n_hit"), F.count("*")).first()
    assert tuple(none) == (0, odd.count())


def test_native(documents, bench):
    plan = D.decontaminate(documents, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
