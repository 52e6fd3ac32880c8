import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kindred.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, cycle=(5, 2, 1), epochs=3):
    """Reshare by weight until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
    out, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > epochs * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = epochs * sizes[s]
            left -= out[s]
        free -= over
    return out


def check(rows, got):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = targets(sizes)
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = defaultdict(int)
    for r in got:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:  # whole documents only: half of the crossing one at most
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 0.5
    # Weighted order: within a source, whoever is taken more has the smaller key.
    for s in sizes:
        mine = sorted((r for r in got if r["source"] == s and r["size"]), key=lambda r: r["sample_key"])
        epochs = int(round(want[s]) // sizes[s]) if sizes[s] else 0
        chosen = [r["taken"] - epochs * r["size"] for r in mine]
        assert all(e in (0, r["size"]) for e, r in zip(chosen, mine))
        part = [e > 0 for e in chosen]
        assert part == sorted(part, reverse=True)
        # One document more or less would not end nearer.
        rest, n = round(want[s]) - epochs * sizes[s], sum(part)
        assert all(abs(sum(chosen) - rest) <= abs(sum(r["size"] for r in mine[:k]) - rest) for k in (n - 1, n + 1) if 0 <= k <= len(mine))


def test_awkward_rows(odd, odd_rows):
    check([(r[0], r[1], r[3]) for r in odd_rows], M.mix(odd).collect())


def test_documents(documents):
    got = M.mix(documents).collect()
    check([tuple(r) for r in documents.select("doc_id", "text", "source").collect()], got)
    assert sorted(map(str, got)) == sorted(map(str, M.mix(documents.repartition(5)).collect()))


def test_weights_move_the_sample(spark):
    text = "word " * 20
    rows = [(i, text + ("x" if i % 2 else "#" * 30), "a" if i < 2000 else "b") for i in range(4000)]
    got = M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), cycle=(1.0, 7.0)).collect()
    first = [r for r in got if r["source"] == "a"]
    clean, signs = (sum(r["taken"] for r in first if r["doc_id"] % 2 == k) for k in (1, 0))
    assert clean > 1.5 * signs


def test_mixed_documents(documents, odd):
    for frame in (documents, odd):
        plan = {}
        for r in M.mix(frame).collect():
            plan[r["source"]] = plan.get(r["source"], 0) + r["taken"]
        mixed = M.mixed_documents(frame)
        assert mixed.columns == frame.columns
        texts = {(r["doc_id"], r["text"]) for r in frame.collect()}
        assert all((r["doc_id"], r["text"]) in texts for r in mixed.collect())  # whole texts
        n = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(M.n_words(F.col("text"))).alias("n")).collect()}
        assert n == {s: t for s, t in plan.items() if t}


def test_level_search():
    for sizes in ({"a": 10, "b": 1, "c": 1000}, {"a": 0, None: 5}, {"a": 7}):
        want = targets(sizes)
        assert math.isclose(sum(want.values()), sum(sizes.values()))


def test_empty(empty):
    assert M.mix(empty).count() == 0 and M.mixed_documents(empty).count() == 0
