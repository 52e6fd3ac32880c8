import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kindred.llm import minhash as M
from kindred.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(UPPER))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and (x == y or 100 * len(x & y) >= percent * len(x | y)):
            parent[find(b)] = find(a)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    out = []
    for n, (i, _) in enumerate(rows):
        c = least.get(find(n)) if sets[n] else i
        out.append((i, len(sets[n]), c, i == c))
    return Counter(out)


def result(frame, k):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                   for r in M.near_duplicates(frame, shingle=k).collect())


@pytest.mark.parametrize("k", [4, 5])
def test_awkward_rows(odd, odd_rows, k):
    assert result(odd, k) == brute([r[:2] for r in odd_rows], k)


def test_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert result(documents, 4) == brute(rows, 4)


def test_groups_around_the_threshold(spark):
    """Groups of copies with few and many edits, chains among them."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 200, 600]))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 22))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy)))
            if rng.random() < 0.2:
                base = copy
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), 4) == brute(rows, 4)


def test_keep_one(odd, documents):
    kept = M.keep_one(odd, shingle=4)
    assert kept.columns == odd.columns
    # of the words group its id 1, of the "word" group 7; rows without words all stay
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == ["1", "3", "4", "5", "6", "7", "9", "None"]
    want = sorted(k[0] for k in brute([tuple(r) for r in documents.select("doc_id", "text").collect()], 4) if k[3])
    assert sorted(r["doc_id"] for r in M.keep_one(documents, shingle=4).collect()) == want


def test_keep_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "A b c d e f"), (2, "a b c d e f"), (3, "other words stand here now")]
    kept = M.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3]


def test_pigeonhole(spark):
    """Every pair of signatures within the guaranteed distance shares a key."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 16, M.N_SYMBOLS).astype(np.uint16)
    rows = [(0, base.tobytes())]
    for n in range(1, 400):
        other = base.copy()
        at = rng.choice(M.N_SYMBOLS, M.GUARANTEED_DISTANCE, replace=False)
        other[at] = (other[at] + 1 + rng.integers(0, 1000, at.size)).astype(np.uint16)
        rows.append((n, other.tobytes()))
    keys = M._chunk_keys(spark.createDataFrame(rows, "node long, sig binary")).collect()
    mine = {r["key"] for r in keys if r["node"] == 0}
    assert {r["node"] for r in keys if r["key"] in mine} == set(range(400))


def test_hashes_do_not_depend_on_the_batch():
    texts = ["a b c d e", "x", "", None, "c d  e a b", "a b c d e"]
    alone = [list(M.shingle_sets(pa.array([t], pa.string()), 3))[0][1].tolist() for t in texts]
    assert [v.tolist() for _, v in M.shingle_sets(pa.array(texts, pa.string()), 3)] == alone


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 500)]
    got = {r["node"]: r["comp"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in range(500):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_empty(empty):
    assert M.near_duplicates(empty).count() == 0 and M.keep_one(empty).count() == 0


def test_tasks_that_count_keys_take_some_classes(spark, monkeypatch):
    from kindred.llm import minhash
    docs = spark.createDataFrame([(i, " ".join(f"w{i // 2}x{k}" for k in range(30)) + f" y{i}") for i in range(60)], "doc_id long, text string")
    want = sorted(map(tuple, minhash.near_duplicates(docs).select("doc_id", "component_id").collect()))
    dealt, keys = [], minhash._chunk_keys
    monkeypatch.setattr(minhash, "_chunk_keys", lambda classes: (dealt.append(classes.rdd.getNumPartitions()), keys(classes))[1])
    monkeypatch.setattr(minhash, "KEY_CLASSES", 10, raising=False)
    assert sorted(map(tuple, minhash.near_duplicates(docs).select("doc_id", "component_id").collect())) == want
    assert 7 in dealt and {b for _, b in want} == set(range(0, 60, 2))
