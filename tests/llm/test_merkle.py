import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kindred.llm import merkle as M
from kindred.llm.sampling import remainder


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha("".join(last[i:i + fanout])) for i in range(0, len(last), fanout)])
    return out


def siblings(tree, at, fanout):
    """Left and right siblings per level."""
    for nodes in tree[:-1]:
        first = at - at % fanout
        yield "".join(nodes[first:at]), "".join(nodes[at + 1:first + fanout])
        at //= fanout


def plain(rows, fanout=2):
    """``(doc_id, leaf, subroot, root, proof, path)`` per row of ``doc_id, source, lang, n_chars, text``."""
    groups = {}
    for r in rows:
        leaf = sha("".join(enc(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"], leaf))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in langs:
        groups[g].sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        trees.append(levels([x[2] for x in groups[g]], fanout))
    top = levels([t[-1][0] for t in trees], fanout)
    for k, g in enumerate(langs):
        for at, (_, doc_id, leaf) in enumerate(groups[g]):
            path = [*siblings(trees[k], at, fanout), *siblings(top, k, fanout)]
            yield doc_id, leaf, trees[k][-1][0], top[-1][0], sha("".join(a + b for a, b in path))


def check(frame, **options):
    rows = [r.asDict() for r in frame.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = M.verify(M.manifest(frame, **options)).collect()
    got = Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in found)
    assert got == Counter(plain(rows, options.get("fanout", 2)))
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in found)


def test_awkward_rows(odd):
    check(odd)


@pytest.mark.parametrize("fanout,span", [(2, 1), (2, 4), (3, 2), (5, 1)])
def test_sizes(spark, fanout, span):
    """Groups of every small size, around the powers of the block's width."""
    rows = [(1000 * g + i, "s", None if g == 3 else f"g{g}é", i, f"t{i}") for g, n in enumerate((1, 2, 3, 4, 5, 16, 17, 33)) for i in range(n)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), fanout=fanout, span=span)


@pytest.mark.parametrize("n", [1, 2, 257])
def test_one_group(spark, n):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(n)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7))


def test_changed_leaves_are_found(documents):
    hit = remainder(F.col("doc_id"), 7) == 0
    found = M.verify(M.manifest(documents, changed={"n_chars": F.col("n_chars") + 1}, changes=hit)).withColumn("hit", hit)
    assert found.filter("hit").count() > 100 and found.filter(F.col("hit") == F.col("verified")).count() == 0
    assert found.select("root").distinct().count() == 1


def test_null_stays(odd):
    found = M.verify(M.manifest(odd, changed={"n_chars": F.col("n_chars") + 1}, changes=F.lit(True)))
    nulls = odd.filter("n_chars is null").count()
    assert nulls and found.filter("verified").count() == nulls


def test_partitions_change_nothing(spark, documents):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(documents.limit(300).union(documents.limit(5)).repartition(11))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_texts_are_not_shuffled(documents):
    plan = M.manifest(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any("text#" in line for line in plan.split("\n") if "Exchange" in line)


def test_empty(empty):
    assert M.verify(M.manifest(empty)).count() == 0
