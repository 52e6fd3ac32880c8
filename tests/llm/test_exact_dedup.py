import hashlib
from collections import Counter

from pyspark.sql import functions as F

from kindred.llm import exact_dedup as X


def check(rows, got):
    texts = Counter((t or "") for _, t in rows)
    largest = {}
    for i, t in rows:
        if i is not None:
            largest[t or ""] = max(i, largest.get(t or "", i))
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in texts}
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        t = sha[r["text_sha256"]]
        assert r["group_size"] == texts[t] and r["keep_id"] == largest.get(t)
        kept[t] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert kept == Counter(dict.fromkeys(texts, 1))


def test_awkward_rows(odd, odd_rows):
    check([(r[0], r[1]) for r in odd_rows], X.exact_dedup(odd).collect())


def test_documents(documents):
    check([tuple(r) for r in documents.select("doc_id", "text").collect()], X.exact_dedup(documents).collect())


def test_identifiers_are_verified(odd, odd_rows):
    """With an identifier that confuses all chunks the groups stay the same."""
    check([(r[0], r[1]) for r in odd_rows], X.exact_dedup(odd, identifier=lambda c: F.lit(7).cast("long")).collect())


def test_chunks_join_to_the_text(documents):
    cut = documents.select("text", F.array_join(X.chunks(F.col("text")), "").alias("again"),
                           F.size(X.chunks(F.col("text"))).alias("n"))
    assert cut.filter("text <> again").count() == 0 and cut.agg(F.max("n")).first()[0] > 5


def test_an_insertion_changes_few_chunks(spark):
    lines = "".join(f"Sentence number {i} says something of its own. " for i in range(2000))
    frame = spark.createDataFrame([(1, lines), (2, "A new start. " + lines)], "doc_id long, text string")
    a, b = (set(r[0]) for r in frame.orderBy("doc_id").select(X.chunks(F.col("text"))).collect())
    assert len(a & b) > 0.5 * len(a)


def test_empty(empty):
    assert X.exact_dedup(empty).count() == 0


def test_native(documents):
    plan = X.exact_dedup(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
