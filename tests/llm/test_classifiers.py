import zlib

import numpy as np
import pytest

from kindred.llm import quality, toxicity


def held_out(i, modulus, rest):
    return i is not None and zlib.crc32(str(i).encode()) % modulus == rest


def auc(score, label):
    score, label = np.array(score), np.array(label)
    pos, neg = score[label == 1], score[label == 0]
    return ((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2)


@pytest.mark.parametrize("score, column, split, least", [
    (quality.score_quality, "quality", (5, 0), 0.95), (toxicity.score_toxicity, "toxic", (3, 1), 0.88)])
def test_held_out_accuracy(spark, documents, small, score, column, split, least):
    """This table has some 400 labels, about 30 of them toxic texts to learn
    from, too few for the signs that rarely occur (README: figures at scale)."""
    labels = spark.read.parquet(f"{small}/labels.parquet")
    got = score(documents, labels).collect()
    assert len(got) == documents.count()
    truth = {r["doc_id"]: r[column] for r in labels.collect()}
    assert all(r["held_out"] == held_out(r["doc_id"], *split) and 0 <= r["score"] <= 1 for r in got)
    test = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert auc([r["score"] for r in test], [truth[r["doc_id"]] for r in test]) > least
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in test]) > 0.93


@pytest.mark.parametrize("score, column, split", [(quality.score_quality, "quality", (5, 0)),
                                                 (toxicity.score_toxicity, "toxic", (3, 1))])
def test_held_out_labels_are_not_used(spark, documents, small, score, column, split):
    """Turning every held-out label round, or leaving it out, changes no score."""
    labels = spark.read.parquet(f"{small}/labels.parquet").collect()
    some = documents.limit(400).cache()

    def run(change):
        rows = [(r["doc_id"], change(r[column]) if held_out(r["doc_id"], *split) else r[column]) for r in labels]
        frame = spark.createDataFrame(rows, f"doc_id long, {column} int")
        return {r["doc_id"]: r["score"] for r in score(some, frame).collect()}

    first = run(lambda x: x)
    assert run(lambda x: 1 - x) == first and run(lambda x: None) == first


@pytest.mark.parametrize("score, column", [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_awkward_rows(spark, odd, empty, score, column):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (6, 0), (7, 1), (None, 1), (99, 0), (9, 5)],
                                   f"doc_id long, {column} int")
    got = score(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1  # equal texts
    blank = {r["score"] for r in got if r["doc_id"] in (3, 4)}
    assert len(blank) == 1
    assert score(empty, labels).count() == 0
    assert score(odd, labels.filter("1 = 0")).count() == odd.count()


def test_fixed_words_without_labels(spark):
    docs = spark.createDataFrame([(1, "you stupid idiot, what a pathetic loser"), (2, "a calm and friendly text")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, labels).collect()}
    assert got == {1: 1, 2: 0}


def test_drop_toxic(spark, odd):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(odd, labels)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_a_text_goes_to_the_workers_once(odd, monkeypatch):
    sent, run = [], type(odd).mapInArrow
    monkeypatch.setattr(type(odd), "mapInArrow", lambda self, *a, **b: (sent.append(self.columns), run(self, *a, **b))[1])
    model = {"mined": [], "weights": [], "bias": 0.0}
    assert toxicity._scored(odd, model, "text", odd.columns).columns == [*(f"c{i}" for i in range(len(odd.columns))), "_score"]
    assert toxicity._scored(odd, model, "text", ["doc_id"]).columns == ["c0", "_score"]
    assert [len(x) for x in sent] == [len(odd.columns), 2]


def test_only_near_copies_count_once(spark):
    """Texts that share a common passage, or end in a sign, are no copies."""
    common = " ".join("abcdefghij"[k % 10] * 3 + "klmnopqrst"[k // 10] for k in range(30))

    def own(i, n):
        return " ".join(f"{'abcdefghij'[i // 10]}{'klmnopqrst'[i % 10]}{'uvwxyz'[k % 6]}{'abcdefghij'[k // 6]}" for k in range(n))

    apart = [(f"{common} {own(i, 40)}!", i % 2) for i in range(40)]
    copy = [(f"{own(50, 60)} {own(51, 60)} last{x}", 1) for x in "abc"]
    got = toxicity._one_of_near_copies(spark.createDataFrame(apart + copy, "text string, label int")).collect()
    left = {(r["text"], r["label"]) for r in got}
    assert len(got) == 41 and left >= set(apart) and len(left & set(copy)) == 1


def test_label_model_finds_accuracies():
    """Independent voters of known rates, two of them copies of each other."""
    rng = np.random.default_rng(3)
    n, p = 200_000, 0.1
    y = rng.random(n) < p
    toxic, clean = np.array([0.8, 0.6, 0.4, 0.7, 0.5, 0.3]), np.array([0.02, 0.05, 0.01, 0.1, 0.02, 0.03])
    votes = np.zeros((n, toxicity.N_VOTERS), bool)
    votes[:, :6] = np.where(y[:, None], rng.random((n, 6)) < toxic, rng.random((n, 6)) < clean)
    votes[:, 6] = votes[:, 5]
    both = votes.astype(float).T @ votes
    model = toxicity.LabelModel(n, both, p)
    assert np.abs(model.toxic_rate[:5] - toxic[:5]).max() < 0.05 and np.abs(model.clean_rate[:5] - clean[:5]).max() < 0.02
    assert model.correlated[5, 6] and model.share[5] < 1
    assert auc(model.posterior(votes[:5000].astype(float)), y[:5000]) > 0.9
