"""The classifiers against plain versions: loops over whole texts, no automaton,
no blocks, no partitions."""

import math

import numpy as np
import pytest

from kindred.llm import quality, toxicity


@pytest.fixture(scope="module")
def labels(spark, small):
    return spark.read.parquet(f"{small}/labels.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


# --- votes of neighbours ---------------------------------------------------------

def shape_counts(text):
    """How often each hashed trigram of byte shapes stands in the text, which ends with a blank."""
    out = np.zeros(quality.SHAPE_TERMS)
    shape = [int(quality._SHAPE[b]) for b in (text + " ").encode()]
    for a, b, c in zip(shape, shape[1:], shape[2:]):
        out[quality._SPREAD[(a * 32 + b) * 32 + c]] += 1
    return out


def test_quality_is_a_plain_vote(documents, labels, texts):
    import pyarrow as pa
    model = quality.fit(documents, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(documents, labels).collect()}
    assert got.keys() == texts.keys()
    counts = {i: quality.term_counts(pa.array([t]))[0].astype(float) for i, t in texts.items()}
    for i, t in texts.items():
        if counts[i].any():
            assert (counts[i][:quality.SHAPE_TERMS] == shape_counts(t)).all()

    # document frequencies over all documents
    some = [c for c in counts.values() if c.any()]
    df = np.sum([c > 0 for c in some], axis=0)
    idf = np.log((1 + len(some)) / (1 + df)) + 0.1
    assert np.allclose(idf, model["idf"])

    vectors = model["vectors"].T.astype(float)
    assert np.allclose(np.linalg.norm(vectors, axis=1), 1, atol=1e-4)
    n_ties = 0
    for i, c in counts.items():
        if not c.any():
            assert got[i] == 0
            continue
        x = np.log1p(c[:quality.SHAPE_TERMS]) * idf[:quality.SHAPE_TERMS]
        x = np.concatenate((x / max(np.linalg.norm(x), 1e-12),
                            c[quality.SHAPE_TERMS:] * quality.PSEUDO_WEIGHT * np.minimum(idf[quality.SHAPE_TERMS:], 3)))
        x = x @ model["axes"].astype(float)
        cosines = sorted(((float(x @ v) / np.linalg.norm(x), k) for k, v in enumerate(vectors)), reverse=True)
        near, beyond = cosines[:quality.NEIGHBOURS], cosines[quality.NEIGHBOURS:]
        if beyond and near[-1][0] - beyond[0][0] < 1e-6:  # which of equals is the last neighbour is open
            n_ties += 1
            continue
        pull = [(math.exp(20 * (s - near[0][0])) * float(model["weight"][k]), model["label"][k]) for s, k in near]
        assert got[i] == pytest.approx(sum(p for p, one in pull if one) / sum(p for p, _ in pull), abs=2e-3), i
    assert n_ties < len(counts) / 10


# --- votes of word lists ---------------------------------------------------------

def plain_read(text, reader, mined):
    """Features and votes by looking for every entry on its own."""
    low = text.lower()
    group = {w: g for g, words in enumerate(toxicity.WORDS) for w in words}
    for w, voter in mined:
        group.setdefault(w, voter)
    features, votes = set(), set()
    for i, entry in enumerate(reader.entries):
        word, whole = entry.rstrip(" "), entry.endswith(" ")
        at = low.find(word)
        while at >= 0:
            end = at + len(word)
            if not (at and low[at - 1].isalpha()) and not (whole and end < len(low) and low[end].isalpha()):
                features.add(i)
                votes.add(group[entry])
                break
            at = low.find(word, at + 1)
    for k, p in enumerate(toxicity.PATTERNS):
        if p.search(text if k >= 2 else low):
            features.add(len(reader.entries) + k)
            votes.add(toxicity.N_VOTERS - len(toxicity.PATTERNS) + k)
    return sorted(features), sorted(votes)


def plain_rates(n, both, balance):
    """Rates of the voters among toxic and clean texts, by triplets, without NumPy."""
    size = len(both)
    rate = [(both[i][i] + 0.01) / (n + 0.02) for i in range(size)]
    cov = [[both[i][j] / n - rate[i] * rate[j] for j in range(size)] for i in range(size)]
    used = [i for i in range(size) if both[i][i] >= 3]
    linked = [[False] * size for _ in range(size)]
    d = [0.0] * size
    for _ in range(2):
        for i in used:
            found = sorted(cov[i][j] * cov[i][k] / cov[j][k] for j in used for k in used
                           if i != j and i != k and j != k and cov[j][k] > 1e-9
                           and not (linked[i][j] or linked[i][k] or linked[j][k]))
            m = len(found)
            middle = (found[m // 2] + found[(m - 1) // 2]) / 2 if m else 0.0
            d[i] = math.sqrt(max(middle, 0.0))
        spread = [math.sqrt(r * (1 - r)) for r in rate]
        linked = [[i != j and (cov[i][j] - d[i] * d[j]) / max(spread[i] * spread[j], 1e-9) > 0.3 for j in range(size)]
                  for i in range(size)]
    gap = [x / math.sqrt(balance * (1 - balance)) for x in d]
    clip = lambda x: min(max(x, 1e-5), 1 - 1e-5)
    return ([clip(r + (1 - balance) * g) for r, g in zip(rate, gap)], [clip(r - balance * g) for r, g in zip(rate, gap)],
            [1 / (1 + sum(row)) for row in linked])


def test_toxicity_is_a_plain_scan(documents, labels, texts):
    model = toxicity.fit(documents, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(documents, labels).collect()}
    reader, mined = toxicity.Reader(model["mined"]), model["mined"]
    read = {i: plain_read(t, reader, mined) for i, t in texts.items()}
    for i, t in texts.items():
        assert reader.read(t) == read[i], i
        z = model["bias"] + sum(model["weights"][f] for f in read[i][0])
        assert got[i] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-6)

    # the label model rests on the votes of all documents
    both = [[0] * toxicity.N_VOTERS for _ in range(toxicity.N_VOTERS)]
    for _, votes in read.values():
        for a in votes:
            for b in votes:
                both[a][b] += 1
    found = toxicity.vote_moments(documents, "text", mined)
    assert found[0] == len(texts) and (found[1] == np.array(both)).all()
    m = model["labels"]
    toxic, clean, share = plain_rates(len(texts), both, m.balance)
    assert np.allclose(m.toxic_rate, toxic) and np.allclose(m.clean_rate, clean) and np.allclose(m.share, share)

    # posteriors one by one
    matrix = np.zeros((len(texts), toxicity.N_VOTERS))
    for row, (_, votes) in zip(matrix, read.values()):
        row[votes] = 1
    for p, (_, votes) in zip(m.posterior(matrix), read.values()):
        evidence = sum(min(max(math.log(toxic[v] / clean[v]), 0), toxicity.MOST_EVIDENCE) * share[v] for v in votes)
        z = math.log(m.balance / (1 - m.balance)) + min(evidence, 2 * toxicity.MOST_EVIDENCE)
        assert p == pytest.approx(1 / (1 + math.exp(-z)))


def test_linear_classifier_reaches_the_least_loss():
    """Against many plain gradient steps on soft targets."""
    rng = np.random.default_rng(11)
    x = (rng.random((400, 6)) < 0.3).astype(np.float32)
    target = 1 / (1 + np.exp(-(x @ np.array([3, -2, 1, 0, 0.5, -1]) - 0.5)))
    weight = rng.random(400) + 0.1

    def loss(w, b):
        z = x @ w + b
        return float((weight / weight.sum() * (np.logaddexp(0, z) - target * z)).sum() + 1e-5 * (w @ w))

    w, b = np.zeros(6), 0.0
    for _ in range(20_000):
        r = weight / weight.sum() * (1 / (1 + np.exp(-(x @ w + b))) - target)
        w, b = w - 1.0 * (x.T @ r + 2e-5 * w), b - 1.0 * r.sum()
    fitted = toxicity.fit_linear(x, target, weight)
    assert loss(*fitted) <= loss(w, b) + 1e-5
    assert np.abs(fitted[0] - w).max() < 0.05
