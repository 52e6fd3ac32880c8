"""Toxicity by weak supervision.

* Voters: groups of a fixed word list, groups of a lexicon mined from labelled
  training texts (word beginnings and whole words), and patterns (shouting,
  exclamation, second-person attacks, masked words).  Each votes or abstains.
* Label model: with conditional independence the covariance of two voters is
  ``d_i * d_j``, where ``d_i`` grows with the voter's accuracy.  The pairwise
  moments of all votes over all documents give every ``d_i`` by the median over
  triplets of voters; pairs whose covariance exceeds ``d_i * d_j`` by far are
  correlated, and their evidence is shared.  With the class balance this gives
  each voter's rate among toxic and among clean texts, hence a posterior label.
  Where a training label exists it is one more voter of set accuracy.
* A linear classifier (logistic regression) on lexicon entries and patterns is
  trained on the posterior labels of the bounded sample, and scores every text.

An Aho-Corasick automaton over the lexicon reads each text once.  Bounded on
the driver: the sample's entries (``max_positive + max_negative`` texts), the
mined lexicon (``LEXICON`` entries) and the moments (voters squared).

Scores depend on the text alone: no id, language, source or label of the
document scored takes part.

Defined results: a null or empty text has the score of a text without any sign;
without labels only the fixed list and the patterns vote; repeated rows score
alike; other columns are ignored whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import bounded_broadcast, materialize
from kindred.llm.minhash import near_duplicates
from kindred.llm.sampling import labelled_sample, remainder
from kindred.session import ship_package

#: Groups of the fixed list; an entry matches words that begin with it.
WORDS = (
    ("idiot", "moron", "imbecil", "cretin", "dumbass", "halfwit", "dimwit", "nitwit"),
    ("stupid", "brainless", "clueless", "ignoramus"),
    ("loser", "clown", "freak", "creep", "weirdo"),
    ("pathetic", "worthless", "useless idiot", "good for nothing"),
    ("scum", "trash", "garbage human", "vermin", "filth"),
    ("disgusting", "repulsive", "revolting"),
    ("kill yourself", "drop dead", "go die", "shut up"),
    ("hate you", "despise you", "loathe you"),
    ("fuck", "shit", "bitch", "bastard", "asshole", "cunt"),
)
#: Mined entries vote in this many groups for each of two tiers: entries at
#: least ``STRONG_ODDS`` times as frequent in toxic texts, and weaker ones.
MINED_GROUPS = 6
STRONG_ODDS = 50
LEXICON = 1500
#: An entry must stand in so many toxic texts, and in this share of them (a few
#: copies of one text would otherwise make all its words entries).
MIN_TEXTS = 5
MIN_SHARE = 0.02
PREFIXES = (4, 5, 6, 7)
MAX_POSITIVE = 3000
MAX_NEGATIVE = 6000
#: Accuracy of a training label as a voter.
LABEL_ACCURACY = 0.995
#: Log odds that one voter can add.
MOST_EVIDENCE = 4.0
THRESHOLD = 0.7
HELD_OUT = (3, 1)

PATTERNS = (
    re.compile(r"\b(?:you|u|ur|your|you're) (?:are |is |all |such |a |an |the |so )*(?:dumb|ugly|sick|insane|nothing)\b"),
    re.compile(r"\b(?:f|s|b)[*@#$]{2,}\w*"),
    re.compile(r"!{3,}"),
    re.compile(r"\b[A-Z]{4,}(?:[ ,]+[A-Z]{4,}){4,}"),
)
N_VOTERS = len(WORDS) + 2 * MINED_GROUPS + len(PATTERNS)
_WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str) -> set[str]:
    """Lower-case whole words (with a blank behind) and word beginnings."""
    words = set(_WORD.findall(text.lower()))
    out = {w + " " for w in words if 3 <= len(w) <= 20}
    for n in PREFIXES:
        out.update(w[:n] for w in words if len(w) >= n)
    return out


def _one_of_near_copies(sample: DataFrame) -> DataFrame:
    """``text, label``: one text of each label in each near-copy component of
    the (bounded) sample, as ``minhash`` confirms them on full sets."""
    texts = sample.select("text", "label", F.xxhash64("text").alias("_hash"))
    families = near_duplicates(texts, "_hash").select(F.col("doc_id").alias("_hash"), F.col("component_id").alias("_family"))
    families = materialize(families.distinct(), "toxic-components")
    return (texts.join(bounded_broadcast(families), "_hash").groupBy("_family", "label")
            .agg(F.min("text").alias("text")).select("text", "label"))


def voter_of(entry: str, strong: bool) -> int:
    """The voter of a mined entry.  Nested entries (a word and its beginnings)
    share one, so that voters are less dependent."""
    return len(WORDS) + (0 if strong else MINED_GROUPS) + sum(map(ord, entry[:PREFIXES[0]])) % MINED_GROUPS


def mine_lexicon(sample: DataFrame, size: int = LEXICON, min_texts: int = MIN_TEXTS,
                 min_share: float = MIN_SHARE) -> list[tuple[str, int]]:
    """``(entry, voter)`` of the entries that most favour toxic texts, by log
    odds times the square root of their support.  Of near copies one text
    counts, or all their words would seem to favour its label."""
    def run(batches):
        ones, zeros = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (ones if label else zeros).update(features_of(text))
        names = list(ones.keys() | zeros.keys())
        for i in range(0, len(names), 50_000):
            some = names[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([ones[x] for x in some], pa.int64()),
                                              pa.array([zeros[x] for x in some], pa.int64())],
                                             names=["entry", "ones", "zeros"])

    sample = materialize(_one_of_near_copies(sample), "toxic-families")
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []
    counts = (sample.select("text", "label").mapInArrow(run, "entry string, ones long, zeros long")
              .groupBy("entry").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")))
    odds = F.log(((F.col("ones") + 0.5) / (n1 + 1)) / ((F.col("zeros") + 0.5) / (n0 + 1)))
    best = (counts.filter(F.col("ones") >= max(min_texts, min_share * n1)).withColumn("odds", odds).filter("odds > 2")
            .orderBy((F.col("odds") * F.sqrt("ones")).desc(), "entry").limit(size))
    return [(r["entry"], voter_of(r["entry"], r["odds"] >= np.log(STRONG_ODDS))) for r in best.collect()]


class Reader:
    """Reads a text once: the lexicon entries and patterns in it, and the votes."""

    def __init__(self, mined: list[tuple[str, int]]):
        import ahocorasick
        fixed = [(w, g) for g, group in enumerate(WORDS) for w in group]
        groups = dict(fixed)
        for w, voter in mined:
            groups.setdefault(w, voter)
        self.entries = sorted(groups)
        self.n_features = len(self.entries) + len(PATTERNS)
        automaton = ahocorasick.Automaton()
        for i, w in enumerate(self.entries):
            automaton.add_word(w.rstrip(" "), (i, len(w.rstrip(" ")), w.endswith(" "), groups[w]))
            if w.endswith(" "):  # a whole word and a beginning may be spelt alike
                other = w.rstrip(" ")
                if other in groups:
                    automaton.add_word(other, (self.entries.index(other), len(other), False, groups[other], i, groups[w]))
        automaton.make_automaton()
        self._iter = automaton.iter

    def read(self, text: str) -> tuple[list[int], list[int]]:
        """``(features, voters that vote)``, both sorted."""
        low = text.lower()
        found, votes = set(), set()
        n = len(low)
        for end, (i, size, whole, group, *also) in self._iter(low) if self.entries else ():
            begin = end - size + 1
            if begin and low[begin - 1].isalpha():
                continue
            ends_word = end + 1 == n or not low[end + 1].isalpha()
            if not whole or ends_word:
                found.add(i)
                votes.add(group)
            if also and ends_word:
                found.add(also[0])
                votes.add(also[1])
        for k, p in enumerate(PATTERNS):
            if p.search(text if k >= 2 else low):
                found.add(len(self.entries) + k)
                votes.add(len(WORDS) + 2 * MINED_GROUPS + k)
        return sorted(found), sorted(votes)


def vote_moments(docs: DataFrame, text_col: str, mined: list[tuple[str, int]]) -> tuple[float, np.ndarray]:
    """The number of documents and, for each pair of voters, how many both vote on."""
    def run(batches):
        reader, both, n = Reader(mined), np.zeros((N_VOTERS, N_VOTERS), np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                n += 1
                votes = reader.read(value.as_py() or "")[1]
                if votes:
                    both[np.ix_(votes, votes)] += 1
        at = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array([*at.tolist(), -1]), pa.array([*both.ravel()[at].tolist(), n])],
                                         names=["pair", "n"])

    both, n = np.zeros(N_VOTERS ** 2), 0.0
    moments = docs.select(text_col).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    for r in moments.collect():  # N_VOTERS ** 2 + 1 rows at most
        if r["pair"] < 0:
            n = float(r["n"])
        else:
            both[r["pair"]] = r["n"]
    return n, both.reshape(N_VOTERS, N_VOTERS)


class LabelModel:
    """Accuracies and correlations of the voters from their pairwise moments."""

    def __init__(self, n: float, both: np.ndarray, balance: float):
        self.balance = float(np.clip(balance, 1e-4, 0.5))
        n = max(n, 1.0)
        rate = (both.diagonal() + 0.01) / (n + 0.02)
        cov = both / n - np.outer(rate, rate)
        used = np.flatnonzero(both.diagonal() >= 3)
        d = np.zeros(len(rate))
        self.correlated = np.zeros(both.shape, bool)
        for _ in range(2):  # once with all pairs, once without the correlated ones
            for i in used:
                squares = []
                for j in used:
                    for k in used:
                        if len({i, j, k}) == 3 and not (self.correlated[i, j] or self.correlated[i, k]
                                                        or self.correlated[j, k]) and cov[j, k] > 1e-9:
                            squares.append(cov[i, j] * cov[i, k] / cov[j, k])
                d[i] = np.sqrt(max(np.median(squares), 0.0)) if squares else 0.0
            spread = np.sqrt(rate * (1 - rate))
            extra = (cov - np.outer(d, d)) / np.maximum(np.outer(spread, spread), 1e-9)
            self.correlated = (extra > 0.3) & ~np.eye(len(rate), dtype=bool)
        p = self.balance
        gap = d / np.sqrt(p * (1 - p))  # P(votes | toxic) - P(votes | clean)
        self.toxic_rate = np.clip(rate + (1 - p) * gap, 1e-5, 1 - 1e-5)
        self.clean_rate = np.clip(rate - p * gap, 1e-5, 1 - 1e-5)
        # A group of correlated voters shares the evidence of one.
        self.share = 1 / (1 + self.correlated.sum(axis=1))

    def posterior(self, votes: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
        """P(toxic) for rows of 0/1 votes; ``labels``: 1, 0 or nan.  A voter that
        does not vote abstains: it says nothing."""
        on = np.clip(np.log(self.toxic_rate / self.clean_rate), 0, MOST_EVIDENCE) * self.share
        prior = np.log(self.balance / (1 - self.balance))
        z = prior + np.minimum(votes @ on, 2 * MOST_EVIDENCE)
        if labels is not None:
            known = np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
            z = z + np.where(np.isnan(labels), 0, np.where(labels == 1, known - prior, -known))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, target: np.ndarray, weight: np.ndarray, steps: int = 400,
               penalty: float = 2e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by accelerated gradient steps."""
    weight = (weight / weight.sum()).astype(np.float32)
    x = np.concatenate((x, np.ones((len(x), 1), np.float32)), axis=1)  # the last weight is the bias
    v = np.ones(x.shape[1], np.float32)
    for _ in range(30):  # the largest curvature, by power iteration
        v = x.T @ (weight * (x @ v))
        top = float(np.linalg.norm(v))
        v /= top
    rate = 1 / (0.26 * top + penalty)
    keep = np.full(x.shape[1], penalty, np.float32)
    keep[-1] = 0
    w = last = np.zeros(x.shape[1], np.float32)
    target = target.astype(np.float32)
    for t in range(steps):
        y = w + t / (t + 3) * (w - last)
        r = weight * (1 / (1 + np.exp(-np.clip(x @ y, -30, 30))) - target)
        last, w = w, (y - rate * (x.T @ r + keep * y)).astype(np.float32)
    w, b = w[:-1].astype(float), float(w[-1])
    return w, b


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        held_out: tuple[int, int] = HELD_OUT, max_positive: int = MAX_POSITIVE,
        max_negative: int = MAX_NEGATIVE) -> dict:
    """The model: mined lexicon, weights, bias, label model."""
    ship_package(docs.sparkSession)
    out = remainder(F.col(id_col), held_out[0]) == held_out[1]
    sample = labelled_sample(docs, labels, label_col, out, {0: max_negative, 1: max_positive}, id_col, text_col)
    mined = mine_lexicon(sample)
    n, both = vote_moments(docs, text_col, mined)

    def run(batches):
        reader = Reader(mined)
        for batch in batches:
            read = [reader.read(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in read], pa.list_(pa.int64())), pa.array([v for _, v in read], pa.list_(pa.int64())),
                 batch.column(1), batch.column(2)], names=["features", "votes", "label", "of_class"])

    rows = sample.mapInArrow(run, "features array<long>, votes array<long>, label int, of_class long").collect()
    rows.sort(key=lambda r: (r["label"], r["features"], r["votes"]))
    reader = Reader(mined)
    sizes = {r["label"]: r["of_class"] for r in rows}
    balance = sizes.get(1, 0) / max(sum(sizes.values()), 1) or 0.05
    model = LabelModel(n, both, balance)
    if not rows:  # only the fixed list and the patterns: each adds what the label model cannot know
        return {"mined": mined, "weights": np.full(reader.n_features, 3.0), "bias": -3.0, "labels": model}
    x, votes = np.zeros((len(rows), reader.n_features), np.float32), np.zeros((len(rows), N_VOTERS))
    for i, r in enumerate(rows):
        x[i, r["features"]] = 1
        votes[i, r["votes"]] = 1
    label = np.array([r["label"] for r in rows], float)
    target = model.posterior(votes, label)
    in_sample = {c: max((label == c).sum(), 1) for c in (0, 1)}
    # Toxic texts count for more than their share: half as much as clean ones in all.
    weight = np.where(label == 1, 0.33 / in_sample[1], 0.67 / in_sample[0])
    weights, bias = fit_linear(x, target, weight)
    fixed = {w for group in WORDS for w in group}
    seen = x.sum(axis=0)
    for i, w in enumerate(reader.entries):  # listed words that the sample never shows keep a prior weight
        if w in fixed and seen[i] == 0:
            weights[i] = 3.0
    return {"mined": mined, "weights": weights, "bias": bias, "labels": model}


def _scored(docs: DataFrame, model: dict, text_col: str, fields: list[str]) -> DataFrame:
    """The named columns as ``c0``, ``c1``, ... and ``_score``."""
    shared = docs.sparkSession.sparkContext.broadcast({k: model[k] for k in ("mined", "weights", "bias")})
    sent = list(dict.fromkeys([*fields, text_col]))  # the text goes to the workers once
    slim = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(sent)])
    n, at = len(fields), sent.index(text_col)

    def run(batches):
        m = shared.value
        reader, weights, bias = Reader(m["mined"]), m["weights"], m["bias"]
        for batch in batches:
            z = np.array([bias + sum(weights[i] for i in reader.read(v.as_py() or "")[0])
                          for v in batch.column(at)], float)
            score = pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], score], names=[*batch.schema.names[:n], "_score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema.fields[:n])
    return slim.mapInArrow(run, f"{schema}, _score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                   text_col: str = "text", held_out: tuple[int, int] = HELD_OUT, threshold: float = THRESHOLD,
                   **options) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``."""
    model = fit(docs, labels, label_col, id_col, text_col, held_out, **options)
    held = F.coalesce(remainder(F.col("c0"), held_out[0]) == held_out[1], F.lit(False))
    return _scored(docs, model, text_col, [id_col]).select(
        F.col("c0").alias("doc_id"), held.alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
               text_col: str = "text", held_out: tuple[int, int] = HELD_OUT, threshold: float = THRESHOLD,
               **options) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    model = fit(docs, labels, label_col, id_col, text_col, held_out, **options)
    kept = _scored(docs, model, text_col, docs.columns).filter(F.col("_score") < threshold)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
