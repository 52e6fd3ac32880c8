import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kindred.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    """The contract's counts, word by word."""
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    inside = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


TEXT = st.lists(st.sampled_from(["a", "b", "é", "#", "|", " ", " ", "\n", "\t", "\x1c", " ", " ", "\x0b", "a b a b a ", "xx|"]),
                max_size=60).map("".join)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_base_counts(text):
    assert Q.measure(text)[0] == plain_base(text)


@given(st.sampled_from(Q.RULES), st.floats(0, 80))
def test_levels(rule, value):
    assert Q._level(rule, value) == rule.level(value)


def exact_tail(k, n, p):
    return float(sum(Fraction(math.comb(n, i)) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)))


@pytest.mark.parametrize("n", [1, 7, 60, 300])
def test_binomial_tail(n):
    for p in (Fraction(1, 100), Fraction(1, 3), Fraction(9, 10)):
        for k in {0, 1, n // 50, n // 3, n // 2, n - 1, n}:
            assert Q.binomial_tail(k, n, float(p)) == pytest.approx(exact_tail(k, n, p), rel=1e-9, abs=1e-12)


def test_upper_bound():
    assert Q.upper_bound(0, 100, 0.95) == pytest.approx(1 - 0.05 ** 0.01)
    for k, n in ((3, 40), (0, 500), (20, 900)):
        assert exact_tail(k, n, Fraction(Q.upper_bound(k, n, 0.99))) == pytest.approx(0.01, rel=1e-6)
    assert Q.upper_bound(5, 5, 0.95) == 1 and Q.upper_bound(0, 0, 0.95) == 1
    # At ALPHA and four strata, 437 good texts of which none is rejected are just enough.
    enough = 1 - Q.DELTA / 4
    assert Q.upper_bound(0, 437, enough) <= 0.01 + 3e-5 and Q.upper_bound(0, 430, enough) > Q.ALPHA


def plain_verdicts(docs, labels, alpha, delta, lift):
    """Whole judgement over lists: base rules, then every step of every stratum in turn."""
    given = defaultdict(list)
    for i, label in labels:
        if i is not None and label in (0, 1):
            given[i].append(label)
    measured = [(d, s, key, *Q.measure(t)) for d, t, s, key in docs]
    texts = {}
    for d, s, key, _, levels in measured:
        if given.get(d):
            ones, n, _ = texts.get((s, key), (0, 0, None))
            texts[s, key] = ones + sum(given[d]), n + len(given[d]), levels
    return measured, {k: (2 * ones >= n, levels) for k, (ones, n, levels) in texts.items()}


def rejected(levels, steps):
    return any(levels[rule] <= k for rule, k in steps)


def compare(spark, frame, labels, alpha, delta=0.05, lift=10.0):
    docs = [tuple(r) for r in frame.select("doc_id", "text", "lang", F.xxhash64("text")).collect()]
    measured, texts = plain_verdicts(docs, [tuple(r) for r in labels.select("doc_id", "quality").collect()], alpha, delta, lift)
    half = {r["k"]: r["h"] for r in spark.createDataFrame([(k,) for _, k in texts] or [(0,)], "k long").select(
        "k", (F.pmod(F.xxhash64("k"), F.lit(2)) == 0).alias("h")).collect()}
    tuning = [(g, lv) for (s, k), (g, lv) in texts.items() if not half[k]]
    n_good, n_bad = sum(g for g, _ in tuning), sum(not g for g, _ in tuning)
    steps = []
    for rule in range(len(Q.RULES)):
        for k in range(Q.GRID):
            good = sum(g and lv[rule] <= k for g, lv in tuning)
            bad = sum(not g and lv[rule] <= k for g, lv in tuning)
            if bad and bad / n_bad >= lift * (good + 1) / (n_good + 1):
                steps.append((good, -bad, rule, k))
    steps = [(r, k) for *_, r, k in sorted(steps)]
    hold = defaultdict(list)
    for (s, k), (good, levels) in texts.items():
        if half[k] and good:
            hold[s].append(levels)
    standing = {}
    for s, rows in hold.items():
        confidence = 1 - delta / len(hold)
        n = 0
        if Q.upper_bound(0, len(rows), confidence) <= alpha:
            while n < len(steps) and Q.upper_bound(sum(rejected(lv, steps[:n + 1]) for lv in rows), len(rows), confidence) <= alpha:
                n += 1
        standing[s] = n
    want = Counter()
    for d, s, key, base, levels in measured:
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        want[d, *base, failed, not failed and not rejected(levels, steps[:standing.get(s, 0)])] += 1
    got = Q.judge(frame, labels, alpha=alpha, delta=delta, min_lift=lift).collect()
    assert Counter((r["doc_id"], *(r[c] for c in Q.BASE), r["base_failed"], r["kept"]) for r in got) == want
    for r in got:
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])
    return standing, steps, got


def test_documents(spark, documents, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    standing, _, _ = compare(spark, documents, labels, Q.ALPHA)
    assert set(standing.values()) == {0}  # too few labels for a share of 1 %
    standing, steps, got = compare(spark, documents, labels, 0.2)
    assert steps and max(standing.values()) > 0 and any(r["failed_rules"] for r in got)


def test_risk_is_held(spark):
    """Good texts of which one in ten looks bad, in one stratum only."""
    rows = []
    for i in range(6000):
        s = ("x", "y", None)[i % 3]
        bad = i % 5 == 0
        signs = bad or (s == "y" and i % 10 == 1)
        rows.append((i, " ".join(f"w{i}{j}" + ("|" if signs else "") for j in range(30)), s, 0 if bad else 1))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    standing, _, got = compare(spark, frame, frame.select("doc_id", "quality"), 0.02)
    assert standing["x"] > 0 and standing[None] > 0 and standing["y"] < standing["x"]
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[i] for i in range(6000) if i % 5 == 0 and i % 3 != 1)
    assert all(kept[i] for i in range(6000) if i % 5)


def test_awkward_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None), (6, 7)], "doc_id long, quality int")
    compare(spark, odd, labels, Q.ALPHA)
    compare(spark, odd, labels.filter("1 = 0"), Q.ALPHA)


def test_cutoffs(spark, documents, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    order, limits = Q.calibrate(Q.measures(documents), labels, alpha=0.2)
    for r in Q.cutoffs(order, limits).collect():
        strictest = {}
        for rule, k in order[:r["n_steps"]]:
            strictest[Q.RULES[rule].name] = max(k, strictest.get(Q.RULES[rule].name, 0))
        by_name = {rule.name: rule for rule in Q.RULES}
        assert r["cutoffs"] == {n: pytest.approx(float(by_name[n].cutoffs[k])) for n, k in strictest.items()}
        assert r["n_steps"] == 0 or r["bound"] <= 0.2


def test_empty(empty, spark):
    assert Q.judge(empty, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 0
