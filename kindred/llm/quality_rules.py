"""Quality rules with risk-controlled cutoffs.

Every text is measured once (counts of words, signs, repeated lines and
repeated word windows).  A rule compares one measure with a cutoff out of a
fixed grid, from lenient to strict.  Which cutoffs hold is decided per stratum
(``lang``) from labelled documents:

* Labelled texts, each distinct one once, are dealt by a hash of the text into
  a tuning and a holdout half, so that copies never lie in both.
* The tuning half, over all strata, orders the steps (a rule and one of its
  cutoffs) from the fewest good texts rejected to the most.  Steps that do not
  reject bad texts ``MIN_LIFT`` times as often as good ones are left out.
* The holdout half certifies, per stratum: after each step the number of its
  good texts that any rule so far rejects is counted, and the step stands if
  the exact binomial (Clopper-Pearson) upper bound of the share of good texts
  rejected is at most ``ALPHA``.  Testing goes on in the fixed order until the
  first step that fails, so no further correction is due within a stratum; over
  the S strata every bound has confidence ``1 - DELTA / S`` (Bonferroni).

With probability ``1 - DELTA`` at least, the rules that stand reject at most a
share ``ALPHA`` of the good texts of every stratum at once.  A stratum with too
few good labels to show that (at ``ALPHA`` = 0.01 and four strata, 437) keeps
everything the base rules keep.

All labelled texts take part (counts, combined map-side); the driver sees one
row per step (rules times cutoffs, at most ``len(RULES) * GRID``).

Defined results: a null text has no words and fails the base rules, as an empty
one does; a null stratum is a stratum of its own; a null id takes no label;
labels other than 0 and 1 are ignored; a text with both labels counts as the
more frequent one, 1 on ties; repeated rows give repeated results; without
labels only the base rules decide; empty tables give an empty result; other
columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import bounded_broadcast, materialize
from kindred.session import ship_package

#: Share of good texts that the rules of one stratum may reject, and the
#: probability that any stratum's share is above it.
ALPHA, DELTA = 0.01, 0.05
#: A step must reject bad texts this many times as often as good ones.
MIN_LIFT = 10.0
GRID = 20
#: Base rules, set by the query's contract.
MIN_WORDS, WINDOW, REPEAT_PERCENT = 10, 5, 20

SIGNS = b"#*$%&|<>"
SPACE = b"\t\n\x0b\x0c\r "
_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalpha())
_UPPER = bytes(range(0x41, 0x5B))


@dataclass(frozen=True)
class Rule:
    """``measure`` above (``high``) or below the cutoff rejects."""
    name: str
    high: bool
    lenient: float
    strict: float

    @property
    def cutoffs(self) -> np.ndarray:
        return np.geomspace(self.lenient, self.strict, GRID)

    def level(self, value: float) -> int:
        """The first of the cutoffs that rejects ``value``; ``GRID`` if none does."""
        hit = value > self.cutoffs if self.high else value < self.cutoffs
        return int(hit.argmax()) if hit.any() else GRID


RULES = (
    Rule("sign_share", True, 0.5, 0.002),          # signs of a code point
    Rule("mark_share", True, 0.8, 0.02),           # ASCII digits and punctuation of a code point
    Rule("upper_share", True, 0.8, 0.01),          # A-Z of a code point
    Rule("repeat_share", True, 0.2, 0.005),        # words in repeated windows
    Rule("stutter_share", True, 0.5, 0.01),        # words equal to the one before
    Rule("repeated_line_share", True, 0.9, 0.02),  # lines with words that an earlier one equals
    Rule("long_words", True, 40.0, 5.0),           # code points a word
    Rule("short_words", False, 1.2, 5.0),
    Rule("few_words", False, 10.0, 60.0),
)
_CUTOFFS = {r.name: r.cutoffs for r in RULES}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# -- measures -----------------------------------------------------------------

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                np.uint64)


def repeated_words(words: list[bytes], width: int = WINDOW) -> tuple[int, np.ndarray]:
    """How many words lie in windows of ``width`` words found twice or more, and
    the words' hashes.  Windows are told apart by hash first; only those with
    an equal hash are compared as they are, so the count is exact."""
    n = len(words)
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    if n <= width:
        return 0, hashes
    mixed = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        mixed += (hashes[k:n - width + 1 + k] ^ (hashes[k:n - width + 1 + k] >> np.uint64(29))) * _ODD[k % len(_ODD)]
    order = np.sort(mixed)
    twice = order[1:][order[1:] == order[:-1]]
    if not twice.size:
        return 0, hashes
    at = np.flatnonzero(np.isin(mixed, twice))
    found = [b" ".join(words[i:i + width]) for i in at.tolist()]
    times = Counter(found)
    inside = np.zeros(n, bool)
    starts = at[np.fromiter((times[f] > 1 for f in found), bool, len(found))]
    for k in range(width):
        inside[starts + k] = True
    return int(inside.sum()), hashes


def measure(text: str | None) -> tuple[tuple[int, ...], list[int]]:
    """The base counts of a text and the level of each rule."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, n_chars = len(words), len(text or "")
    chars = n_chars - (len(raw) - len(raw.translate(None, SPACE)))
    signs = len(raw) - len(raw.translate(None, SIGNS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats, hashes = repeated_words(words)
    base = (n, chars, signs, dup_lines, repeats)
    if not n:
        return base, [GRID] * len(RULES)
    marks = len(raw) - len(raw.translate(None, _MARKS))
    upper = len(raw) - len(raw.translate(None, _UPPER))
    stutter = int((hashes[1:] == hashes[:-1]).sum())
    values = {
        "sign_share": signs / n_chars, "mark_share": marks / n_chars, "upper_share": upper / n_chars,
        "repeat_share": repeats / n, "stutter_share": stutter / n, "repeated_line_share": dup_lines / len(lines),
        "long_words": chars / n, "short_words": chars / n, "few_words": float(n),
    }
    return base, [_level(r, values[r.name]) for r in RULES]


def _level(rule: Rule, value: float) -> int:
    cutoffs = _CUTOFFS[rule.name]
    if rule.high:  # falling cutoffs: rejected from the first one below the value
        return int(np.searchsorted(-cutoffs, -value, side="right"))
    return int(np.searchsorted(cutoffs, value, side="right"))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """One row per document: ``doc_id, stratum``, the base counts, ``levels``
    (per rule, the first cutoff that rejects) and ``text_key``."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"),
                       F.xxhash64(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                some = batch.slice(begin, 512)
                base, levels = zip(*(measure(t) for t in some.column(3).to_pylist()))
                columns = [pa.array(c, pa.int64()) for c in zip(*base)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), some.column(2), *columns, pa.array(levels, pa.list_(pa.int32()))],
                    names=["doc_id", "stratum", "text_key", *BASE, "levels"])

    counts = ", ".join(f"{c} long" for c in BASE)
    return rows.mapInArrow(count, f"doc_id {kind}, stratum string, text_key long, {counts}, levels array<int>")


# -- cutoffs ------------------------------------------------------------------

def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X, exact: terms from the k-th downwards until
    they no longer count (they fall, for k below the mean; else all are summed)."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    log_p, log_q = math.log(p), math.log1p(-p)

    def term(i: int) -> float:
        return math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q)

    if k > n * p:  # the other tail has the smaller sum
        total, i = 0.0, k + 1
        while i <= n:
            t = term(i)
            total += t
            if t < total * 1e-18:
                break
            i += 1
        return max(0.0, 1.0 - total)
    total = 0.0
    for i in range(k, -1, -1):
        t = term(i)
        total += t
        if t < total * 1e-18:
            break
    return min(1.0, total)


def upper_bound(k: int, n: int, confidence: float) -> float:
    """Clopper-Pearson: the largest share p with ``P(X <= k) >= 1 - confidence``."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if binomial_tail(k, n, mid) > 1 - confidence:
            low = mid
        else:
            high = mid
    return high


def step_order(tuning: DataFrame, min_lift: float = MIN_LIFT) -> list[tuple[int, int]]:
    """``(rule, cutoff)`` from the fewest good texts rejected to the most, from
    ``good, levels`` rows.  Collects one row per rule, level and label."""
    by_level = (tuning.select("good", F.posexplode("levels").alias("rule", "level"))
                .groupBy("rule", "level", "good").agg(F.count("*").alias("n")).collect())
    n = {True: 0, False: 0}
    rejected = np.zeros((2, len(RULES), GRID + 1), np.int64)
    for r in by_level:
        rejected[int(r["good"]), r["rule"], r["level"]] += r["n"]
        n[r["good"]] += r["n"] if r["rule"] == 0 else 0
    rejected = rejected[:, :, :GRID].cumsum(axis=2)  # rejected at a cutoff: those of its level and below
    steps = []
    for rule in range(len(RULES)):
        for k in range(GRID):
            good, bad = int(rejected[1, rule, k]), int(rejected[0, rule, k])
            share = (good + 1) / (n[True] + 1)
            if bad and bad / n[False] >= min_lift * share:
                steps.append((good, -bad, rule, k))
    return [(rule, k) for _, _, rule, k in sorted(steps)]


def _first_steps(order: list[tuple[int, int]]) -> list[list[int]]:
    """Per rule and level, the first step whose cutoff rejects that level."""
    never = len(order)
    table = [[never] * (GRID + 1) for _ in RULES]
    for step, (rule, k) in enumerate(order):
        for level in range(k + 1):
            table[rule][level] = min(table[rule][level], step)
    return table


def _with_steps(rows: DataFrame, order: list[tuple[int, int]]) -> DataFrame:
    """Adds ``steps``: per rule, the first step that rejects the row."""
    table = _first_steps(order)
    steps = [F.get(F.array(*[F.lit(s) for s in table[r]]), F.get("levels", F.lit(r))) for r in range(len(RULES))]
    return rows.withColumn("steps", F.array(*steps))


def calibrate(measured: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
              alpha: float = ALPHA, delta: float = DELTA,
              min_lift: float = MIN_LIFT) -> tuple[list[tuple[int, int]], DataFrame]:
    """The steps in order, and per stratum with good holdout texts ``stratum,
    n_steps`` (how many of them stand), ``n_good, n_rejected`` (good holdout
    texts, and how many of them the standing steps reject) and ``bound``."""
    given = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("doc_id"))
             .agg(F.sum(F.col(label_col).cast("long")).alias("ones"), F.count("*").alias("n")))
    texts = (measured.select("doc_id", "stratum", "text_key", "levels").join(given, "doc_id")
             .groupBy("stratum", "text_key")
             .agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"), F.first("levels").alias("levels")))
    seen = materialize(texts.select("stratum", "levels", (2 * F.col("ones") >= F.col("n")).alias("good"),
                                    (F.pmod(F.xxhash64("text_key"), F.lit(2)) == 0).alias("holdout")), "quality-seen")
    order = step_order(seen.filter(~F.col("holdout")), min_lift)
    hold = _with_steps(seen.filter("holdout and good"), order).select("stratum", F.array_min("steps").alias("step"))
    counts = hold.groupBy("stratum", "step").agg(F.count("*").alias("n"))
    # A row per step and stratum at most.
    running = Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("stratum")
    before = running.rowsBetween(Window.unboundedPreceding, -1)
    counted = materialize(counts.select("stratum", "step", F.sum("n").over(running).alias("rejected"),
                                        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("already"),
                                        F.sum("n").over(whole).alias("n_good")), "quality-counts")
    confidence = 1 - delta / max(1, counted.select("stratum").distinct().count())
    never = len(order)

    # Confidence intervals are for the driver's few numbers per stratum, but run where the rows are.
    def bounds(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(5)]
                + [pa.array([upper_bound(r["rejected"], r["n_good"], confidence) for r in rows], pa.float64()),
                   pa.array([upper_bound(r["already"], r["n_good"], confidence) for r in rows], pa.float64())],
                names=["stratum", "step", "rejected", "already", "n_good", "bound", "bound_before"])

    tested = counted.mapInArrow(bounds, "stratum string, step int, rejected long, already long, n_good long, "
                                        "bound double, bound_before double")
    # The steps before the first that fails stand; the counts only change at steps that reject some holdout text.
    fails = (F.col("step") < never) & (F.col("bound") > alpha)
    ends = tested.groupBy("stratum").agg(
        F.min(F.when(fails, F.struct("step", "already", "bound_before"))).alias("f"),
        F.max(F.struct("step", F.when(F.col("step") < never, F.col("rejected")).otherwise(F.col("already")).alias("r"),
                       F.when(F.col("step") < never, F.col("bound")).otherwise(F.col("bound_before")).alias("b"))).alias("e"),
        F.first("n_good").alias("n_good"))
    cut = ends.select("stratum", F.coalesce("f.step", F.lit(never)).alias("n_steps"), "n_good",
                      F.coalesce("f.already", "e.r").alias("n_rejected"), F.coalesce("f.bound_before", "e.b").alias("bound"))
    # Too few good texts: not even "none rejected" shows the share.
    return order, materialize(cut.withColumn("n_steps", F.when(F.col("bound") <= alpha, F.col("n_steps")).otherwise(0)),
                              "quality-cutoffs")


def cutoffs(order: list[tuple[int, int]], limits: DataFrame) -> DataFrame:
    """``limits`` with ``cutoffs``: the strictest standing cutoff of each rule by name."""
    entries = [F.when(F.col("n_steps") > step, F.struct(F.lit(RULES[rule].name).alias("k"), F.lit(k).alias("at"),
                                                        F.lit(float(RULES[rule].cutoffs[k])).alias("v")))
               for step, (rule, k) in enumerate(order)]
    if not entries:
        return limits.withColumn("cutoffs", F.expr("cast(map() as map<string,double>)"))
    held = F.array_compact(F.array(*entries))
    strictest = F.filter(held, lambda e: ~F.exists(held, lambda o: (o["k"] == e["k"]) & (o["at"] > e["at"])))
    return limits.withColumn("cutoffs", F.map_from_entries(F.transform(
        strictest, lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))))


# -- verdicts -----------------------------------------------------------------

def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          label_col: str = "quality", label_id_col: str = "doc_id", alpha: float = ALPHA, delta: float = DELTA,
          min_lift: float = MIN_LIFT) -> DataFrame:
    """One row per document: ``doc_id``, the base counts, ``base_failed,
    kept`` and ``failed_rules`` (names of the risk-controlled rules that reject it)."""
    measured = materialize(measures(docs, id_col, text_col, stratum_col), "quality-measures")
    order, limits = calibrate(measured, labels, label_col, label_id_col, alpha, delta, min_lift)
    few = bounded_broadcast(limits.select(F.col("stratum").alias("_s"), "n_steps"))
    rows = _with_steps(measured, order).join(few, F.col("stratum").eqNullSafe(F.col("_s")), "left")
    limit = F.coalesce("n_steps", F.lit(0))
    failed = F.array_compact(F.array(*[F.when(F.get("steps", F.lit(r)) < limit, F.lit(rule.name))
                                       for r, rule in enumerate(RULES)]))
    base_failed = ((F.col("n_words") < MIN_WORDS)
                   | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
    return (rows.select("doc_id", *BASE, base_failed.alias("base_failed"), failed.alias("failed_rules"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))
