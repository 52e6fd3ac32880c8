"""URL filtering by hashed host-suffix and path-prefix expressions.

A rule names a host, a path prefix and a verdict.  Each URL is expanded into
the expressions *host suffix + path prefix* that a rule could have (only suffix
label counts and path lengths that some rule has), each hashed.  An equi-join
on a short prefix of the digest finds candidates, the full digest confirms
them, and precedence picks one: the longest expression, then the longer host,
then block before allow, then the rule's text.

All in DataFrame functions.  The rules are broadcast only when a count proves
at most ``max_broadcast`` of them; otherwise both sides are shuffled on the
digest prefix, and adaptive execution splits the partition of a hot host.
Every URL also sends one marker row, so that one aggregation per
``(page_id, host, path)`` returns every page, repeated rows included.

Defined results: a null URL or one without ``://`` has empty host and path; no
rule fits an empty host; empty rules give the default verdict everywhere; an
empty table gives an empty result; repeated rows are returned as often as they
came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import BROADCAST_ROWS, ascii_lower, bounded_broadcast

#: Hex digits of the digest that the join compares (32 bits).
PREFIX_HEX = 8
AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_host_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    return (pages.withColumn("host", ascii_lower(F.regexp_extract(url, AUTHORITY, 1)))
            .withColumn("path", F.regexp_extract(url, AUTHORITY, 2)))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """``host, path, verdict`` rules with digest, its short prefix and rank columns."""
    text = F.concat("host", "path")
    digest = F.sha2(F.concat_ws("\u0000", "host", "path"), 256)
    return (rules.filter("host is not null and host <> '' and path is not null and verdict is not null")
            .select(digest.substr(1, PREFIX_HEX).alias("_short"), digest.alias("_full"),
                    F.struct(F.length(text).alias("length"), F.length("host").alias("host_length"),
                             (F.col("verdict") == "block").alias("blocks"), text.alias("rule"),
                             F.col("verdict").alias("verdict")).alias("_rank"))
            .distinct())


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, n_rules`` (rules that fit)."""
    # Bounded by the label count of a host name and the longest rule path, not by the number of rules.
    shape = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
                      F.collect_set(F.length("path")).alias("lengths")).first()
    pairs = [(k, n) for k in sorted(shape["labels"]) for n in sorted(shape["lengths"])]
    urls = with_host_path(pages, url_col).select(F.col(id_col).alias("page_id"), "host", "path")
    shapes = F.array([F.struct(F.lit(k).alias("k"), F.lit(n).alias("n")) for k, n in pairs]) if pairs else \
        F.array().cast("array<struct<k:int,n:int>>")
    n_labels = F.size(F.split("host", r"\."))
    fits = F.filter(shapes, lambda s: (s["k"] <= n_labels) & (s["n"] <= F.length("path")) & (F.col("host") != ""))
    marker = F.array(F.struct(F.lit(0).alias("k"), F.lit(0).alias("n")))
    expressions = urls.select("page_id", "host", "path", F.explode(F.concat(marker, fits)).alias("s"))
    digest = F.sha2(F.concat_ws("\u0000", _suffix(pairs), F.substring("path", F.lit(1), F.col("s.n"))), 256)
    looked = expressions.select("page_id", "host", "path", (F.col("s.k") == 0).alias("_marker"),
                                F.when(F.col("s.k") > 0, digest).alias("_digest"))
    looked = looked.withColumn("_key", F.substring("_digest", 1, PREFIX_HEX))
    known = bounded_broadcast(prepare_rules(rules), max_broadcast)
    hit = F.col("_full") == F.col("_digest")
    matched = (looked.join(known, F.col("_key") == F.col("_short"), "left")
               .filter(F.col("_marker") | hit))
    judged = matched.groupBy("page_id", "host", "path").agg(
        F.count_if("_marker").alias("_times"),
        F.max(F.when(hit, F.col("_rank"))).alias("_best"), F.count_if(hit).alias("_hits"))
    return judged.select(
        "page_id", "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
        (F.col("_hits") / F.col("_times")).cast("long").alias("n_rules"),
        F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_copy")).drop("_copy")


def _suffix(pairs: list[tuple[int, int]]):
    """The last ``s.k`` labels of the host."""
    out = F.lit(None).cast("string")
    for k in sorted({k for k, _ in pairs}):
        out = F.when(F.col("s.k") == k, F.substring_index("host", ".", -k)).otherwise(out)
    return out
