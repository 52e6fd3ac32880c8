"""Cross-site line de-duplication by distinct-site spread.

A line (blanks trimmed) that stands on many different sites is boilerplate.  If
``long_words`` is set, a line of more words than that goes from ``long_sites``
sites on: short lines recur by chance, long passages only as copies.

1. Lines that occur fewer times than the sites they need cannot be spread that
   far; counting hashes with map-side combine leaves the frequent ones.
2. For these a HyperLogLog sketch of sites per line hash, merged by aggregation,
   estimates the spread; a hot line costs one sketch per task.
3. Estimates outside the sites needed times ``1 +- band`` decide at once (the band
   is many standard errors wide).  Lines inside it get an exact distinct count.
4. Boilerplate lines are taken out of every document.

Native functions throughout.  Line hashes are joined, and the places of the lines
to remove meet the documents by their row key: by broadcast while a count proves
few rows and places, so that no text is moved; beyond that by a shuffle join.

Defined results: a null text has no lines and stays null; blank lines are never
boilerplate and always kept; a null site is a site of its own; repeated rows are
returned as often as they came; an empty table gives an empty result; other
columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import BROADCAST_ROWS, bounded_broadcast, materialize, text_key
from kindred.llm.mixing import n_words

#: Fixed by the SQL of ``op6_line_dedup``.
MIN_SITES = 10
#: Of the long-line query: lines of more than so many words go from so many sites on.
LONG_WORDS = 50
LONG_SITES = 2
#: Estimates this far from the threshold need no exact count (standard error: 1.6 %).
BAND = 0.2
LOG_REGISTERS = 12
#: Line places (4 bytes each) that a broadcast may hold.
BROADCAST_PLACES = 2_000_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_hash(line: Column) -> Column:
    """Null for blank lines."""
    clean = F.trim(line)
    return F.when(clean != "", F.xxhash64(clean))


def _need(line: Column, min_sites: int, long_words: int | None, long_sites: int) -> Column:
    """The sites from which on a line is boilerplate."""
    if long_words is None:
        return F.lit(min_sites)
    # So many words take at least so many characters; most lines need no count.
    is_long = (F.length(line) > 2 * long_words) & (n_words(line) > long_words)
    return F.when(is_long, F.lit(long_sites)).otherwise(F.lit(min_sites))


def spread_lines(docs: DataFrame, text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES,
                 band: float = BAND, log_registers: int = LOG_REGISTERS, long_words: int | None = None,
                 long_sites: int = LONG_SITES) -> DataFrame:
    """``line_hash, n_lines, n_sites`` (exact near the threshold, else estimated)
    of the lines on at least ``min_sites`` sites (long ones: ``long_sites``)."""
    site = F.coalesce(F.concat(F.lit("s"), F.col(site_col).cast("string")), F.lit("-"))  # a sketch skips empty strings
    split = docs.select(site.alias("site"), F.explode(_lines(F.col(text_col))).alias("line"))
    lines = split.select("site", _line_hash(F.col("line")).alias("line_hash")).filter("line_hash is not null")
    counted = (split.select(_line_hash(F.col("line")).alias("line_hash"),
                            _need(F.col("line"), min_sites, long_words, long_sites).alias("need"))
               .filter("line_hash is not null"))
    often = materialize(counted.groupBy("line_hash").agg(F.count("*").alias("n_lines"), F.min("need").alias("need"))
                        .filter(F.col("n_lines") >= F.col("need")), "line-frequent")
    sketched = materialize(
        lines.join(bounded_broadcast(often.select("line_hash")), "line_hash", "left_semi").groupBy("line_hash")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_registers))).alias("n_sites"))
        .join(often, "line_hash"), "line-sketched")
    low, high = F.col("need") * (1 - band), F.col("need") * (1 + band)
    near = sketched.filter(F.col("n_sites").between(low, high)).select("line_hash")
    exact = (lines.join(bounded_broadcast(near), "line_hash", "left_semi").distinct()
             .groupBy("line_hash").agg(F.count("*").alias("n_sites"))
             .join(often, "line_hash").filter(F.col("n_sites") >= F.col("need")))
    clear = sketched.filter(F.col("n_sites") > high)
    columns = ("line_hash", "n_lines", "n_sites")
    return exact.select(*columns).unionByName(clear.select(*columns))


def remove_spread_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                        **options) -> DataFrame:
    """``doc_id, text`` (without boilerplate lines), ``n_lines, n_removed`` per input row."""
    spread = materialize(spread_lines(docs, text_col, site_col, **options).select("line_hash"), "line-spread")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                       text_key(F.col(text_col)).alias("_key"))
    hit = (rows.select("_id", "_key", F.posexplode(_lines(F.col("_text"))).alias("pos", "line"))
           .select("_id", "_key", "pos", _line_hash(F.col("line")).alias("line_hash"))
           .join(bounded_broadcast(spread), "line_hash", "left_semi")
           .groupBy("_id", "_key").agg(F.collect_set("pos").alias("_out")))
    hit = materialize(hit, "line-hits").withColumnsRenamed({"_id": "_hid", "_key": "_hkey"})
    size = hit.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("_out")), F.lit(0)).alias("places")).first()
    if size["rows"] <= BROADCAST_ROWS and size["places"] <= BROADCAST_PLACES:
        hit = F.broadcast(hit)
    joined = rows.join(hit, F.col("_id").eqNullSafe(F.col("_hid")) & (F.col("_key") == F.col("_hkey")), "left")
    keep = F.filter(_lines(F.col("_text")), lambda line, i: ~F.array_contains("_out", i))
    text = F.when(F.col("_out").isNull(), F.col("_text")).otherwise(F.array_join(keep, "\n"))
    return joined.select(
        F.col("_id").alias("doc_id"), text.alias("text"),
        F.when(F.col("_text").isNull(), 0).otherwise(F.size(_lines(F.col("_text")))).cast("long").alias("n_lines"),
        F.when(F.col("_out").isNull(), 0).otherwise(F.size("_out")).cast("long").alias("n_removed"))
