"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

* Every document gets an exponential key ``-ln(u) / w``: ``u`` is a uniform
  number hashed from the seed and the id, ``w`` the document's quality weight.
  In ascending key order the documents of a source are a weighted sample
  without replacement.
* Every source gets a word target: its share of the budget by weight, at most
  ``max_epochs`` times its own size, the excess shared out again by weight.
* A source is taken in complete epochs first.  The rest of its target is the
  fractional selection: documents in key order while their sizes sum up to it;
  the document that crosses the target is taken whole or left, whichever ends
  nearer to the target (taken, if both are as near).

No task sees a whole source.  The keys of a source with n documents are cut
into about sqrt(n) ranges of about sqrt(n) documents; the sizes summed per
range (with map-side combine) show in which range the target falls.  Only that
range is sorted and prefix-summed by row; documents in ranges below it are
taken, those above are not.  Texts are read once and never shuffled.

Defined results: a null or blank text has size 0 and is never taken; a null
source is a source of its own, last in order; a null id is hashed as the empty
string; rows with the same key are ordered by id, size and text hash, so that
reruns agree; a source of size 0 gets target 0; an empty table gives an empty
result; other columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import bounded_broadcast, materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Weights dealt to the sources in code point order, null last.
CYCLE = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Signs whose share of a text lowers its quality weight.
SIGNS = "#$%&*|<>{}[]=+_~^\\/@!"
LEAST_QUALITY = 0.25


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between ``LEAST_QUALITY`` and 1: four times the share of signs is taken off."""
    share = 1 - F.length(F.translate(text, SIGNS, "")) / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(LEAST_QUALITY), 1 - 4 * share), F.lit(LEAST_QUALITY))


def uniform(id_text: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from 52 bits of an MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text, F.lit("")))), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / F.lit(float(2 ** 52))


def source_targets(sources: DataFrame, cycle: tuple[float, ...] = CYCLE, max_epochs: int = MAX_EPOCHS,
                   budget_share: float = 1.0) -> DataFrame:
    """``_source, _size`` per source to these plus ``_target``.

    Water filling in one pass: with sources in ascending order of
    ``cap / weight``, the level is the first at which the budget left by the
    capped sources, by weight, exceeds no cap of the others.  The windows see
    one row per source, not documents.
    """
    dealt = F.array(*[F.lit(float(c)) for c in cycle])
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    ranked = (sources.withColumn("_weight", F.get(dealt, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(cycle)))))
              .withColumn("_cap", (max_epochs * F.col("_size")).cast("double"))
              .withColumn("_ratio", F.col("_cap") / F.col("_weight")))
    order = Window.orderBy("_ratio", F.col("_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = (F.lit(float(budget_share)) * F.sum("_size").over(whole)
            - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
    weights = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    levels = ranked.withColumn("_level", left / weights)
    first = F.first(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level")), ignorenulls=True).over(whole)
    return (levels.withColumn("_target", F.least(F.col("_cap"), F.coalesce(first * F.col("_weight"), F.col("_cap"))))
            .drop("_weight", "_cap", "_ratio", "_level"))


def _keys(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, quality: Column | None,
          *more: Column) -> DataFrame:
    text = F.col(text_col)
    weight = quality_weight(text) if quality is None else quality
    return (docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
                        n_words(text).alias("_words"), weight.alias("_quality"), F.xxhash64(text).alias("_text_key"),
                        (-F.log(uniform(F.col(id_col).cast("string"), seed))).alias("_e"), *more)
            .withColumn("_key", F.col("_e") / F.col("_quality")).drop("_e"))


def _taken(docs: DataFrame, id_col: str, text_col: str, source_col: str, cycle: tuple[float, ...], max_epochs: int,
           budget_share: float, seed: str, quality: Column | None, whole_rows: bool) -> DataFrame:
    """Keys of the documents with ``_target, _epochs`` and ``_part`` (words of
    the fractional selection: all of the document's or none); with ``_row``, the
    input row, if asked for."""
    light = materialize(_keys(docs, id_col, text_col, source_col, seed, quality), "mix-keys")
    sources = light.groupBy("_source").agg(F.sum("_words").alias("_size"), F.count("*").alias("_n"),
                                           F.avg("_quality").alias("_mean"))
    targets = (source_targets(sources, cycle, max_epochs, budget_share)
               .withColumn("_budget", F.round("_target").cast("long"))
               .withColumn("_epochs", F.when(F.col("_size") > 0, F.floor(F.col("_budget") / F.col("_size")))
                           .otherwise(0).cast("long"))
               .withColumn("_rest", F.col("_budget") - F.col("_epochs") * F.col("_size"))
               .withColumn("_ranges", F.ceil(F.sqrt("_n")).cast("long")).withColumnRenamed("_source", "_s"))
    targets = bounded_broadcast(materialize(targets, "mix-targets"))

    def ranged(keys: DataFrame) -> DataFrame:
        # The key's quantile if all weights were the source's mean: even ranges, high or low as the weights may be.
        return (keys.join(targets, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
                .withColumn("_range", F.floor((1 - F.exp(-F.col("_key") * F.col("_mean"))) * F.col("_ranges"))))

    ranges = ranged(light).groupBy("_source", "_range").agg(F.sum("_words").alias("_in_range"),
                                                            F.first("_rest").alias("_rest"))
    running = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    edge = (ranges.withColumn("_before", F.coalesce(F.sum("_in_range").over(running), F.lit(0)))
            .filter("_before <= _rest and _rest < _before + _in_range")
            .select(F.col("_source").alias("_s"), F.col("_range").alias("_edge"), "_before"))
    edge = bounded_broadcast(materialize(edge, "mix-edges"))

    keys = (_keys(docs, id_col, text_col, source_col, seed, quality, F.struct("*").alias("_row"))
            if whole_rows else light)
    placed = ranged(keys).join(edge, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    off_edge = placed.filter("_edge is null or _range <> _edge").withColumn(
        "_part", F.when(F.col("_range") < F.col("_edge"), F.col("_words")).otherwise(F.lit(0).cast("long")))
    in_order = (Window.partitionBy("_source").orderBy("_key", "_id", "_words", "_text_key")
                .rowsBetween(Window.unboundedPreceding, -1))
    on_edge = (placed.filter("_range = _edge")
               .withColumn("_seen", F.col("_before") + F.coalesce(F.sum("_words").over(in_order), F.lit(0)))
               .withColumn("_part", F.when((F.col("_rest") > F.col("_seen"))
                                           & (2 * (F.col("_rest") - F.col("_seen")) >= F.col("_words")), F.col("_words"))
                           .otherwise(F.lit(0).cast("long")))
               .drop("_seen"))
    return off_edge.unionByName(on_edge)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        cycle: tuple[float, ...] = CYCLE, max_epochs: int = MAX_EPOCHS, budget_share: float = 1.0,
        seed: str = SEED, quality: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target,
    taken`` (words the mix takes, repeats counted), ``sample_key``."""
    rows = _taken(docs, id_col, text_col, source_col, cycle, max_epochs, budget_share, seed, quality, False)
    return rows.select(
        F.col("_id").alias("doc_id"), F.col("_source").alias("source"), F.col("_words").alias("size"),
        F.col("_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_epochs") * F.col("_words") + F.col("_part")).alias("taken"), F.col("_key").alias("sample_key"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    cycle: tuple[float, ...] = CYCLE, max_epochs: int = MAX_EPOCHS, budget_share: float = 1.0,
                    seed: str = SEED, quality: Column | None = None) -> DataFrame:
    """The mix as rows of ``docs``: a whole copy per epoch and one more if the
    document is selected."""
    rows = _taken(docs, id_col, text_col, source_col, cycle, max_epochs, budget_share, seed, quality, True)
    copies = F.when(F.col("_words") > 0, F.col("_epochs") + (F.col("_part") > 0).cast("long")).otherwise(0)
    copied = rows.filter(copies > 0).select("_row", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return copied.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
