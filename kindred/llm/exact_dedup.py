"""Exact de-duplication through content-defined chunk recipes.

1. Every text is cut where its content says so (after a sentence end, at least
   ``MIN_CHUNK`` and at most ``MAX_CHUNK`` characters after the last cut).  A
   row becomes a *recipe*: the ordered list of its chunks' 64-bit identifiers,
   8 bytes for about 600 characters.  No text leaves the scan.
2. Only rows whose recipe fingerprint and byte length occur more than once can
   have a copy.  For these, identifiers are verified: the distinct
   ``(identifier, chunk)`` pairs are built with a map-side partial aggregation,
   and where two different chunks share an identifier each gets its own
   number.
3. Rows are equal exactly if their lists of verified identifiers are equal.
   One aggregation over recipes finds the row to keep, and recipes (never
   texts) are joined back.

Built from DataFrame functions only.  A group that holds a third of all rows is
pre-aggregated before the shuffle, and the join back reads two stored tables,
so that adaptive execution can split its partition.

Defined results: a null text counts as empty, and all empty texts are one
group; a null id ranks below every other; of rows that tie on the largest id
exactly one stays; an empty table gives an empty result; other columns are
ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import bounded_broadcast, materialize

MIN_CHUNK = 512
MAX_CHUNK = 4096


def chunks(text: Column, low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> Column:
    """The text's chunks in order; joined they give the text again."""
    pattern = rf"(?s).{{{low},{high}}}?(?:[.!?\n]\s|\z)|.{{1,{high}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _identifier(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", identifier=_identifier) -> DataFrame:
    """``_id, _bytes, _sha, _recipe`` per row; ``_recipe`` is the list of chunk identifiers."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
            .select("_id", "_text", F.octet_length("_text").alias("_bytes"),
                    F.transform(chunks(F.col("_text")), identifier).alias("_recipe")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                identifier=_identifier) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256,
    n_chunks``.  ``identifier`` maps a chunk to a long; any function gives the
    same groups, since identifiers are verified against the chunks."""
    cut = recipes(docs, id_col, text_col, identifier)
    light = materialize(
        cut.select("_id", "_bytes", "_recipe", F.xxhash64("_recipe").alias("_print"),
                   F.unhex(F.sha2(F.col("_text"), 256)).alias("_sha"),
                   F.monotonically_increasing_id().alias("_row")), "exact-recipes")

    repeated = materialize(light.groupBy("_bytes", "_print").agg(F.count("*").alias("n"))
                           .filter("n > 1").drop("n"), "exact-repeated")
    pairs = (cut.withColumn("_print", F.xxhash64("_recipe"))
             .join(bounded_broadcast(repeated), ["_bytes", "_print"], "left_semi")
             .select(F.explode(chunks(F.col("_text"))).alias("chunk"))
             .select(identifier(F.col("chunk")).alias("h"), "chunk").distinct())
    verified = light.withColumn("_fix", F.lit(None).cast("array<struct<pos:int,chunk:string>>"))
    ambiguous = materialize(pairs.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"),
                            "exact-ambiguous")
    if not ambiguous.isEmpty():
        verified = _resolve(cut, light, ambiguous)

    key = ["_bytes", "_recipe", "_fix"]
    groups = materialize(
        verified.groupBy(*key).agg(F.count("*").alias("_n"), F.max("_id").alias("_keep"),
                                   F.coalesce(F.max_by("_row", "_id"), F.max("_row")).alias("_keep_row"))
        .filter("_n > 1"), "exact-groups").alias("g")
    rows = verified.alias("v")
    on = [F.col(f"v.{c}").eqNullSafe(F.col(f"g.{c}")) for c in key]
    out = rows.join(groups, on, "left")
    alone = F.col("g._n").isNull()
    return out.select(
        F.col("v._id").alias("doc_id"),
        F.when(alone, F.col("v._id")).otherwise(F.col("g._keep")).alias("keep_id"),
        F.coalesce(F.col("g._n"), F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("v._row") == F.col("g._keep_row"))).alias("kept"),
        F.lower(F.hex("v._sha")).alias("text_sha256"),
        F.size("v._recipe").cast("long").alias("n_chunks"))


def _resolve(cut: DataFrame, light: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """Recipes with, for each chunk whose identifier is shared by different
    chunks, the chunk itself: ``_fix`` is that list in order of position."""
    spots = (cut.select("_id", F.unhex(F.sha2(F.col("_text"), 256)).alias("_sha"),
                        F.posexplode(chunks(F.col("_text"))).alias("pos", "chunk"), "_recipe")
             .withColumn("h", F.get("_recipe", F.col("pos"))).drop("_recipe")
             .join(bounded_broadcast(ambiguous), "h", "left_semi"))
    fixes = (spots.groupBy("_id", "_sha").agg(F.array_sort(F.collect_set(F.struct("pos", "chunk"))).alias("_fix"))
             .alias("f"))
    return (light.alias("l").join(fixes, F.col("l._id").eqNullSafe(F.col("f._id")) & (F.col("l._sha") == F.col("f._sha")),
                                  "left").select("l.*", "f._fix"))
