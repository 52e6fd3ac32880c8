"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import materialize


def remainder(id_col: Column, modulus: int) -> Column:
    """The CRC-32 of the id's text, modulo ``modulus``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(modulus))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, held_out: Column, per_class: dict[int, int],
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``text, label, of_class``: at most ``per_class[c]`` distinct texts of
    each class and the number of distinct texts the class has.

    ``held_out`` (over the id column) rows take no part.  A text's order in the
    sample is the hash of the text alone, so a reread or a copy changes
    nothing; a text with both labels counts as the more frequent, 1 on ties.
    """
    train = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out)
             .select(F.col(id_col).alias("_l_id"), F.col(label_col).cast("int").alias("_label")))
    ids = train.groupBy("_l_id").agg(F.sum("_label").alias("_ones"), F.count("*").alias("_n"))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("text"))
    # Hashes first: only the texts that are sampled are moved.
    votes = (rows.filter("text is not null").select("_id", "_hash").join(ids, F.col("_id") == F.col("_l_id"))
             .groupBy("_hash").agg(F.sum("_ones").alias("ones"), F.sum("_n").alias("n"))
             .select("_hash", (2 * F.col("ones") >= F.col("n")).cast("int").alias("label")))
    votes = materialize(votes, "sample-votes")
    sizes = {r["label"]: r["n"] for r in votes.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = None
    for label, most in sorted(per_class.items()):
        some = (votes.filter(F.col("label") == label).orderBy(F.xxhash64("_hash"), "_hash").limit(most)
                .withColumn("of_class", F.lit(sizes.get(label, 0)).cast("long")))
        picked = some if picked is None else picked.unionByName(some)
    picked = materialize(picked, "sample-picked")  # sum(per_class) rows at most
    texts = rows.join(F.broadcast(picked), "_hash").groupBy("_hash").agg(
        F.first("text").alias("text"), F.first("label").alias("label"), F.first("of_class").alias("of_class"))
    return materialize(texts.select("text", "label", "of_class"), "sample")
