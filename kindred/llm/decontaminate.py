"""Benchmark decontamination by a prefix-filtered join on shingles.

Every benchmark item is cut into windows of ``window`` consecutive words (one
window if it has fewer).  A window is the ordered list of its word shingles.
Since it must be contained whole (threshold 1), the necessary prefix is one
shingle: the rarest, by counts over all documents.

1. Count over all documents the shingles that occur in some window.  A window
   with a shingle that no document has cannot occur and is dropped.
2. Join every document position with the windows whose rarest shingle starts
   there.  Positional bound: the window would begin at ``position - offset``,
   not before the text.  Length bound: it must end within the text.
3. Verify the words over the item-sized window, word by word.
4. Per document: positions covered by some verified window, and the items.

DataFrame functions only.  The windows are the stated query set.  A count
decides: at most ``max_broadcast`` of them are broadcast, so that positions are
tested where the text is read and only hits are shuffled; beyond it, narrow
``(document, position, shingle)`` rows are shuffled to the windows, where
adaptive execution splits a frequent shingle, and candidates are joined back to
the texts.  Both ways give the same rows.

Defined results: a null text has no words; an item without words has no window;
a null item id counts as the empty string; repeated document rows are returned
as often as they came; empty tables give an empty result or no hits; other
columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import ascii_lower, bounded_broadcast, materialize, text_key

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 3
#: Windows are broadcast up to this number (13 words each: some 60 MB).
MAX_BROADCAST_WINDOWS = 200_000


def words(text: Column) -> Column:
    """Runs of a-z, 0-9 and non-ASCII characters, after lower-casing A-Z."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATOR), lambda w: w != "")


def _shingle(ws: Column, at: Column, size: Column, largest: int) -> Column:
    """A 64-bit key of the ``size`` words from ``at``; beyond ``size`` the words count as null."""
    return F.xxhash64(size, *[F.when(F.lit(k) < size, F.get(ws, at + k)) for k in range(largest)])


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``window_id, item, len, size, ws``: the distinct windows of each item."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             words(F.col(text_col)).alias("_all"))
    n = F.size("_all")
    return (items.filter(n > 0)
            .withColumn("len", F.least(n, F.lit(window)))
            .select("item", "len", "_all", F.explode(F.sequence(F.lit(1), n - F.col("len") + 1)).alias("_at"))
            .select("item", "len", F.least(F.col("len"), F.lit(shingle)).alias("size"),
                    F.slice("_all", F.col("_at"), F.col("len")).alias("ws"))
            .distinct().withColumn("window_id", F.monotonically_increasing_id()))


def _window_shingles(windows: DataFrame, largest: int) -> DataFrame:
    return (windows.select("*", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("size"))).alias("off"))
            .withColumn("key", _shingle(F.col("ws"), F.col("off"), F.col("size"), largest)))


def _positions(docs: DataFrame, sizes: list[int], *columns: str, marker: bool = False) -> DataFrame:
    """A row per document position and shingle size: ``columns, at, key``; with
    ``marker`` also one row at position -1 whose key is null."""
    n = F.size("ws")
    if marker:
        slots = F.sequence(F.lit(-1), n * len(sizes) - 1)
    else:
        slots = F.when(n > 0, F.sequence(F.lit(0), n * len(sizes) - 1))
    at, size = F.col("_slot"), F.lit(sizes[0])
    if len(sizes) > 1:
        at = F.when(F.col("_slot") >= 0, F.floor(F.col("_slot") / len(sizes)).cast("int")).otherwise(-1)
        size = F.get(F.array(*map(F.lit, sizes)), F.pmod(F.col("_slot"), F.lit(len(sizes))))
    key = F.when((at >= 0) & (at + size <= F.size("ws")), _shingle(F.col("ws"), at, size, max(sizes)))
    return docs.select(*columns, "ws", F.explode(slots).alias("_slot")).select(
        *columns, at.alias("at"), key.alias("key"))


def prefix_table(docs: DataFrame, windows: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """The windows that can occur, each with its rarest shingle: ``key, off``."""
    shingles = _window_shingles(windows, max(sizes))
    wanted = shingles.select("key").distinct()
    seen = (_positions(docs, sizes).join(F.broadcast(wanted) if small else wanted, "key", "left_semi")
            .groupBy("key").agg(F.count("*").alias("n")))
    ranked = shingles.join(seen, "key", "left")
    rare = ranked.groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("off"), F.col("key"))).alias("r"))
    return (windows.join(rare.filter("r.n > 0"), "window_id")
            .select("window_id", "item", "len", F.col("ws").alias("w_ws"), F.col("r.off").alias("off"),
                    F.col("r.key").alias("w_key")))


def _verified(ws: Column) -> Column:
    """Positional and length bounds, then the words themselves."""
    start = F.col("at") - F.col("off")
    return (start >= 0) & (start + F.col("len") <= F.size(ws)) & (F.slice(ws, start + 1, F.col("len")) == F.col("w_ws"))


def contained_windows(docs: DataFrame, prefixes: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """Per document row a marker (``at`` -1) and per verified window its place:
    ``_id, _key, n_words, at, begin, end, item``.  ``docs``: ``_id, _key, ws``."""
    docs = docs.withColumn("n_words", F.size("ws").cast("long"))
    begin = F.col("at") - F.col("off")
    out = ["_id", "_key", "n_words", "at", begin.alias("begin"), (begin + F.col("len")).alias("end"), "item"]
    if small:
        found = (_positions(docs, sizes, "_id", "_key", "n_words", "ws", marker=True)
                 .join(F.broadcast(prefixes), F.col("key") == F.col("w_key"), "left"))
        return found.filter((F.col("at") < 0) | _verified(F.col("ws"))).select(*out)
    candidates = (_positions(docs, sizes, "_id", "_key", "n_words")
                  .join(prefixes, F.col("key") == F.col("w_key"))
                  .filter("at >= off and at - off + len <= n_words").drop("n_words")
                  .distinct().alias("c"))
    d = docs.groupBy("_id", "_key").agg(F.first("ws").alias("ws"), F.first("n_words").alias("n_words")).alias("d")
    hits = (candidates.join(d, F.col("c._id").eqNullSafe(F.col("d._id")) & F.col("c._key").eqNullSafe(F.col("d._key")))
            .filter(_verified(F.col("d.ws"))).select("c._id", "c._key", *out[2:]))
    none = F.lit(None)
    markers = docs.select("_id", "_key", "n_words", F.lit(-1).alias("at"), none.cast("int").alias("begin"),
                          none.cast("int").alias("end"), none.cast("string").alias("item"))
    return markers.unionByName(hits)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE, max_broadcast: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_words, n_hit, spans`` (word
    ranges covered, end exclusive, overlaps merged) and ``items`` (ids with an
    occurring window, sorted as strings)."""
    windows = materialize(item_windows(benchmark, item_col, item_text_col, window, shingle), "bench-windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect()) or [shingle]  # at most `shingle`
    small = windows.limit(max_broadcast + 1).count() <= max_broadcast
    cut = docs.select(F.col(id_col).alias("_id"), text_key(F.col(text_col)).alias("_key"),
                      words(F.col(text_col)).alias("ws"))
    prefixes = materialize(prefix_table(cut, windows, sizes, small), "bench-prefixes")
    found = contained_windows(cut, prefixes, sizes, small)
    marker = F.col("at") < 0
    per_doc = found.groupBy("_id", "_key").agg(
        F.max("n_words").alias("n_words"), F.count_if(marker).alias("_times"),
        F.array_sort(F.collect_set(F.when(~marker, F.struct("begin", "end")))).alias("_spans"),
        F.array_sort(F.collect_set(F.when(~marker, F.col("item")))).alias("items"))
    merged = per_doc.withColumn("spans", _merge(F.col("_spans")))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return merged.select(F.col("_id").alias("doc_id"), F.col("_key").alias("text_key"), "n_words",
                         hit.alias("n_hit"), "spans", "items",
                         F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_copy")).drop("_copy")


def _merge(spans: Column) -> Column:
    """Sorted spans, those that overlap or touch joined to one."""
    kind = "array<struct<begin:int,end:int>>"
    state = F.struct(F.lit(-1).alias("begin"), F.lit(-1).alias("end"), F.array().cast(kind).alias("done"))

    def close(a: Column) -> Column:
        island = F.array(F.struct(a["begin"].alias("begin"), a["end"].alias("end")))
        return F.when(a["begin"] >= 0, F.concat(a["done"], island)).otherwise(a["done"])

    def step(a: Column, s: Column) -> Column:
        apart = (a["begin"] < 0) | (s["begin"] > a["end"])
        return F.struct(F.when(apart, s["begin"]).otherwise(a["begin"]).alias("begin"),
                        F.when(apart, s["end"]).otherwise(F.greatest(a["end"], s["end"])).alias("end"),
                        F.when(apart, close(a)).otherwise(a["done"]).alias("done"))

    return F.aggregate(spans, state, step, close)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words lies inside benchmark windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = materialize(decontaminate(docs, benchmark, id_col, text_col, **options)
                      .filter(contaminated(F.col("n_hit"), F.col("n_words")))
                      .select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")).distinct(),
                      "bench-contaminated")
    bad = bounded_broadcast(bad)
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad_id"]) & (text_key(docs[text_col]) == bad["_bad_key"]),
                     "left_anti")
