"""Near-duplicate detection: b-bit MinHash signatures in a multi-index Hamming join.

* A document's set holds its distinct word shingles.  Its signature has
  ``N_SYMBOLS`` symbols of ``BITS`` bits, each from the minimum of the set
  under one hash function; two sets of similarity J differ in about
  ``(1 - J) * N_SYMBOLS`` symbols.
* Signatures are split into ``CHUNKS`` chunks.  If two signatures differ in at
  most ``CHUNKS * (ERRORS + 1) - 1`` symbols, some chunk has at most ``ERRORS``
  = 1 of the errors (pigeonhole).  The errors allowed in a chunk are enumerated
  as its deletions: one key per chunk and left-out position.  Two documents
  with an equal key are candidates, so every pair within that distance is one.
* Documents with equal sets are one class; keys, candidates and links are
  between classes, so a group of copies counts once however large it is.
* Links are confirmed on full sets: the stored sorted 64-bit shingle hashes.

Without all pairs of a group, yet without losing a link that joins two
components: every node is first compared with the most central node that it
meets (the one with most candidates), then the buckets that still hold several
components with one member each.  These two steps test the signature distance
first: pairs further apart than ``VERIFY_DISTANCE`` (similarity 0.8 gives that
with probability below 1e-6) are not confirmed.  The nodes of buckets that are
still of several components are compared exactly, across components only, by a
join on their rarest shingles with positional bounds; copies too far apart to be
linked do not meet there, however many they are.

Python runs in Arrow batches over whole columns (NumPy); joins, grouping and
components are Spark's.  Large intermediate tables are stored in the shared
folder, which also lets adaptive execution split hot buckets.

Defined results: a null, empty or blank text has an empty set, links to nothing
and is its own component; a text shorter than a shingle is one shingle; ties and
repeated rows fall into one class; a null id ranks below none: a component's id
is its smallest non-null id (null if it has none); an empty table gives an
empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import bounded_broadcast, materialize, text_key
from kindred.llm.components import connected_components
from kindred.session import ship_package

SHINGLE = 5
THRESHOLD_PERCENT = 80
N_SYMBOLS = 60
BITS = 16
CHUNKS = 12
ERRORS = 1
GUARANTEED_DISTANCE = CHUNKS * (ERRORS + 1) - 1
VERIFY_DISTANCE = 27

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(0, 2 ** 64, 256, np.uint64)
_SPLIT = np.zeros(256, bool)
_SPLIT[[0x20, *range(0x09, 0x0E)]] = True
_MULTIPLY = _RANDOM.integers(0, 2 ** 64, N_SYMBOLS, np.uint64) | np.uint64(1)
_XOR = _RANDOM.integers(0, 2 ** 64, N_SYMBOLS, np.uint64)
_PLACE = _RANDOM.integers(0, 2 ** 64, 64, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2 ** 64)
#: Classes whose keys (``N_SYMBOLS`` each) one task counts: nearly all keys are distinct, so its table grows with them.
KEY_CLASSES = 8192
#: Bytes of text hashed at a time, so that the arrays stay in the processor's cache.
BLOCK_BYTES = 1 << 19


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if cls.up.size < n:
            cls.up, cls.down = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, x, np.uint64))))
                                for x in (_BASE, _INVERSE))
        return cls.up[:n], cls.down[:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words in UTF-8 bytes, A-Z lower-cased, and where
    each word starts.  Words are runs of bytes other than blanks 09-0D and 20."""
    gap = _SPLIT[data]
    edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    begins, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    up, down = _Powers.to(data.size + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[low] * up[:data.size], dtype=np.uint64)))
    return _mix((total[ends] - total[begins]) * down[begins] + (ends - begins).astype(np.uint64)), begins


def text_blocks(texts: pa.Array):
    """``(row numbers, bytes, offsets)`` of some rows at a time; a blank follows each text."""
    rows, parts, size = [], [], 0
    for i, t in enumerate(texts):
        data = t.as_buffer() if t.is_valid else b""
        rows.append(i)
        parts.append(data)
        size += len(data) if isinstance(data, bytes) else data.size
        if size >= BLOCK_BYTES:
            yield _joined(rows, parts)
            rows, parts, size = [], [], 0
    if rows:
        yield _joined(rows, parts)


def _joined(rows: list[int], parts: list) -> tuple[list[int], np.ndarray, np.ndarray]:
    data = np.frombuffer(b" ".join([*(memoryview(p) for p in parts), b""]), np.uint8)
    sizes = np.array([memoryview(p).nbytes + 1 for p in parts])
    return rows, data, np.concatenate(([0], np.cumsum(sizes)))


def shingle_sets(texts: pa.Array, shingle: int):
    """``(row, sorted distinct shingle hashes)`` for each text; empty without words."""
    for rows, data, offsets in text_blocks(texts):
        words, begins = word_hashes(data)
        first = np.searchsorted(begins, offsets)
        n = words.size
        if n >= shingle:
            every = words[:n - shingle + 1] * _PLACE[0]
            for k in range(1, shingle):
                every = every + words[k:n - shingle + 1 + k] * _PLACE[k]
            every = _mix(every)
        for i, row in enumerate(rows):
            a, b = int(first[i]), int(first[i + 1])
            if b - a >= shingle:
                yield row, np.unique(every[a:b - shingle + 1])
            elif b > a:
                # A whole sequence shorter than a shingle, apart from shingles by its length.
                h = np.add.reduce(words[a:b] * _PLACE[:b - a]) + np.uint64(b - a)
                yield row, _mix(np.array([h], np.uint64))
            else:
                yield row, np.zeros(0, np.uint64)


def signature(values: np.ndarray) -> np.ndarray:
    """``N_SYMBOLS`` symbols of a non-empty set."""
    out = np.empty(N_SYMBOLS, np.uint64)
    for k in range(N_SYMBOLS):
        out[k] = ((values ^ _XOR[k]) * _MULTIPLY[k]).min()
    return (_mix(out) >> np.uint64(64 - BITS)).astype(np.uint16)


def _set_id(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """``_id, text_key, n_shingles, set_id, sig``; the last two null for empty sets."""
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n, sets, sigs = [], [], []
            for _, values in shingle_sets(batch.column(1), shingle):
                n.append(values.size)
                sets.append(_set_id(values) if values.size else None)
                sigs.append(signature(values).tobytes() if values.size else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(sets, pa.binary()),
                 pa.array(sigs, pa.binary())], names=["_id", "text_key", "n_shingles", "set_id", "sig"])

    return docs.select("_id", "_text", text_key(F.col("_text")).alias("text_key")).mapInArrow(
        run, f"_id {kind}, text_key long, n_shingles long, set_id binary, sig binary")


def _chunk_keys(classes: DataFrame) -> DataFrame:
    """``key, node``: a key per chunk and left-out position."""
    bounds = np.linspace(0, N_SYMBOLS, CHUNKS + 1).astype(int)
    salts = np.arange(CHUNKS * 64, dtype=np.uint64) * _PLACE[32]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, N_SYMBOLS)
            node = batch.column(0)
            for c in range(CHUNKS):
                part = sig[:, bounds[c]:bounds[c + 1]].astype(np.uint64) + np.uint64(1)
                terms = part * _PLACE[:part.shape[1]]
                whole = terms.sum(axis=1, dtype=np.uint64)
                for j in range(part.shape[1]):
                    key = _mix(whole - terms[:, j] + salts[c * 64 + j]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(key), node], names=["key", "node"])

    return classes.select("node", "sig").mapInArrow(run, "key long, node long")


def _near(pairs: DataFrame) -> DataFrame:
    """``a, b`` of the pairs (``a, sig_a, b, sig_b``) within ``VERIFY_DISTANCE``."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, N_SYMBOLS)
                    for c in (1, 3))
            near = pa.array((x != y).sum(axis=1) <= VERIFY_DISTANCE)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(2).filter(near)], names=["a", "b"])

    return pairs.select("a", "sig_a", "b", "sig_b").mapInArrow(run, "a long, b long")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, shared, total`` of the pairs whose full sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("values").alias("va"))
    right = sets.select(F.col("node").alias("b"), F.col("values").alias("vb"))

    def run(batches):
        for batch in batches:
            keep, shared, total = [], [], []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                both = np.intersect1d(x, y, assume_unique=True).size
                if 100 * both >= percent * (x.size + y.size - both):
                    keep.append(i)
                    shared.append(both)
                    total.append(x.size + y.size - both)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at),
                                              pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
                                             names=["a", "b", "shared", "total"])

    return (pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb")
            .mapInArrow(run, "a long, b long, shared long, total long"))


def _merge_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``node, comp`` after the links' components are joined."""
    of = labels.select(F.col("node").alias("n"), "comp")
    edges = (links.join(of.select(F.col("n").alias("a"), F.col("comp").alias("ca")), "a")
             .join(of.select(F.col("n").alias("b"), F.col("comp").alias("cb")), "b")
             .filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    joined = connected_components(edges, "near-components").select(
        F.col("node").alias("comp"), F.col("comp").alias("root"))
    return materialize(labels.join(joined, "comp", "left")
                       .select("node", F.coalesce("root", "comp").alias("comp")), "near-labels")


def class_components(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, classes, labels)``: rows ``_id, n_shingles, set_id``; classes
    ``node, set_id, first_id``; labels ``node, comp`` of the classes that met
    another one."""
    rows = materialize(_signatures(docs, shingle), "near-rows")
    classes = materialize(
        rows.filter("set_id is not null").groupBy("set_id")
        .agg(F.min("_id").alias("first_id"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    keys = _chunk_keys(classes)
    dealt = classes.select("node", "sig").repartition(classes.count() // KEY_CLASSES + 1, "node")
    buckets = materialize(_chunk_keys(dealt).groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "near-buckets")
    members = materialize(keys.join(bounded_broadcast(buckets), "key").select("key", "node", "n"), "near-members")
    # Whoever meets most others stands in the middle of its group.
    nodes = materialize(members.groupBy("node").agg(F.sum(F.col("n") - 1).alias("degree")), "near-nodes")
    members = materialize(members.join(nodes, "node").select("key", "node", "degree"), "near-members")
    sig = classes.select("node", "sig")
    labels = materialize(nodes.select("node", F.col("node").alias("comp")), "near-labels")

    wanted = materialize(classes.join(nodes.select("node"), "node", "left_semi").select("node", "set_id", "first_id"),
                         "near-wanted")
    sets = materialize(_full_sets(docs, wanted, shingle), "near-sets")

    def with_signatures(pairs: DataFrame) -> DataFrame:
        return (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
                .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"))

    def linked(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The labels after the near ones of the pairs are confirmed."""
        near = materialize(_near(pairs).distinct(), "near-pairs")
        return _merge_labels(labels, materialize(_confirm(near, sets, percent), "near-links"))

    def centres(places: DataFrame) -> DataFrame:
        """``key, degree, centre``: the member of each bucket that meets most others."""
        top = places.groupBy("key").agg(F.max(F.struct("degree", "node")).alias("top"))
        return top.select("key", F.col("top.degree").alias("c_degree"), F.col("top.node").alias("centre"))

    # 1. Every node with the most central node that it meets anywhere.
    met = members.join(centres(members), "key").filter("centre <> node")
    best = met.groupBy("node").agg(F.max(F.struct("c_degree", "centre")).alias("top"))
    labels = linked(with_signatures(best.select(F.col("top.centre").alias("a"), F.col("node").alias("b"))), labels)
    # 2. In every bucket that still holds several components, all members with its centre.
    left = materialize(_mixed(members, members, labels), "near-left")
    if left.isEmpty():
        return rows, classes, labels
    chosen = materialize(centres(left).select("key", "centre"), "near-centres")
    star = (left.join(chosen, "key").filter("centre <> node")
            .select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    star = (star.join(labels.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a")
            .join(labels.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b")
            .filter("ca <> cb").select("a", "b"))
    labels = linked(with_signatures(star), labels)
    # 3. What is left: compared exactly, across components.
    rest = materialize(_mixed(left, members, labels).select("node").distinct().join(labels, "node"), "near-rest")
    pairs = _prefix_pairs(rest, sets.join(rest.select("node"), "node", "left_semi"), percent)
    confirmed = _confirm(materialize(pairs, "near-pairs"), sets, percent)
    labels = _merge_labels(labels, materialize(confirmed, "near-links"))
    return rows, classes, labels


def _prefix_pairs(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs of nodes of different components (``node, comp``) that
    can reach the similarity; every pair that reaches it is among them.

    With all shingles in one order, rarest first, two sets that share at least
    ``need`` shingles have their first common one at a place with ``need`` or
    more behind it in both.  Copies of one text differ in rare shingles, which
    come first, so that copies too far apart do not meet.
    """
    def run(batches):
        for batch in batches:
            values = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(1)]
            if values:
                node = np.repeat(batch.column(0).to_numpy(), [v.size for v in values])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(values)), pa.array(node)], names=["h", "node"])

    shingles = sets.select("node", "values").mapInArrow(run, "h long, node long")
    shared = materialize(shingles.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1"), "near-shared")
    of_node = (shingles.join(shared, "h").groupBy("node")
               .agg(F.array_sort(F.collect_list(F.struct("k", "h"))).alias("common")))
    n = (F.octet_length("values") / 8).cast("long")
    sized = (sets.select("node", n.alias("n")).join(of_node, "node").join(nodes, "node")
             .withColumn("alone", F.col("n") - F.size("common")))
    # Shingles of no other set come before all others; beyond the prefix nothing need be compared.
    prefix = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1 - F.col("alone")
    places = (sized.withColumn("take", prefix.cast("int")).filter("take > 0")
              .select("node", "comp", "n", "alone", F.posexplode(F.slice("common", F.lit(1), F.col("take"))).alias("i", "c"))
              .select(F.col("c.h").alias("h"), "node", "comp", "n", (F.col("n") - F.col("alone") - F.col("i")).alias("behind")))
    places = materialize(places, "near-places")
    mixed = (places.groupBy("h").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
             .filter("c0 <> c1").select("h"))
    places = materialize(places.join(mixed, "h", "left_semi"), "near-places")
    x, y = (places.select("h", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "comp", "n", "behind")]) for side in "ab")
    need = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    met = x.join(y, (x["h"] == y["h"]) & (F.col("comp_a") < F.col("comp_b")) & (F.least("behind_a", "behind_b") >= need))
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _mixed(places: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``places`` in buckets whose members are of several components."""
    mixed = (members.select("key", "node").join(labels, "node").groupBy("key")
             .agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("key"))
    return places.join(mixed, "key", "left_semi")


def _full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``node, values``: the sets of the wanted classes, each from the documents
    that have the class's first id."""
    ids = bounded_broadcast(wanted.select(F.col("first_id").alias("_w")).distinct())
    texts = docs.join(ids, F.col("_id").eqNullSafe(F.col("_w")), "left_semi").select("_text")

    def run(batches):
        for batch in batches:
            sets, values = [], []
            for _, v in shingle_sets(batch.column(0), shingle):
                sets.append(_set_id(v))
                values.append(v.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary()), pa.array(values, pa.binary())],
                                             names=["set_id", "values"])

    found = texts.mapInArrow(run, "set_id binary, values binary")
    return (found.join(wanted.select("set_id", "node"), "set_id")
            .dropDuplicates(["node"]).select("node", "values"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One row per input row: ``doc_id, text_key, n_shingles, class_id`` (the
    component's number; null for an empty set), ``component_id, kept`` (the id
    is its component's)."""
    ship_package(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows, classes, labels = class_components(slim, shingle, percent)
    of = classes.select("node", "set_id", "first_id").join(labels, "node", "left") \
        .withColumn("comp", F.coalesce("comp", "node"))
    firsts = of.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    # Only classes that met another can differ from their own first id.
    placed = materialize(of.join(firsts, "comp").select(F.col("set_id").alias("_set"), F.col("comp").alias("class_id"),
                                                        "component_id"), "near-placed")
    out = rows.join(placed, rows["set_id"] == placed["_set"], "left")
    component = F.when(F.col("set_id").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return out.select(F.col("_id").alias("doc_id"), "text_key", "n_shingles", "class_id", component.alias("component_id"),
                      F.col("_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id.

    Keys of the rows that go are joined, never their texts.  Rows with empty
    sets all stay.  Where several rows of a component have its id, the one with
    the smallest text hash stays, and of equal rows one.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, percent)
    slim = materialize(found.filter("class_id is not null").select("doc_id", "text_key", "class_id", "kept"), "near-found")
    tied = materialize(slim.filter("kept").groupBy("class_id")
                       .agg(F.min("text_key").alias("first_key"), F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
                       .filter("n > 1").drop("n"), "near-tied")
    gone = slim.filter("not kept").select("doc_id", "text_key")
    again = None
    if not tied.isEmpty():  # ids are repeated within a component
        extra = slim.filter("kept").join(bounded_broadcast(tied), "class_id").filter("text_key <> first_key")
        gone = gone.unionByName(extra.select("doc_id", "text_key"))
        again = tied.select(F.col("first_id").alias("_a_id"), F.col("first_key").alias("_a_key")).distinct()
    gone = materialize(gone.distinct().select(F.col("doc_id").alias("_g_id"), F.col("text_key").alias("_g_key")), "near-gone")

    def rows(frame: DataFrame, keys: DataFrame, i: str, k: str, how: str) -> DataFrame:
        return frame.join(keys, frame[id_col].eqNullSafe(keys[i]) & (text_key(frame[text_col]) == keys[k]), how)

    kept = rows(docs, bounded_broadcast(gone), "_g_id", "_g_key", "left_anti")
    if again is None:
        return kept
    again = bounded_broadcast(materialize(again, "near-again"))
    return rows(kept, again, "_a_id", "_a_key", "left_anti").unionByName(
        rows(kept, again, "_a_id", "_a_key", "left_semi").dropDuplicates([id_col, text_col]))
