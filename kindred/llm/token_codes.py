"""Token ids as directly addressable codes (DAC).

A stream of ids is split into chunk levels of 8 bits.  Level 0 holds the low
byte of every id, level 1 the next byte of the ids that have one, and so on.
Beside each level but the last lies a bitmap with one bit per entry (set: the
id goes on in the next level) and a rank directory with the number of set bits
before every 512th entry.  The entry at position i of one level continues at
position ``rank(i)`` of the next, so any id is read with a few byte accesses,
whatever its place, and nothing around it is decoded.

Files: a Parquet table written and committed by Spark (so that a lost executor
leaves no half-written part), one row per segment of consecutive documents, in
ascending id order: ``part`` and ``segment`` number it, ``first`` is the number
of ids before it in its part, and the codes are binary columns.  Documents are
dealt by ranges of ``(id, text hash)``; a part is one range.  A segment closes
at the first document end after ``segment_ids`` ids.

Encoding runs in Arrow batches on the executors.  Texts are cut before blanks
(see ``pieces``) and every distinct piece is encoded by the library once per
worker and kept in a bounded memory; the ids are the same as those of the whole
text.  A text that holds an added token literally goes to the library whole.

Defined results: a null text is empty and gives only the end id; null ids come
first; rows with the same id are ordered by the hash of their text; an empty
table gives no segment; other columns are ignored whatever their names.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.llm import pieces as P
from kindred.llm.common import bounded_broadcast, text_key
from kindred.session import scratch_path, ship_package

BLOCK = 512
END_ID = 2
SEGMENT_IDS = 1 << 18
#: Pieces, and bytes of their ids, kept per Python worker; the memory starts anew when full.
MEMORY_PIECES, MEMORY_BYTES = 600_000, 128 << 20
#: Pieces that one call of the library encodes.
LEARN_PIECES = 1 << 14
#: Text encoded at a time: a distinct piece is looked up once in it, so larger slices look up less.
SLICE_BYTES = 12 << 20
#: Ids decoded at a time while files are read back.
SLICE_IDS = 1 << 20

CODE_SCHEMA = ("part int, segment int, first long, n_ids long, doc_ids array<{id}>, doc_sizes array<long>, "
               "levels array<binary>, bitmaps array<binary>, ranks array<binary>")


# -- codes ------------------------------------------------------------------

def encode_codes(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """``levels, bitmaps, ranks`` of an array of unsigned 32-bit ids."""
    levels, bitmaps, ranks = [], [], []
    rest = np.asarray(ids, dtype=np.uint32)
    while True:
        levels.append((rest & 0xFF).astype(np.uint8).tobytes())
        more = rest > 0xFF
        if not more.any():
            return levels, bitmaps, ranks
        bitmaps.append(np.packbits(more, bitorder="little").tobytes())
        per_block = np.add.reduceat(more.astype(np.uint32), np.arange(0, more.size, BLOCK))
        ranks.append(np.concatenate(([0], np.cumsum(per_block)[:-1])).astype("<u8").tobytes())
        rest = rest[more] >> 8


class Codes:
    """Reads one segment: any id, or any slice of ids."""

    def __init__(self, levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self._levels = [np.frombuffer(x, np.uint8) for x in levels]
        self._bits = [np.frombuffer(x, np.uint8) for x in bitmaps]
        self._ranks = [np.frombuffer(x, "<u8") for x in ranks]

    def _rank(self, level: int, at: int) -> int:
        """Set bits before entry ``at``: a directory entry and at most one block."""
        block = at // BLOCK
        if block >= len(self._ranks[level]):
            block = len(self._ranks[level]) - 1
        bits = self._bits[level][block * BLOCK // 8:(at + 7) // 8]
        inside = np.unpackbits(bits, bitorder="little")[:at - block * BLOCK]
        return int(self._ranks[level][block]) + int(inside.sum())

    def __getitem__(self, at: int) -> int:
        value, shift = int(self._levels[0][at]), 8
        for level, bits in enumerate(self._bits):
            if not bits[at >> 3] >> (at & 7) & 1:
                break
            at = self._rank(level, at)
            value |= int(self._levels[level + 1][at]) << shift
            shift += 8
        return value

    def slice(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` (exclusive) as unsigned 32-bit integers."""
        return self._slice(0, begin, end)

    def _slice(self, level: int, begin: int, end: int) -> np.ndarray:
        out = self._levels[level][begin:end].astype("<u4")
        if level < len(self._bits) and end > begin:
            bits = self._bits[level][begin // 8:(end + 7) // 8]
            more = np.unpackbits(bits, bitorder="little")[begin % 8:begin % 8 + end - begin].astype(bool)
            n = int(more.sum())
            if n:
                deeper = self._rank(level, begin)
                out[more] |= self._slice(level + 1, deeper, deeper + n) << np.uint32(8)
        return out


# -- encoding ---------------------------------------------------------------

class Encoder:
    """Encodes texts with a tokenizer file, remembering the ids of pieces."""

    def __init__(self, tokenizer_path: str, memory: int = MEMORY_PIECES, added_tokens: bool = False,
                 memory_bytes: int = MEMORY_BYTES):
        """With ``added_tokens``, an added token inside a text is its one id, as
        the library has it by default; without, it is ordinary text."""
        self._library = P.ByteEncoder(tokenizer_path, special_as_text=not added_tokens)
        added = self._library.tokenizer.get_added_tokens_decoder() if added_tokens else {}
        self._added = "|".join(re.escape(t.content) for t in added.values())
        self._first = P.ColumnMemory(lambda new: self._learn(new, ""), memory, memory_bytes)
        self._rest = P.ColumnMemory(lambda new: self._learn(new, " "), memory, memory_bytes)

    def _learn(self, new: pa.Array, blank: str) -> list[pa.Array]:
        """A call of the library makes objects far larger than the ids, so it takes some pieces at a time."""
        return [pa.concat_arrays([self._library.encode([blank + p for p in new[k:k + LEARN_PIECES].to_pylist()])
                                  for k in range(0, len(new), LEARN_PIECES)])]

    def encode(self, texts: pa.Array) -> pa.LargeListArray:
        """Per text (none null) its ids."""
        if self._added:
            # White space before an added token counts as the text's end: such texts go to the library whole.
            held = pc.match_substring_regex(texts, self._added)
            if pc.any(held).as_py():
                at = held.to_numpy(zero_copy_only=False)
                order = np.empty(len(at), np.int64)
                order[~at] = np.arange((~at).sum())
                order[at] = (~at).sum() + np.arange(at.sum())
                parts = [self._cut_and_encode(texts.filter(pc.invert(held))), self._library.whole(texts.filter(held).to_pylist())]
                return pa.concat_arrays(parts).take(pa.array(order))
        return self._cut_and_encode(texts)

    def _cut_and_encode(self, texts: pa.Array) -> pa.LargeListArray:
        n = len(texts)
        if not n:
            return self._library.whole([])
        split = P.cut(texts)
        ptr = split.offsets.to_numpy().astype(np.int64)
        values = split.values.slice(ptr[0], ptr[-1] - ptr[0])
        ptr -= ptr[0]
        coded = pc.dictionary_encode(values)
        del split, values
        codes = coded.indices.to_numpy().copy()
        first, place = np.unique(codes[ptr[:-1]], return_inverse=True)
        codes[ptr[:-1]] = -1
        rest = np.zeros(len(coded.dictionary), bool)
        rest[codes[codes >= 0]] = True
        # Pieces behind a blank are numbered anew, first pieces after them.
        codes = (np.cumsum(rest, dtype=np.int32) - 1)[codes]
        codes[ptr[:-1]] = rest.sum() + place
        tables = []
        for memory, wanted in ((self._rest, np.flatnonzero(rest)), (self._first, first)):
            if len(wanted):
                places = memory.places(coded.dictionary.take(pa.array(wanted)))
                tables.append(memory.table[0].take(pa.array(places)))
        del coded
        ids = pa.concat_arrays(tables).take(pa.array(codes))
        return pa.LargeListArray.from_arrays(ids.offsets.take(pa.array(ptr)), ids.values)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        return [x.values.to_numpy() for x in self.encode(pa.array(texts, pa.string()))]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per worker process: its memory serves all tasks that the worker runs."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, added_tokens=True)
    return _ENCODERS[path]


def write_codes(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every text, add ``end_id`` and write the segments below ``path``."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text_key(text).alias("_key"), text.alias("_text"))
    dealt = rows.repartitionByRange("_id", "_key").sortWithinPartitions("_id", "_key").select("_id", "_text")
    kind = rows.schema["_id"].dataType
    schema = CODE_SCHEMA.format(id=kind.simpleString())

    def encode(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, part = _encoder(tokenizer_path), TaskContext.get().partitionId()
        end = np.uint32(end_id)
        segment, first, n, held = 0, 0, 0, []
        arrow = None

        def close():
            nonlocal segment, first, n, held
            doc_ids, sizes, ids = zip(*held)
            levels, bitmaps, ranks = encode_codes(np.concatenate(ids))
            row = [part, segment, first, n, pa.concat_arrays(doc_ids), np.concatenate(sizes), levels, bitmaps, ranks]
            segment, first, n, held = segment + 1, first + n, 0, []
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            if arrow is None:
                arrow = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()),
                                   ("n_ids", pa.int64()), ("doc_ids", pa.list_(batch.schema.field("_id").type)),
                                   ("doc_sizes", pa.list_(pa.int64())), ("levels", pa.list_(pa.binary())),
                                   ("bitmaps", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary()))])
            for begin, stop in P.byte_slices(batch.column(1), SLICE_BYTES):
                doc_ids, texts = (batch.column(c).slice(begin, stop - begin) for c in (0, 1))
                found = encoder.encode(texts)
                sizes = pc.list_value_length(found).to_numpy().astype(np.int64)
                ids = np.insert(found.flatten().to_numpy(), np.cumsum(sizes), end)
                sizes += 1
                ends, done, taken = np.cumsum(sizes), 0, 0
                while done < len(sizes):
                    upto = min(int(np.searchsorted(ends, taken + segment_ids - n)) + 1, len(sizes))
                    held.append((doc_ids.slice(done, upto - done), sizes[done:upto], ids[taken:ends[upto - 1]]))
                    n += int(ends[upto - 1]) - taken
                    done, taken = upto, int(ends[upto - 1])
                    if n >= segment_ids:
                        yield close()
                del texts, found, ids
                # A worker lives on into other stages: it keeps the pieces, not the space that a slice took.
                pa.default_memory_pool().release_unused()
        if held:
            yield close()

    dealt.mapInArrow(encode, schema).write.option("compression", "none").parquet(path)


# -- reading ----------------------------------------------------------------

def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``: the number of ids before each in all files."""
    ship_package(spark)
    table = spark.read.parquet(path)
    # One row per part: as many as the writer had partitions.
    parts = table.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col("part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (table.join(bounded_broadcast(offsets), "part")
            .withColumn("start", F.col("_offset") + F.col("first")).drop("_offset"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``
    (of the ids as little-endian unsigned 32-bit integers)."""
    table = segments(spark, path)
    kind = table.schema["doc_ids"].dataType.elementType
    wanted = table.select("start", "doc_ids", "doc_sizes", "levels", "bitmaps", "ranks")

    def digest(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                start, doc_ids, sizes, levels, bitmaps, ranks = (batch.column(c)[k] for c in range(6))
                codes = Codes(*([x.as_buffer() for x in col] for col in (levels, bitmaps, ranks)))
                sizes = np.asarray(sizes.values, dtype=np.int64)
                ends = np.cumsum(sizes)
                begins, n = ends - sizes, int(ends[-1])
                sums, doc, begin = [0] * len(sizes), 0, 0
                stops = ends.tolist()
                for at in range(0, n, SLICE_IDS):
                    upto = min(at + SLICE_IDS, n)
                    some = memoryview(codes.slice(at, upto)).cast("B")
                    while doc < len(stops):
                        stop = min(stops[doc], upto)
                        sums[doc] = zlib.crc32(some[4 * (begin - at):4 * (stop - at)], sums[doc])
                        begin = stop
                        if stops[doc] > upto:
                            break
                        doc += 1
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(begins + start.as_py()), pa.array(sizes), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return wanted.mapInArrow(digest, f"doc_id {kind.simpleString()}, start long, n_tokens long, ids_crc32 long")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """The id at each of the given ``position`` values (those outside are
    dropped): ``position, token``.  Positions and segments meet by an equi-join
    on cells of ``SEGMENT_IDS`` positions; only the bytes of the ids asked for
    are then read from the codes."""
    table = segments(spark, path)
    cell = (F.col("start") / SEGMENT_IDS).cast("long")
    last = ((F.col("start") + F.col("n_ids") - 1) / SEGMENT_IDS).cast("long")
    places = table.select("part", "segment", "start", "n_ids", F.explode(F.sequence(cell, last)).alias("cell"))
    asked = positions.select(F.col("position").cast("long").alias("position")).withColumn(
        "cell", (F.col("position") / SEGMENT_IDS).cast("long"))
    found = (asked.join(places, "cell").filter("position >= start and position < start + n_ids")
             .select("position", (F.col("position") - F.col("start")).alias("at"), "part", "segment"))
    grouped = (found.join(table.select("part", "segment", "levels", "bitmaps", "ranks"), ["part", "segment"])
               .select("position", "at", "levels", "bitmaps", "ranks"))

    def pick(batches):
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                codes = Codes(*([x.as_buffer() for x in batch.column(c)[k]] for c in (2, 3, 4)))
                out.append(codes[batch.column(1)[k].as_py()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], names=["position", "token"])

    return grouped.mapInArrow(pick, "position long, token long")


def token_codes(docs: DataFrame, tokenizer_path: str, path: str | None = None, **options) -> DataFrame:
    """Write the codes (to a new folder in the shared one if ``path`` is None)
    and return :func:`read_documents` of them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-codes")
    write_codes(docs, path, tokenizer_path, **options)
    return read_documents(spark, path)
