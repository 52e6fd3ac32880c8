"""Alignment of two tokenizers over the same bytes.

Tokenizer A is byte-level, tokenizer B a piece model with byte fallback that
sets a blank before the text; A encodes the text with that blank.  Both token
sequences then cut the same bytes.  Offsets where a token of each ends cut them
into groups; an A and a B token that share a group are linked.

*Matrices.*  With A the incidence of A's tokens and bytes and B that of B's,
both in compressed sparse rows built here, the row products A.B^T give the
overlap links (and the bytes each shares).  The products of the incidences of
token ids and groups give the shared-group links with their number.  Both are
Gustavson products: each entry of a left row scales the right row it points
at, and equal columns are summed.

*Pieces.*  Both tokenizers end a token before a blank that follows a character
other than white space, so groups never cross such a place.  Matrices are built
for distinct pieces (see ``pieces``), once per worker process, and a document's
links are those of its pieces.

*Counts.*  Documents are taken in blocks of ``BLOCK_BYTES`` of text.  A block is
one stored row: per document the id pairs it links and how often, as places
in the block's list of distinct pairs, compressed.  Only these distinct pairs, with the number of the
block's documents that hold them, are shuffled to be counted over the corpus;
the counts go back to the blocks by one join.  Neither depends on how many
documents share a pair, and nothing is broadcast.

Defined results: a text that is null or empty, or whose tokens do not give back its
bytes, has no tokens: all numbers 0, ``groups_sha256`` empty; repeated rows
count as documents of their own and give repeated results; a null id is
passed on; an empty table gives an empty result; other columns are ignored
whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import pieces as P
from kindred.llm.common import materialize
from kindred.session import ship_package

#: Text of a block, and of the pieces whose matrices are built at once.
BLOCK_BYTES = 2 << 20
MATRIX_BYTES = 1 << 19
#: Pieces, and bytes of their results, kept per Python worker; the memory starts anew when full.
MEMORY_PIECES, MEMORY_BYTES = 150_000, 48 << 20
SPACE = "▁"

COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


# -- sparse rows ------------------------------------------------------------------

class Rows:
    """A matrix in compressed sparse rows: the columns and values of row ``i``
    are at ``ptr[i]`` to ``ptr[i + 1]``."""

    def __init__(self, ptr: np.ndarray, col: np.ndarray, val: np.ndarray, n_cols: int):
        self.ptr, self.col, self.val, self.n_cols = ptr, col, val, n_cols

    @classmethod
    def of(cls, row: np.ndarray, col: np.ndarray, n_rows: int, n_cols: int) -> Rows:
        """From entries in any order; equal ones are summed."""
        key, times = np.unique(row * np.int64(n_cols) + col, return_counts=True)
        ptr = np.searchsorted(key, np.arange(n_rows + 1, dtype=np.int64) * n_cols)
        return cls(ptr, key % max(n_cols, 1), times.astype(np.int64), n_cols)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def times(self, other: Rows) -> Rows:
        """The product, row by row: every entry fetches the row of ``other``
        that its column names; equal columns of a row are summed."""
        size = np.diff(other.ptr)[self.col]
        total = int(size.sum())
        at = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(other.ptr[self.col], size)
        row = np.repeat(self.row_of(), size)
        key, inverse = np.unique(row * np.int64(max(other.n_cols, 1)) + other.col[at], return_inverse=True)
        val = np.zeros(len(key), np.int64)
        np.add.at(val, inverse, np.repeat(self.val, size) * other.val[at])
        ptr = np.searchsorted(key, np.arange(len(self.ptr), dtype=np.int64) * max(other.n_cols, 1))
        return Rows(ptr, key % max(other.n_cols, 1), val, other.n_cols)


def byte_incidence(sizes: np.ndarray) -> Rows:
    """Tokens and the bytes they stand on, one after another."""
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    return Rows(np.concatenate(([0], ends)), np.arange(n), np.ones(n, np.int64), n)


def byte_incidence_transposed(sizes: np.ndarray) -> Rows:
    """Bytes and the token that stands on each."""
    n = int(sizes.sum())
    return Rows(np.arange(n + 1), np.repeat(np.arange(len(sizes)), sizes), np.ones(n, np.int64), len(sizes))


# -- pieces -----------------------------------------------------------------------

def byte_level_table() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 for itself, the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Aligner:
    """Tokens, groups and links of pieces; a piece is given without the blank
    before it."""

    def __init__(self, a_path: str, b_path: str, memory: int = MEMORY_PIECES, memory_bytes: int = MEMORY_BYTES):
        import sentencepiece
        self._a = P.ByteEncoder(a_path, special_as_text=True)
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        of = byte_level_table()
        a_tokens = [b""] * len(self._a.n_bytes)
        for token, i in self._a.tokenizer.get_vocab().items():
            a_tokens[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        names = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        if any(SPACE in n.lstrip(SPACE) for n in names):
            raise ValueError("a token of B runs into a blank: texts cannot be cut before blanks")
        byte = re.compile(r"<0x([0-9A-F]{2})>\Z")
        b_tokens = [bytes([int(m[1], 16)]) if (m := byte.match(n)) else n.replace(SPACE, " ").encode() for n in names]
        self._blank = self._b.piece_to_id(SPACE)
        self._tokens = pa.array(a_tokens, pa.large_binary()), pa.array(b_tokens, pa.large_binary())
        self._sizes = tuple(np.array([len(t) for t in x], np.int64) for x in (a_tokens, b_tokens))
        self._memory = P.Memory(self._learn_all, memory, memory_bytes)

    def _encode(self, values: list[str]) -> list[pa.LargeListArray]:
        b = [x if v else [self._blank] for v, x in zip(values, self._b.encode(values, num_threads=1))]  # "" is a blank alone
        ptr = np.cumsum([0, *map(len, b)], dtype=np.int64)
        flat = np.fromiter(itertools.chain.from_iterable(b), np.uint32, int(ptr[-1]))
        return [self._a.encode([" " + v for v in values]), pa.LargeListArray.from_arrays(pa.array(ptr), pa.array(flat))]

    def _learn_all(self, values: list[str]) -> list[pa.Array]:
        parts = [self._learn(values[begin:end])
                 for begin, end in P.byte_slices(pa.array(values, pa.large_string()), MATRIX_BYTES)]
        return [pa.concat_arrays(column) for column in zip(*parts)]

    def _learn(self, values: list[str]) -> list[pa.Array]:
        """Columns with a row per piece: the counts, group text, pairs, times;
        null counts if its bytes do not come back."""
        tokens = self._encode(values)
        want = pa.array([" " + v for v in values], pa.large_string()).cast(pa.large_binary())
        ok = np.ones(len(values), bool)
        for table, lists in zip(self._tokens, tokens):
            joined = pc.binary_join(pa.LargeListArray.from_arrays(lists.offsets, table.take(lists.values)), pa.scalar(b"", pa.large_binary()))
            ok &= pc.equal(joined, want).to_numpy(zero_copy_only=False)
        if not ok.all():
            tokens, want = [x.filter(pa.array(ok)) for x in tokens], want.filter(pa.array(ok))
        n = len(want)
        ids = [x.flatten().to_numpy().astype(np.int64) for x in tokens]
        n_tokens = [pc.list_value_length(x).to_numpy() for x in tokens]
        sizes = [s[i] for s, i in zip(self._sizes, ids)]
        ends = [np.cumsum(s) for s in sizes]
        overlaps = byte_incidence(sizes[0]).times(byte_incidence_transposed(sizes[1]))

        cuts = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(cuts, e) for e in ends]
        piece_of = np.searchsorted(np.cumsum(pc.binary_length(want).to_numpy()), cuts)  # of a group
        # Rows: an id of A within a piece; columns: groups.  Times: groups by ids of B.
        rows, row_of = np.unique(piece_of[group[0]] << 32 | ids[0], return_inverse=True)
        left = Rows.of(row_of, group[0], len(rows), max(len(cuts), 1))
        right = Rows.of(group[1], ids[1], len(cuts), 1 << 32)
        links = left.times(right)
        link_row = rows[links.row_of()]
        link_ptr = np.searchsorted(link_row >> 32, np.arange(n + 1))

        def per_piece(piece: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
            """Sums over what lies in piece order."""
            total = np.concatenate(([0], np.cumsum(np.ones(len(piece), np.int64) if weight is None else weight)))
            at = np.searchsorted(piece, np.arange(n + 1))
            return total[at[1:]] - total[at[:-1]]

        counts = [*n_tokens, per_piece(piece_of), per_piece(link_row >> 32, links.val),
                  per_piece(piece_of[group[0]], np.diff(overlaps.ptr))]
        sides = []
        for x, g in zip(ids, group):
            starts = np.searchsorted(g, np.arange(len(cuts) + 1))
            sides.append(_join(starts, pc.cast(pa.array(x), pa.large_string()), ","))
        texts = _join(np.searchsorted(piece_of, np.arange(n + 1)), pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string())), ";")
        ptr = pa.array(link_ptr, pa.int64())
        out = [*(pa.array(c, pa.int64()) for c in counts), texts,
               pa.LargeListArray.from_arrays(ptr, pa.array((link_row & 0xFFFFFFFF) << 32 | links.col)),
               pa.LargeListArray.from_arrays(ptr, pa.array(links.val))]
        if ok.all():
            return out
        place = np.cumsum(ok) - 1
        return [c.take(pa.array(place, mask=~ok)) for c in out]

    def block(self, texts: pa.Array) -> dict:
        """Per text the counts and the digest of its groups; ``pairs`` that any
        text links, ``pair_docs`` how many do; and the texts' pairs as places in
        ``pairs`` (``at``, ``times``, from ``ptr[i]`` to ``ptr[i + 1]``)."""
        n = len(texts)
        filled = pc.fill_null(texts, "")
        there = pc.greater(pc.binary_length(filled), 0).to_numpy(zero_copy_only=False)
        split = P.cut(pc.binary_join_element_wise(pa.scalar(" ", texts.type), filled, pa.scalar("", texts.type)), whole_runs=True)
        ptr = split.offsets.to_numpy().astype(np.int64)
        values = split.values.slice(ptr[0], ptr[-1] - ptr[0])
        ptr -= ptr[0]
        # The blank set before the text: an empty first piece, or the first piece begins with it.
        bare = pc.equal(values.take(pa.array(ptr[:-1])), pa.scalar("", texts.type)).to_numpy(zero_copy_only=False)
        text_of = np.repeat(np.arange(n), np.diff(ptr))
        keep = there[text_of]
        keep[ptr[:-1][bare]] = False
        if not bare.all():
            first = np.zeros(len(values), bool)
            first[ptr[:-1][~bare]] = True
            values = pc.if_else(pa.array(first), pc.utf8_slice_codeunits(values, 1), values)
        values, text_of = values.filter(pa.array(keep)), text_of[keep]
        coded = pc.dictionary_encode(values)
        codes = coded.indices.to_numpy().astype(np.int64)
        place = self._memory.places(coded.dictionary.to_pylist())
        table = [c.take(pa.array(place)) for c in self._memory.table] if len(place) else self._learn([])
        lost = pc.is_null(table[0]).to_numpy(zero_copy_only=False)
        good = there.copy()
        if lost.any():
            good[text_of[lost[codes]]] = False
            keep = good[text_of]
            codes, text_of = codes[keep], text_of[keep]

        starts = np.searchsorted(text_of, np.arange(n + 1))
        out = {}
        for name, column in zip(COUNTS, table):
            sums = np.concatenate(([0], np.cumsum(pc.fill_null(column, 0).to_numpy()[codes])))
            out[name] = sums[starts[1:]] - sums[starts[:-1]]
        groups = _join(starts, table[len(COUNTS)].take(pa.array(codes)), ";")
        out["groups_sha256"] = [hashlib.sha256(g.as_buffer()).hexdigest() if ok else "" for g, ok in zip(groups, good.tolist())]

        # Each text's distinct pieces and how often it has them, then their pairs.
        width = max(len(place), 1)
        key, often = np.unique(text_of * np.int64(width) + codes, return_counts=True)
        owned = Rows(np.searchsorted(key, np.arange(n + 1, dtype=np.int64) * width), key % width, often.astype(np.int64), width)
        sizes = pc.fill_null(pc.list_value_length(table[-1]), 0).to_numpy()
        pairs, pair_at = np.unique(table[-2].flatten().to_numpy(), return_inverse=True)
        links = Rows(np.concatenate(([0], np.cumsum(sizes))), pair_at, table[-1].flatten().to_numpy(), max(len(pairs), 1))
        held = owned.times(links)
        docs = np.bincount(held.col, minlength=len(pairs))
        if lost.any() and not docs.all():  # pairs of pieces that only texts without tokens have
            new = np.cumsum(docs > 0) - 1
            pairs, held.col, docs = pairs[docs > 0], new[held.col], docs[docs > 0]
        return out | {"pairs": pairs, "pair_docs": docs, "ptr": held.ptr.astype(np.int64), "at": held.col.astype(np.int32),
                      "times": held.val}


def _join(starts: np.ndarray, texts: pa.Array, by: str) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), texts), pa.scalar(by, pa.large_string()))


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process: its memory serves all tasks that the worker runs."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def _pack(numbers: np.ndarray) -> bytes:
    """Rising or small numbers as few bytes: differences, compressed."""
    return pa.compress(np.diff(numbers, prepend=numbers.dtype.type(0)).tobytes(), codec="zstd", asbytes=True)


def _unpack(data: pa.Scalar, dtype: type, n: int) -> np.ndarray:
    raw = pa.decompress(data.as_buffer(), n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True)
    return np.cumsum(np.frombuffer(raw, dtype), dtype=dtype)


# -- corpus -----------------------------------------------------------------------

def blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The stored blocks of aligned documents, one row each."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"block long, doc_ids array<{kind}>, {', '.join(f'{c} array<long>' for c in COUNTS)}, "
              "groups_sha256 array<string>, pairs array<long>, pair_docs array<long>, ptr binary, at binary, times binary")

    def align(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner, n = _aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        kinds = [pa.int64(), None, *[pa.list_(pa.int64())] * len(COUNTS), pa.list_(pa.string()), pa.list_(pa.int64()),
                 pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        names = ["block", "doc_ids", *COUNTS, "groups_sha256", "pairs", "pair_docs", "ptr", "at", "times"]
        for batch in batches:
            kinds[1] = pa.list_(batch.column(0).type)
            for begin, end in P.byte_slices(batch.column(1), block_bytes):
                some = batch.slice(begin, end - begin)
                b = aligner.block(some.column(1))
                row = [n, some.column(0).to_pylist(), *(b[c] for c in COUNTS), b["groups_sha256"], b["pairs"], b["pair_docs"],
                       _pack(b["ptr"]), _pack(b["at"]), _pack(b["times"])]
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)
                n += 1

    return materialize(rows.mapInArrow(align, schema), "align-blocks")


def pair_counts(stored: DataFrame) -> DataFrame:
    """``a, b, n_docs, best``: per linked id pair the documents that hold it
    and whether no pair of the same A id is in more."""
    asked = stored.select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
    counts = materialize(asked.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_docs").alias("n_docs")), "align-counts")
    counts = counts.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "pair", "n_docs")
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a").select("pair", "a", "b", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_overlaps,
    n_best, count_sum, groups_sha256``."""
    stored = blocks(docs, a_path, b_path, id_col, text_col, block_bytes)
    counts = pair_counts(stored).select("pair", "n_docs", "best")
    asked = stored.select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = (asked.join(counts, "pair").groupBy("block")
               .agg(F.collect_list(F.struct("place", "n_docs", "best")).alias("answer")))  # bounded by the block's text
    rows = stored.drop("pairs", "pair_docs").join(answers, "block", "left")
    kind = stored.schema["doc_ids"].dataType.elementType.simpleString()
    columns = ["doc_ids", *COUNTS, "groups_sha256", "ptr", "at", "times", "answer"]

    def add_up(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k] for i, name in enumerate(columns)}
                ptr = _unpack(row["ptr"], np.int64, len(row["doc_ids"]) + 1)
                at, times = _unpack(row["at"], np.int32, int(ptr[-1])), _unpack(row["times"], np.int64, int(ptr[-1]))
                n_docs, best = np.zeros(0, np.int64), np.zeros(0, bool)
                if row["answer"].is_valid:
                    answer = row["answer"].values
                    place = answer.field("place").to_numpy()
                    n_docs, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
                    n_docs[place] = answer.field("n_docs").to_numpy()
                    best[place] = answer.field("best").to_numpy(zero_copy_only=False)
                sums = []
                for each in (times * best[at], times * n_docs[at]):
                    total = np.concatenate(([0], np.cumsum(each)))
                    sums.append(pa.array(total[ptr[1:]] - total[ptr[:-1]], pa.int64()))
                yield pa.RecordBatch.from_arrays([row["doc_ids"].values, *(row[c].values for c in COUNTS), *sums, row["groups_sha256"].values],
                                                 names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"])

    numbers = ", ".join(f"{c} long" for c in (*COUNTS, "n_best", "count_sum"))
    return rows.select(*columns).mapInArrow(add_up, f"doc_id {kind}, {numbers}, groups_sha256 string")
