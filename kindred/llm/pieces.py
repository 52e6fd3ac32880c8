"""Texts cut into pieces whose tokens, put in a row, are the text's tokens.

A byte-level tokenizer whose pre-tokens never run from other characters into
white space may be cut before any blank that follows a character other than
white space.  Most texts can simply be split at every blank; only a blank with
white space before it and white space (or the text's end) behind it belongs to
a run that must stay whole.  Splitting and counting distinct pieces runs on
whole Arrow columns, and each distinct piece is encoded by the library itself,
once per worker process: no rule of the tokenizer but the cut is restated here.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The characters with the White_Space property.
WHITE = "\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A text that cannot be split at every blank.
_RUN = f"[{WHITE}] (?:[{WHITE}]|\\z)"
_TWO = f"{_RUN}|  "
_CUT = re.compile(f"(?<=[^{WHITE}]) ")
_WHITE = {c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c)}


def byte_slices(column: pa.Array, most: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text each (or one row)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    out, begin = [], 0
    while begin < len(sizes):
        base = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + most, side="right")))
        out.append((begin, end))
        begin = end
    return out


def cut(texts: pa.Array, whole_runs: bool = False) -> pa.ListArray:
    """Per text its pieces without the blank that begins each but the first.
    With ``whole_runs`` no two blanks in a row are parted."""
    odd = pc.match_substring_regex(texts, _TWO if whole_runs else _RUN)
    if not pc.any(odd).as_py():
        return pc.split_pattern(texts, " ")
    rest = pa.array([_CUT.split(t) for t in texts.filter(odd).to_pylist()], pa.list_(texts.type))
    plain = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
    at = odd.to_numpy(zero_copy_only=False)
    order = np.empty(len(at), np.int64)
    order[~at] = np.arange(len(plain))
    order[at] = len(plain) + np.arange(len(rest))
    return pa.concat_arrays([plain, rest]).take(pa.array(order))


class ByteEncoder:
    """Encodes many short texts under a byte-level tokenizer file."""

    JOINED = 64

    def __init__(self, tokenizer_path: str, special_as_text: bool):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = special_as_text
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # byte-level: a character a byte
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)

    def _flat(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def whole(self, texts: list[str]) -> pa.LargeListArray:
        """Ids of texts, each encoded by itself."""
        ids = self._flat(texts)
        ptr = np.cumsum([0, *map(len, ids)], dtype=np.int64)
        return pa.LargeListArray.from_arrays(pa.array(ptr), pa.array(np.concatenate([np.zeros(0, np.uint32), *ids])))

    def encode(self, pieces: list[str]) -> pa.LargeListArray:
        """Ids of pieces as they are.  Those from a blank to a character other
        than white space stay apart in a row: one call encodes many of them, and
        the bytes that each id stands for show where a piece ends."""
        apart = [i for i, p in enumerate(pieces) if p[:1] == " " and p[-1] not in _WHITE]
        taken = set(apart)
        alone = [i for i in range(len(pieces)) if i not in taken] if len(apart) < len(pieces) else []
        rows = ["".join([pieces[i] for i in apart[k:k + self.JOINED]]) for k in range(0, len(apart), self.JOINED)]
        joined = np.concatenate([np.zeros(0, np.uint32), *self._flat(rows)])
        sizes = pc.binary_length(pa.array([pieces[i] for i in apart], pa.large_string())).to_numpy(zero_copy_only=False)
        cuts = np.searchsorted(np.cumsum(self.n_bytes[joined]), np.cumsum(sizes)) + 1
        others = self._flat([pieces[i] for i in alone])
        ptr = np.concatenate(([0], cuts, len(joined) + np.cumsum([len(x) for x in others], dtype=np.int64)))
        lists = pa.LargeListArray.from_arrays(pa.array(ptr, pa.int64()), pa.array(np.concatenate([joined, *others])))
        if not alone:
            return lists
        order = np.empty(len(pieces), np.int64)
        order[apart + alone] = np.arange(len(pieces))
        return lists.take(pa.array(order))


class Memory:
    """Where in a table of results each piece met so far stands.  The table (any
    list of Arrow columns) grows by what is learned and starts anew at a bound."""

    def __init__(self, learn, pieces: int, table_bytes: int):
        self._learn, self._pieces, self._bytes = learn, pieces, table_bytes
        self._at: dict[str, int] = {}
        self.table: list[pa.Array] | None = None

    def places(self, values: list[str]) -> np.ndarray:
        """The places of distinct pieces in ``table``."""
        at = self._at
        if self.table is not None and (len(at) > self._pieces or sum(c.nbytes for c in self.table) > self._bytes):
            at.clear()
            self.table = None
        new = [v for v in values if v not in at]
        if new:
            learned = self._learn(new)
            begin = 0 if self.table is None else len(self.table[0])
            self.table = learned if self.table is None else [pa.concat_arrays([a, b]) for a, b in zip(self.table, learned)]
            at.update(zip(new, range(begin, begin + len(new))))
        return np.fromiter(map(at.__getitem__, values), np.int64, len(values))


class ColumnMemory(Memory):
    """The same with the pieces in an Arrow column: a few bytes each beside the
    text, where a dict takes some hundred.  A lookup reads the whole column, so
    it is for many pieces at once."""

    def __init__(self, learn, pieces: int, table_bytes: int):
        super().__init__(learn, pieces, table_bytes)
        self._known: pa.Array | None = None

    def places(self, values: pa.Array) -> np.ndarray:
        """The places of distinct pieces in ``table``."""
        if self.table is not None and (len(self._known) > self._pieces or sum(c.nbytes for c in self.table) > self._bytes):
            self._known = self.table = None
        known = values.slice(0, 0) if self._known is None else self._known
        at = pc.fill_null(pc.index_in(values, value_set=known), -1).to_numpy().astype(np.int64)
        fresh = at < 0
        if fresh.any():
            new = values.filter(pa.array(fresh))
            learned = self._learn(new)
            self.table = learned if self.table is None else [pa.concat_arrays([a, b]) for a, b in zip(self.table, learned)]
            self._known = pa.concat_arrays([known, new])
            at[fresh] = np.arange(len(known), len(known) + len(new))
        return at
