import bisect
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kindred.llm import token_alignment as T
from kindred.llm.registry import tokenizer_path

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


class Plain:
    """Both libraries over the whole text, then byte by byte."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.of = {i: t for t, i in self.a.get_vocab().items()}
        self.bytes = T.byte_level_table()

    def __call__(self, text):
        """``n_a, n_b, n_groups, n_links, n_overlaps, digest, links``"""
        if not text:
            return 0, 0, 0, 0, 0, "", Counter()
        whole = (" " + text).encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a_bytes = [bytes(self.bytes.get(c, 0) for c in self.of[i]) for i in a]
        b_bytes = [bytes([int(m[1], 16)]) if (m := re.fullmatch("<0x(..)>", n)) else n.replace("▁", " ").encode()
                   for n in map(self.b.id_to_piece, b)]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return 0, 0, 0, 0, 0, "", Counter()
        ends = [np.cumsum([len(t) for t in x]).tolist() for x in (a_bytes, b_bytes)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for side, (ids, at) in enumerate(zip((a, b), ends)):
            for i, e in zip(ids, at):
                groups[bisect.bisect_left(cuts, e)][side].append(i)
        links = Counter((i, j) for ga, gb in groups for i in ga for j in gb)
        owner_a, owner_b = (np.repeat(np.arange(len(x)), [len(t) for t in x]) for x in (a_bytes, b_bytes))
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        return (len(a), len(b), len(cuts), sum(links.values()), len(set(zip(owner_a, owner_b))),
                hashlib.sha256(text.encode()).hexdigest(), links)


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def aligner():
    return T.Aligner(A, B, memory=300)


def check_block(aligner, plain, texts):
    got = aligner.block(pa.array(texts, pa.string()))
    want = [plain(t) for t in texts]
    docs = Counter()
    for k, w in enumerate(want):
        assert (*(int(got[c][k]) for c in T.COUNTS), got["groups_sha256"][k]) == w[:6], texts[k]
        s, e = got["ptr"][k], got["ptr"][k + 1]
        found = {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for p, n in zip(got["pairs"][got["at"][s:e]], got["times"][s:e])}
        assert found == w[6], texts[k]
        docs.update(w[6].keys())
    assert {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for p, n in zip(got["pairs"], got["pair_docs"])} == docs


TEXT = st.lists(st.sampled_from([*"ab  'sT9.,\n\t\x00\x1c\x1f\x85", "é", "́", " ", "　", "\U0001f600", "字", "▁",
                                 "�", "  ", "   ", "'ll", "<|endoftext|>", "<s>", "<0x41>", "the", "ing"]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT | st.none(), min_size=1, max_size=6))
def test_blocks(aligner, plain, texts):
    check_block(aligner, plain, texts)


def test_any_code_points(aligner, plain):
    rnd = random.Random(8)
    for _ in range(40):
        check_block(aligner, plain, ["".join(chr(rnd.choice([rnd.randrange(0x250), rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000), 32]))
                                             for _ in range(rnd.randrange(30))) for _ in range(20)])


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 6), st.integers(1, 6), st.integers(1, 6), st.data())
def test_products(n, m, k, data):
    x = np.array(data.draw(st.lists(st.lists(st.integers(0, 2), min_size=m, max_size=m), min_size=n, max_size=n)))
    y = np.array(data.draw(st.lists(st.lists(st.integers(0, 2), min_size=k, max_size=k), min_size=m, max_size=m)))

    def rows(dense):
        row, col = np.nonzero(dense)
        again = dense[row, col]
        return T.Rows.of(np.repeat(row, again), np.repeat(col, again), *dense.shape)

    got = rows(x).times(rows(y))
    dense = np.zeros((n, k), int)
    dense[got.row_of(), got.col] = got.val
    assert (dense == x @ y).all() and (got.val > 0).all()


def test_overlap_links_share_a_group(aligner):
    sizes = np.array([3, 1, 2]), np.array([1, 2, 3])
    links = T.byte_incidence(sizes[0]).times(T.byte_incidence_transposed(sizes[1]))
    assert list(zip(links.row_of().tolist(), links.col.tolist(), links.val.tolist())) == [(0, 0, 1), (0, 1, 2), (1, 2, 1), (2, 2, 2)]


def check(rows, got, plain):
    each = [(d, plain(t)) for d, t in rows]
    counts = Counter()
    for _, w in each:
        counts.update(w[6].keys())
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    want = Counter((d, *w[:5], sum(n for p, n in w[6].items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in w[6].items()), w[5])
                   for d, w in each)
    assert Counter((r["doc_id"], *(r[c] for c in T.COUNTS), r["n_best"], r["count_sum"], r["groups_sha256"]) for r in got) == want


@pytest.mark.parametrize("block_bytes", [T.BLOCK_BYTES, 300])
def test_awkward_rows(odd, odd_rows, plain, block_bytes):
    check([r[:2] for r in odd_rows], T.align(odd, A, B, block_bytes=block_bytes).collect(), plain)


def test_documents(documents, plain):
    check([tuple(r) for r in documents.select("doc_id", "text").collect()], T.align(documents, A, B, block_bytes=100_000).collect(), plain)


def test_pair_counts(spark, plain):
    texts = ["the cat", "the cat the", "a dog", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = Counter(p for t in texts for p in plain(t)[6])
    got = T.pair_counts(T.blocks(frame, A, B)).collect()
    assert {(r["a"], r["b"]): r["n_docs"] for r in got} == want
    assert all(r["best"] == (r["n_docs"] == max(n for (a, _), n in want.items() if a == r["a"])) for r in got)


def test_empty(empty):
    assert T.align(empty, A, B).count() == 0
