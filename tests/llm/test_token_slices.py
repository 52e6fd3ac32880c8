"""How much text op3 encodes at a time."""

import pyarrow as pa

from kindred.llm import pieces as P, token_codes as T
from kindred.llm.registry import tokenizer_path


def test_texts_of_a_batch_are_looked_up_together():
    assert P.byte_slices(pa.array(["a" * (1 << 20)] * 10), T.SLICE_BYTES) == [(0, 10)]


def test_a_call_of_the_library_takes_some_pieces(monkeypatch):
    sizes, encode = [], P.ByteEncoder.encode
    monkeypatch.setattr(P.ByteEncoder, "encode", lambda self, pieces: (sizes.append(len(pieces)), encode(self, pieces))[1])
    encoder = T.Encoder(tokenizer_path())
    text = " ".join(f"w{i}" for i in range(40_000))
    ids = encoder.encode_batch([text, "", "w7 w7"])
    assert sum(sizes) >= 40_000 and max(sizes) <= 1 << 14
    assert ids[0].tolist() == encoder._library.tokenizer.encode(text, add_special_tokens=False).ids
    assert ids[1].size == 0 and ids[2].tolist() == encoder._library.tokenizer.encode("w7 w7", add_special_tokens=False).ids
