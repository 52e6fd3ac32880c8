"""Quality by nearest-neighbour voting in a latent-semantic space.

* Terms of a text: trigrams of its *shape* (letters, capitals, digits, blanks
  and line ends as classes, other signs as themselves), hashed to
  ``SHAPE_TERMS`` terms, and pseudo-terms for its share of distinct words,
  distinct lines, mean word length and words per line.
* Document frequencies are counted over all documents.
* Labelled texts (at most ``MAX_PER_CLASS`` distinct texts of each class, a
  bounded sample by text hash) are weighted by TF-IDF and reduced by a truncated
  SVD to ``DIMENSIONS`` latent dimensions.  Only this sample's matrix reaches
  the driver: ``2 * MAX_PER_CLASS`` rows of ``TERMS`` numbers at most.
* The labelled vectors are broadcast (some 1 MB at most); every document is
  compared with all of them: exact cosines, block by block.  Its ``NEIGHBOURS``
  nearest vote with their similarity, each class weighted by its share of all
  labelled texts over its share of the sample.

Scores depend on the text alone: no id, language, source or label of the
document scored takes part.

Defined results: a null, empty or blank text has score 0; without labelled texts
every score is 0.5; repeated rows score alike; other columns are ignored
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.minhash import text_blocks, word_hashes
from kindred.llm.sampling import labelled_sample, remainder
from kindred.session import ship_package

SHAPE_TERMS = 512
BINS = 16
PSEUDO_TERMS = 4 * BINS
TERMS = SHAPE_TERMS + PSEUDO_TERMS
DIMENSIONS = 40
MAX_PER_CLASS = 2500
NEIGHBOURS = 25
#: Weight of a pseudo-term next to a unit vector of shape terms.
PSEUDO_WEIGHT = 0.5
THRESHOLD = 0.3
HELD_OUT = (5, 0)
BLOCK_ROWS = 256


def _shape_table() -> np.ndarray:
    """A class from 1 to 31 for each byte."""
    table = np.ones(256, np.int64)  # lower-case and non-ASCII letters
    for b in range(128):
        c = chr(b)
        if c.isupper():
            table[b] = 2
        elif c.isdigit():
            table[b] = 3
        elif c in " \t":
            table[b] = 4
        elif c in "\n\r\x0b\x0c":
            table[b] = 5
        elif not c.islower():
            table[b] = 6 + b % 26
    return table


_SHAPE = _shape_table()
_SPREAD = np.random.Generator(np.random.PCG64(7)).permutation(32 ** 3) % SHAPE_TERMS


def _bins(x: np.ndarray, low: float, high: float) -> np.ndarray:
    """Weights of ``BINS`` overlapping bins (neighbouring values stay similar)."""
    at = np.clip((x - low) / (high - low), 0, 1)[:, None] * (BINS - 1)
    return np.maximum(0.0, 1.0 - np.abs(at - np.arange(BINS)) / 2)


def term_counts(texts: pa.Array) -> np.ndarray:
    """A row of ``TERMS`` numbers per text; all 0 for texts without words."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for rows, data, offsets in text_blocks(texts):
        n = len(rows)
        sizes = np.diff(offsets)
        doc = np.repeat(np.arange(n), sizes)
        shape = _SHAPE[data]
        if data.size > 2:
            gram = _SPREAD[(shape[:-2] * 32 + shape[1:-1]) * 32 + shape[2:]]
            inside = doc[2:] == doc[:-2]
            shape_counts = np.bincount(doc[2:][inside] * SHAPE_TERMS + gram[inside],
                                       minlength=n * SHAPE_TERMS).reshape(n, SHAPE_TERMS)
        else:
            shape_counts = np.zeros((n, SHAPE_TERMS))
        words, begins = word_hashes(data)
        first = np.searchsorted(begins, offsets)
        n_words = np.diff(first)
        some = np.maximum(n_words, 1)
        distinct = np.array([np.unique(words[a:b]).size for a, b in zip(first[:-1], first[1:])])
        letters = np.add.reduceat((shape > 5) | (shape < 4), offsets[:-1]).astype(float)
        ends = data == 10
        n_lines = np.add.reduceat(ends, offsets[:-1]) + 1
        repeats = np.zeros(n)
        if words.size > 1:
            equal = np.concatenate(([0], np.cumsum(words[1:] == words[:-1])))
            repeats = (equal[np.maximum(first[1:] - 1, first[:-1]).clip(max=words.size - 1)]
                       - equal[first[:-1].clip(max=words.size - 1)]) / some
        block = np.concatenate((
            shape_counts,
            _bins(np.log(distinct + 1) / np.log(some + 1), 0.3, 1),
            _bins(repeats, 0, 1), _bins(letters / some, 1, 16), _bins(np.log1p(some / n_lines), 0, 6)), axis=1)
        block[n_words == 0] = 0
        out[rows] = block
    return out


def _document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Texts that have each term, and texts with any, over all documents."""
    def run(batches):
        total, n = np.zeros(TERMS), 0
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                counts = term_counts(batch.column(0).slice(i, BLOCK_ROWS))
                total += (counts > 0).sum(axis=0)
                n += int((counts.sum(axis=1) > 0).sum())
        yield pa.RecordBatch.from_arrays([pa.array([*range(TERMS), -1]), pa.array([*total.astype(int).tolist(), n])],
                                         names=["term", "n"])

    found = docs.select(text_col).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df, n = np.zeros(TERMS), 0
    for r in found.collect():  # TERMS + 1 rows
        if r["term"] < 0:
            n = r["n"]
        else:
            df[r["term"]] = r["n"]
    return df, n


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows: unit shape part, then the pseudo-terms."""
    x = np.log1p(counts[:, :SHAPE_TERMS]) * idf[:SHAPE_TERMS]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return np.concatenate((x, counts[:, SHAPE_TERMS:] * PSEUDO_WEIGHT * np.minimum(idf[SHAPE_TERMS:], 3)),
                          axis=1).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", held_out: tuple[int, int] = HELD_OUT, max_per_class: int = MAX_PER_CLASS) -> dict | None:
    """The model: term weights, latent axes, labelled vectors; None without labels."""
    ship_package(docs.sparkSession)
    out = remainder(F.col(id_col), held_out[0]) == held_out[1]
    sample = labelled_sample(docs, labels, label_col, out, {0: max_per_class, 1: max_per_class}, id_col, text_col)
    df, n = _document_frequencies(docs, text_col)
    idf = np.log((1 + n) / (1 + df)) + 0.1

    def run(batches):
        for batch in batches:
            x = _weighted(term_counts(batch.column(0)), idf)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column(1),
                                              batch.column(2)], names=["x", "label", "of_class"])

    rows = sample.mapInArrow(run, "x binary, label int, of_class long").collect()  # the bounded sample
    if not rows:
        return None
    rows.sort(key=lambda r: bytes(r["x"]))
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows])
    label = np.array([r["label"] for r in rows], np.float32)
    of_class = np.array([r["of_class"] for r in rows], float)
    weight = of_class / np.where(label == 1, (label == 1).sum(), (label == 0).sum())
    values, axes = np.linalg.eigh(x.T.astype(float) @ x)
    axes = axes[:, np.argsort(values)[::-1][:DIMENSIONS]].astype(np.float32)
    latent = x @ axes
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    return {"idf": idf, "axes": axes, "vectors": latent.T.copy(), "label": label, "weight": weight.astype(np.float32)}


def vote(model: dict, counts: np.ndarray) -> np.ndarray:
    """Scores of a block of rows of term counts."""
    x = _weighted(counts, model["idf"]) @ model["axes"]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    cosine = x @ model["vectors"]
    k = min(NEIGHBOURS, cosine.shape[1])
    near = np.argpartition(cosine, -k, axis=1)[:, -k:]
    similar = np.take_along_axis(cosine, near, axis=1)
    # Relative to the farthest neighbour, so that near ones count for more.
    pull = np.exp(20 * (similar - similar.max(axis=1, keepdims=True))) * model["weight"][near]
    return (pull * model["label"][near]).sum(axis=1) / np.maximum(pull.sum(axis=1), 1e-12)


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                  text_col: str = "text", held_out: tuple[int, int] = HELD_OUT,
                  max_per_class: int = MAX_PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``."""
    model = fit(docs, labels, label_col, id_col, text_col, held_out, max_per_class)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        for batch in batches:
            scores = []
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.column(1).slice(i, BLOCK_ROWS)
                counts = term_counts(part)
                s = np.full(len(part), 0.5) if m is None else np.clip(vote(m, counts).astype(float), 0, 1)
                s[counts.sum(axis=1) == 0] = 0.0 if m is not None else 0.5
                scores += s.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = slim.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id"), held_out[0]) == held_out[1], F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
