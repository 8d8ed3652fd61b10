"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

Terms are hashed byte triplets, words that repeat the word before them, and a few kinds of bytes. A bounded sample of
labelled documents gives term weights and, by a singular value decomposition, latent directions. The sample's latent
vectors are broadcast; every document is multiplied with all of them in blocks, and its nearest neighbours vote.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import chunks, random_words, text_buffers, tidy
from precinct.llm.minhash import word_hashes

# Bounds of what is learned: labelled documents, and the sizes of their vectors before and after.
SAMPLE_ROWS, TRIPLET_TERMS, LATENT = 4096, 1000, 64
NEIGHBOURS, SHARPNESS = 25, 8.0
THRESHOLD = 0.7

_MIX = random_words(1 << 16, 71)
_TERM = (_MIX % np.uint64(TRIPLET_TERMS)).astype(np.int64)
_SPREAD = (_MIX >> np.uint64(40)).astype(np.int64) & 0xFF
# Kinds of bytes that count as terms: upper and lower case letters, digits, blanks, line ends, other marks, wider characters.
_KINDS = np.full(256, 5)
for _kind, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), (32, 9), (10, 13))):
    _KINDS[list(_bytes)] = _kind
_KINDS[128:] = 6
_KIND_TERMS, _REPEAT_TERMS = 7, 3
TERMS = TRIPLET_TERMS + _KIND_TERMS + _REPEAT_TERMS


def term_shares(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, TERMS) damped frequencies of the terms; rows without text are zero."""
    rows, sizes = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(rows, dtype=np.int64), sizes)
    out = np.zeros((rows, TERMS), np.float32)
    n = np.maximum(sizes, 1)[:, None]
    if len(data) > 2:
        pair = (data[:-2].astype(np.int64) << 8) | data[1:-1]
        term = _TERM[(_SPREAD[pair] << 8) | data[2:]]
        inside = row[:-2] == row[2:]
        counts = np.bincount((row[:-2] * TRIPLET_TERMS + term)[inside], minlength=rows * TRIPLET_TERMS)
        out[:, :TRIPLET_TERMS] = np.log1p(counts.reshape(rows, TRIPLET_TERMS) * (1000.0 / n))
    kinds = np.bincount(row * _KIND_TERMS + _KINDS[data], minlength=rows * _KIND_TERMS).reshape(rows, _KIND_TERMS)
    out[:, TRIPLET_TERMS : TRIPLET_TERMS + _KIND_TERMS] = 3 * np.log1p(kinds * (100.0 / n))
    words, bounds = word_hashes(data, offsets)
    count = np.maximum(np.diff(bounds), 1)
    for k in range(_REPEAT_TERMS):  # words that stand one, two or three places before, too
        again = np.zeros(len(words) + 1)
        if len(words) > k + 1:
            again[k + 2 :] = words[k + 1 :] == words[: -k - 1]
        sums = np.cumsum(again)
        begin = np.minimum(bounds[:-1] + k + 1, bounds[1:])
        out[:, TRIPLET_TERMS + _KIND_TERMS + k] = 3 * np.log1p((sums[bounds[1:]] - sums[begin]) * (100.0 / count))
    out[sizes == 0] = 0
    return out


@dataclass
class Model:
    """Term weights, latent directions, and the vectors and labels of the sample."""

    weights: np.ndarray
    centre: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, terms: np.ndarray) -> np.ndarray:
        """Unit vectors of the documents in the latent space; empty documents have a zero vector."""
        empty = ~terms.any(axis=1)
        out = (terms * self.weights - self.centre) @ self.directions
        out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
        out[empty] = 0
        return out

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Similarity-weighted shares of label 1 among the nearest neighbours; without any, the share in the sample."""
        if not len(self.labels):
            return np.full(len(terms), 0.5)
        base = float(self.labels.mean())
        cosines = self.latent(terms) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(cosines, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        return np.where(total > 0, votes / np.maximum(total, 1e-300), base)


def fit(terms: np.ndarray, labels: np.ndarray) -> Model:
    """Weights, directions and vectors of a sample."""
    if not len(labels):
        none = np.zeros((0, LATENT), np.float32)
        return Model(np.ones(TERMS, np.float32), np.zeros(TERMS, np.float32), np.zeros((TERMS, LATENT), np.float32), none, labels)
    weights = (np.log((1 + len(terms)) / (1 + (terms > 0).sum(axis=0))) + 1).astype(np.float32)
    weighted = terms * weights
    centre = weighted.mean(axis=0)
    centred = (weighted - centre).astype(np.float64)
    _, found = np.linalg.eigh(centred.T @ centred)  # the right singular vectors
    model = Model(weights, centre, np.ascontiguousarray(found[:, ::-1][:, :LATENT]).astype(np.float32), terms[:0, :LATENT], labels)
    model.vectors = model.latent(terms).astype(np.float32)
    return model


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled documents of ``docs``: the ``sample_rows`` ids with the smallest hashes.

    Null ids, labels and texts teach nothing; an id with several labels or texts counts once, with the smaller ones.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("label"))
    known = known.join(docs.filter("text is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.filter("text is not null").join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in chunks(offsets):
                terms = term_shares(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                values = pa.array([row.tobytes() for row in terms], pa.binary())
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), values], names=["doc_id", "label", "terms"])

    rows = texts.select(F.col("doc_id").cast("long"), F.col("label").cast("int"), "text").mapInArrow(tidy(run), "doc_id long, label int, terms binary")
    found = rows.orderBy("doc_id").toArrow()  # bounded by ``sample_rows``
    values = [np.frombuffer(v.as_buffer(), np.float32) for v in found.column("terms")]
    terms = np.stack(values) if values else np.zeros((0, TERMS), np.float32)
    return fit(terms, found.column("label").to_numpy().astype(np.float64))


def score(docs: DataFrame, model: Model, *keep: Column | str) -> DataFrame:
    """``keep`` columns of ``docs`` with ``score`` and ``predicted``, in one pass over whole texts without a shuffle.

    Null texts count as empty. An empty text has no neighbours and gets the share of label 1 in the sample.
    """
    rows = docs.select(*keep, F.col("text").alias("__text"))
    names = [*rows.columns[:-1], "score", "predicted"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("__text"))
            for lo, hi in chunks(offsets):
                terms = term_shares(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                found = np.concatenate([shared.value.scores(terms[a : a + 512]) for a in range(0, len(terms), 512)])
                part = batch.slice(lo, hi - lo)
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                columns += [pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kept = "".join(f"`{n}` {t}, " for n, t in rows.dtypes[:-1])
    return rows.mapInArrow(tidy(run), kept + "score double, predicted int")
