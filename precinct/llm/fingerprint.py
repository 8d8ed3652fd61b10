"""Document fingerprints: quartile digests of hashed byte triplets, and a bounded difference between them.

Six triplets of each window of five bytes are hashed to 128 buckets and counted. A bucket becomes two bits: the
quartile of its count among all counts. Before them stand the length class and two quartile ratios:

    "Q1" length(2 hex digits) ratio(2 hex digits) 64 hex digits with two buckets in each digit
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import chunks, ordered_buckets, random_words, shuffle_partitions, text_buffers, tidy

BUCKETS = 128
# Offsets of the second and third byte of the triplets that contain the newest byte of a window.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4), (1, 4), (3, 4))
# Differences that weigh more than a bucket's quartile does.
LENGTH_WEIGHT, RATIO_WEIGHT = 4, 4
MOST_LENGTH, MOST_RATIO = 16, 15
MOST = 3 * BUCKETS + LENGTH_WEIGHT * MOST_LENGTH + 2 * RATIO_WEIGHT * MOST_RATIO

_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)
_MIX = [random_words(1 << 16, 11 + k) >> np.uint64(56) for k in range(len(TRIPLETS))]
_PAIR = [m.astype(np.uint16) << 8 for m in _MIX]
_LAST = [(random_words(1 << 16, 31 + k) % np.uint64(BUCKETS)).astype(np.uint8) for k in range(len(TRIPLETS))]


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, 128) counts of the hashed triplets of all rows; texts of fewer than three bytes have none.

    The first bytes of a text, where the window is not full yet, give the triplets that are complete.
    """
    rows = len(offsets) - 1
    counts = np.zeros(rows * BUCKETS, np.int64)
    row = np.repeat(np.arange(rows, dtype=np.int64) * BUCKETS, np.diff(offsets))
    wide = data.astype(np.uint16)
    for k, (second, third) in enumerate(TRIPLETS):
        n = len(data) - third
        if n <= 0:
            continue
        pair = _PAIR[k][(wide[third:] << 8) | wide[third - second : third - second + n]]
        place = _LAST[k][pair | wide[:n]] + row[third:]
        inside = row[third:] == row[:n]
        if not inside.all():
            place = place[inside]
        counts += np.bincount(place, minlength=len(counts))
    return counts.reshape(rows, BUCKETS)


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, 131) small integers: length class, two ratios, and the quartile of each bucket."""
    counts = bucket_counts(data, offsets)
    ranked = np.sort(counts, axis=1)
    q1, q2, q3 = (ranked[:, BUCKETS * q // 4 - 1 : BUCKETS * q // 4] for q in (1, 2, 3))
    out = np.zeros((len(counts), 3 + BUCKETS), np.uint8)
    out[:, 0] = np.minimum(np.round(np.log2(np.diff(offsets) + 1.0) * 8), 255)
    top = np.maximum(q3, 1)
    out[:, 1:2] = q1 * 15 // top
    out[:, 2:3] = q2 * 15 // top
    out[:, 3:] = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    return out


def texts_of(digest: np.ndarray) -> np.ndarray:
    """The digests as strings."""
    nibbles = (digest[:, 3::2] << 2) | digest[:, 4::2]
    head = np.stack([digest[:, 0] >> 4, digest[:, 0] & 15, digest[:, 1], digest[:, 2]], axis=1)
    body = _HEX[np.concatenate([head, nibbles], axis=1)]
    raw = body.tobytes().decode()
    width = body.shape[1]
    return np.array(["Q1" + raw[i : i + width] for i in range(0, len(raw), width)], object)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, down to 0 for digests that differ as much as any can."""
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16))
    score = apart[:, 3:].sum(axis=1)
    score += LENGTH_WEIGHT * np.minimum(apart[:, 0], MOST_LENGTH) + RATIO_WEIGHT * (apart[:, 1] + apart[:, 2])
    return 1.0 - score / MOST


def parse(text: str) -> np.ndarray:
    """The digest of its string, as one row."""
    digits = np.array([int(c, 16) for c in text[2:]], np.uint8)
    body = np.stack([digits[4:] >> 2, digits[4:] & 3], axis=1).reshape(-1)
    return np.concatenate([[digits[0] << 4 | digits[1]], digits[2:4], body]).astype(np.uint8)[None]


def fingerprints(df: DataFrame, columns: list[str], near: list[tuple[str, str]] = ()) -> DataFrame:
    """``df`` with the string column ``<c>_fingerprint`` in place of each text column in ``columns``, and
    ``near_<a>_<b>``, the likeness of the digests of two of them, for each pair in ``near``.

    Null counts as empty. One pass without a shuffle.
    """
    rest = [f for f in df.schema.fields if f.name not in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}
            for name in columns:
                data, offsets = text_buffers(batch.column(name))
                parts = [digests(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets)]
                found[name] = np.concatenate(parts) if parts else np.zeros((0, 3 + BUCKETS), np.uint8)
            arrays = [batch.column(f.name) for f in rest]
            arrays += [pa.array(texts_of(found[name]), pa.string()) for name in columns]
            arrays += [pa.array(likeness(found[a], found[b]), pa.float64()) for a, b in near]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = [f.name for f in rest] + [f"{c}_fingerprint" for c in columns] + [f"near_{a}_{b}" for a, b in near]
    types = [f.dataType.simpleString() for f in rest] + ["string"] * len(columns) + ["double"] * len(near)
    return df.mapInArrow(tidy(run), ", ".join(f"`{n}` {t}" for n, t in zip(names, types)))


def with_next_text(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(doc_id, text, next_text): each document with the text after it in doc_id order, the last one with the first.

    Null texts are empty, null doc_ids come last, and equal doc_ids are ordered by their texts. The texts are
    shuffled once, by ranges of doc_id. The first document of each range is sent to the range before it too: one
    for each of the ``buckets`` ranges, found by their smallest doc_ids.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows, n = ordered_buckets(rows, "doc_id", buckets or 4 * shuffle_partitions(spark))
    firsts = rows.groupBy("bucket").agg(F.min("doc_id").alias("first")).orderBy("bucket").collect()
    places = [r["bucket"] for r in firsts]
    moves = [(r["first"], to, here) for r, to, here in zip(firsts, [places[-1], *places[:-1]], places)] if firsts else []
    sent = F.broadcast(spark.createDataFrame(moves, "first long, to int, bucket int"))
    same = F.col("doc_id").eqNullSafe(F.col("first"))
    guests = rows.join(sent, "bucket").filter(same).groupBy("to").agg(F.min(F.struct("doc_id", "text")).alias("d"))
    guests = guests.select(F.col("d.doc_id").alias("doc_id"), F.col("d.text").alias("text"), F.col("to").alias("bucket"), F.lit(1).alias("guest"))
    every = rows.select("doc_id", "text", "bucket", F.lit(0).alias("guest")).unionByName(guests)
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_last(), "text")
    return every.withColumn("next_text", F.lead("text").over(order)).filter("guest = 0").select("doc_id", "text", "next_text")


def edited_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The edited text has the last half of the code points (rounded down) replaced by the first as many, or all,
    of the next document. A single document follows itself. Repeated rows stay repeated; other columns are not read.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", 1, (F.length("text") - half)), F.substring("next_text", 1, half)
    )
    rows = with_next_text(docs).withColumn("edited", edited)
    rows = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "text", "edited", F.col("next_text").alias("next"),
    )
    out = fingerprints(rows, ["text", "edited", "next"], [("text", "edited"), ("text", "next")])
    return out.select(
        "doc_id", "n_chars", "edited_sha256", F.col("text_fingerprint").alias("fingerprint"),
        F.col("edited_fingerprint"), F.col("near_text_edited").alias("near_edited"), F.col("near_text_next").alias("near_next"),
    )
