"""Token-id files: ids of documents, bit-packed at a fixed width, in ascending order of doc_id.

A file is a row of segments, each followed by one line feed (Spark's text writer puts it there). A segment is

    4s  b"IDS1"
    u16 bits of an id        u16 zero
    u32 ids in a block       u32 documents
    i64 ids                  i64 ids of the same folder before this segment
    i64 doc_id of each document (the smallest integer stands for null)
    i64 ids of each document, the end id included
    u64 byte offset of each block, counted from the first block
    the blocks: id k of a block has the bits [k * bits, (k + 1) * bits), least significant first

all little-endian. Each range of doc_ids is a folder ``bucket=<n>`` of its own; folders ascend in doc_id, and so do
the segments and documents in a folder. A block holds a multiple of eight ids (the last one is filled up with
zeros), so it begins at a full byte, can be read without the others and is unpacked with a few numpy operations.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm.common import chunks, held_state, ordered_buckets, ragged, shuffle_partitions, text_buffers, tidy
from precinct.llm.pretokens import PieceTable
from precinct.session import materialize, scratch_path

MAGIC = b"IDS1"
_HEADER = struct.Struct("<4sHHIIqq")
NO_ID = -(1 << 63)
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 20
BATCH_BYTES = 1 << 19
END_ID = 0
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# --- Packing ---


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """The ids at ``bits`` bits each; eight of them fill ``bits`` bytes."""
    groups = -(-len(ids) // 8)
    padded = np.zeros(groups * 8, np.uint64)
    padded[: len(ids)] = ids
    padded = padded.reshape(groups, 8)
    out = np.zeros((groups, bits), np.uint8)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        value = padded[:, k] << np.uint64(shift)
        for j in range(-(-(shift + bits) // 8)):
            out[:, byte + j] |= (value >> np.uint64(8 * j)).astype(np.uint8)
    return out.reshape(-1)


def unpack(data: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed ``data``."""
    groups = -(-n // 8)
    packed = data[: groups * bits].reshape(groups, bits)
    out = np.zeros((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        value = np.zeros(groups, np.uint64)
        for j in range(-(-(shift + bits) // 8)):
            value |= packed[:, byte + j].astype(np.uint64) << np.uint64(8 * j)
        out[:, k] = ((value >> np.uint64(shift)) & mask).astype(np.uint32)
    return out.reshape(-1)[:n]


def segment(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, before: int, bits: int) -> bytes:
    blocks = -(-len(ids) // BLOCK_IDS)
    header = _HEADER.pack(MAGIC, bits, 0, BLOCK_IDS, len(doc_ids), len(ids), before)
    offsets = np.arange(blocks, dtype="<u8") * (BLOCK_IDS * bits // 8)
    return b"".join(
        [header, doc_ids.astype("<i8").tobytes(), counts.astype("<i8").tobytes(), offsets.tobytes(), pack(ids, bits).tobytes()]
    )


class Segment:
    """A segment of a file's bytes that begins at ``at``."""

    def __init__(self, content: bytes | memoryview, at: int = 0):
        magic, self.bits, _, self.block_ids, docs, self.n_ids, self.before = _HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        at += _HEADER.size
        self.doc_ids = np.frombuffer(content, "<i8", docs, at)
        self.counts = np.frombuffer(content, "<i8", docs, at + 8 * docs)
        at += 16 * docs
        self.offsets = np.frombuffer(content, "<u8", -(-self.n_ids // self.block_ids), at)
        at += 8 * len(self.offsets)
        size = -(-self.n_ids // 8) * self.bits
        self.packed = np.frombuffer(content, np.uint8, size, at)
        self.end = at + size + 1  # behind the line feed

    def block(self, k: int) -> np.ndarray:
        """The ids of one block, without touching the others."""
        n = min(self.block_ids, self.n_ids - k * self.block_ids)
        return unpack(self.packed[int(self.offsets[k]) :], self.bits, n)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids [start, stop) of the segment; only the blocks that hold them are unpacked."""
        stop = self.n_ids if stop is None else stop
        if stop <= start:
            return np.zeros(0, np.uint32)
        first = start // self.block_ids
        skip = first * self.block_ids
        return unpack(self.packed[int(self.offsets[first]) :], self.bits, stop - skip)[start - skip :]


def segments(content: bytes) -> Iterator[Segment]:
    at = 0
    while at < len(content):
        found = Segment(content, at)
        yield found
        at = found.end


# --- Encoding and files ---


def _tokenizer(path: str) -> tuple[PieceTable, int]:
    return _state(path)[:2]


def _added_tokens(path: str) -> tuple[re.Pattern | None, dict[bytes, int], object]:
    """A pattern of the file's added tokens, longest first, their ids, and the library where it alone can place them."""
    return _state(path)[2]


def _state(path: str) -> tuple[PieceTable, int, tuple]:
    return held_state(("token files", path), lambda: (*_load_tokenizer(path), _load_added(path)))


def _load_tokenizer(path: str) -> tuple[PieceTable, int]:
    tokenizer = _library(path)
    tokenizer.encode_special_tokens = True

    def encode(pieces: list[bytes]) -> list[list[int]]:
        found = tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [e.ids for e in found]

    return PieceTable(encode), (tokenizer.get_vocab_size() - 1).bit_length()


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _load_added(path: str) -> tuple[re.Pattern | None, dict[bytes, int], object]:
    tokenizer = _library(path)
    added = tokenizer.get_added_tokens_decoder()
    ids = {t.content.encode(): i for i, t in added.items()}
    if not ids:
        return None, ids, None
    pattern = re.compile(b"|".join(re.escape(t) for t in sorted(ids, key=len, reverse=True)))
    plain = not any(t.single_word or t.lstrip or t.rstrip for t in added.values())
    return pattern, ids, None if plain else tokenizer


def _encode_rows(path: str, data: np.ndarray, offsets: np.ndarray, added: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows and their bounds; with ``added``, the file's added tokens in a text are cut out and have their own id."""
    table, _ = _tokenizer(path)
    pattern, own, library = _added_tokens(path) if added else (None, {}, None)
    raw = data.tobytes() if pattern else b""
    if pattern is None or not pattern.search(raw):
        return table.encode(data, offsets)
    cuts, row_of, fixed = [0], [], {}
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for match in pattern.finditer(raw, a, b):
            if library is not None:  # the whole text is one piece
                fixed[len(row_of)] = library.encode(raw[a:b].decode(), add_special_tokens=False).ids
                break
            cuts += [match.start(), match.end()]
            fixed[len(row_of) + 1] = [own[match.group()]]
            row_of += [row, row]
        cuts.append(b)
        row_of.append(row)
    # Rows with an id of their own are left out of what is encoded.
    cuts = np.array(cuts, np.int64)
    sizes = np.diff(cuts)
    given = np.zeros(len(sizes), bool)
    given[list(fixed)] = True
    rest = data[ragged(cuts[:-1][~given], sizes[~given])]
    ids, bounds = table.encode(rest, np.concatenate([[0], np.cumsum(sizes[~given])]))
    counts = np.zeros(len(sizes), np.int64)
    counts[~given] = np.diff(bounds)
    counts[given] = [len(fixed[k]) for k in np.flatnonzero(given).tolist()]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]), np.uint32)
    is_given = np.repeat(given, counts)
    out[~is_given] = ids
    out[is_given] = [i for k in np.flatnonzero(given).tolist() for i in fixed[k]]
    per_row = np.bincount(row_of, weights=counts, minlength=len(offsets) - 1).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(per_row)])


def encode(path: str, data: np.ndarray, offsets: np.ndarray, end_id: int | None, added: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows, each closed by ``end_id``, and their numbers.

    The tokenizer's own splitter cuts a text into the same pieces, and each piece is encoded for itself; so
    the library encodes every distinct piece once instead of every text. With ``added`` the added tokens of the
    file are found in the texts, as the library does by default; without, they are text like any other.
    """
    ids, bounds = _encode_rows(path, data, offsets, added)
    counts = np.diff(bounds)
    if end_id is None:
        return ids, counts
    return np.insert(ids, bounds[1:], end_id), counts + 1


def write_token_files(
    docs: DataFrame, folder: str, path: str = VOCABULARY, end_id: int | None = END_ID, buckets: int | None = None,
    added: bool = False,
) -> None:
    """Encode ``docs`` (doc_id, text) and write the files; one shuffle by ranges of doc_id.

    A null text counts as empty: only the end id is written. Null doc_ids come last; repeated doc_ids follow one
    another, ordered by a hash of the text. Other columns are not read. ``buckets`` is the number of ranges.
    ``added`` is that of ``encode``.
    """
    buckets = buckets or 4 * shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows, _ = ordered_buckets(rows, "doc_id", buckets)
    rows = rows.repartition("bucket").sortWithinPartitions(
        "bucket", F.col("doc_id").asc_nulls_last(), F.xxhash64("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _tokenizer(path)[1]
        doc_ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        now, number, before, held = None, 0, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, before, held
            if doc_ids:
                content = segment(np.concatenate(doc_ids), np.concatenate(counts), np.concatenate(ids), before, bits)
                columns = [pa.array([now], pa.int32()), pa.array([number], pa.int32()), pa.array([content], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "number", "content"])
                number, before, held = number + 1, before + held, 0
                doc_ids.clear(), counts.clear(), ids.clear()

        for batch in batches:
            keys = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            places = batch.column("bucket").to_numpy()
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in chunks(offsets, BATCH_BYTES):
                got, sizes = encode(path, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], end_id, added)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                cuts = [0, *(np.flatnonzero(np.diff(places[lo:hi])) + 1).tolist(), hi - lo]
                for a, b in zip(cuts, cuts[1:]):
                    if places[lo + a] != now:
                        yield from flush()
                        now, number, before = int(places[lo + a]), 0, 0
                    doc_ids.append(keys[lo + a : lo + b])
                    counts.append(sizes[a:b])
                    ids.append(got[ends[a] : ends[b]])
                    held += int(ends[b] - ends[a])
                    if held >= SEGMENT_IDS:
                        yield from flush()
        yield from flush()

    packed = rows.mapInArrow(tidy(run), "bucket int, number int, content binary")
    # The text writer puts out the bytes of a string as they are.
    packed.sortWithinPartitions("bucket", "number").select("bucket", F.col("content").cast("string")).write.partitionBy(
        "bucket"
    ).text(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(bucket, doc_id, start, n_tokens, ids_crc32) of every document in the files; ``start`` counts in its folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, content in zip(batch.column("bucket").to_pylist(), batch.column("content")):
                for found in segments(content.as_buffer()):
                    raw = memoryview(found.ids().astype("<u4").tobytes())
                    ends = np.cumsum(found.counts)
                    sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - found.counts).tolist(), ends.tolist())]
                    columns = [
                        pa.array(np.full(len(ends), bucket, np.int32)),
                        pa.array(found.doc_ids, mask=found.doc_ids == NO_ID),
                        pa.array(ends - found.counts + found.before),
                        pa.array(found.counts),
                        pa.array(sums, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["bucket", "doc_id", "start", "n_tokens", "ids_crc32"])

    # One file to a batch, as a file may have some hundred MB.
    files = spark.read.format("binaryFile").load(folder).select("bucket", "content")
    return files.mapInArrow(tidy(run), "bucket int, doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, path: str = VOCABULARY, end_id: int | None = END_ID, added: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of ``docs`` after a round trip through token files in the shared folder.

    ``start`` is the number of ids of all documents before. Only one number for each range of doc_ids is
    summed up across ranges. ``added`` is that of ``encode``.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write_token_files(docs, folder, path, end_id, added=added)
    if not docs.limit(1).count():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    found = materialize(read_token_files(spark, folder), "token-table")
    totals = found.groupBy("bucket").agg(F.sum("n_tokens").alias("n")).orderBy("bucket").collect()
    before, starts = 0, []
    for row in totals:  # one row for each range, a number that ``buckets`` sets
        starts.append((row["bucket"], before))
        before += row["n"]
    offsets = F.broadcast(spark.createDataFrame(starts, "bucket int, before long"))
    return found.join(offsets, "bucket").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
