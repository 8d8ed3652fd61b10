"""Exact removal of repeated byte strings with suffix arrays over the places where documents share text.

Every window of 100 bytes owns the place of its smallest 32-gram (by a hash; the leftmost of equal ones), so equal windows
own the same 32-gram at the same distance. The windows of one such place lie side by side; the bytes below them are
its context. Windows can only repeat between contexts with the same 32-gram:

1. Each task finds the contexts of its documents. Of equal contexts the later ones are covered by the first.
2. Contexts meet by the hash of their 32-gram. One that is alone is clean, equal ones are settled as in step 1, and of
   each different one the first is passed on. Where a task sees a 32-gram with many different contexts it is shared for
   certain: then these meet by the hash of 32-gram and context, so that no task gets all of a common one, and a sign
   goes where the 32-gram is looked at; of a 32-gram with a sign every first context is passed on, even a lone one.
3. Those get their bytes. In each group, the part of a context that no other one of the group shares around the
   32-gram is cut off; equal rests are settled as before.
4. The different rests, many groups at once, are one text for a suffix array built by linear grouping. Neighbours with 100
   bytes in common are repeats, and all but the earliest start are covered.
5. Covered windows come back to their documents, where their bytes are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import BYTE_WORDS, CHUNK_BYTES, RollingHash, binary_slices, chunks, shuffle_partitions, sorted_groups, text_buffers, tidy
from precinct.llm.suffix_array import suffix_array
from precinct.session import materialize

LENGTH, GRAM = 100, 32
# Bytes of text for one suffix array, and different contexts of a 32-gram that one task compares at once.
ARRAY_BYTES, GROUP_ROWS = 1 << 16, 20_000
# Different contexts of a 32-gram in one piece of text, from which on they are spread over the buckets.
CROWD = 8
NO_ID = -(1 << 63)

# In place of a distance: a row that only says that its 32-gram is shared.
SIGN = 255

_CONTEXT = np.dtype([("gram", "<u8"), ("context", "<u8"), ("doc_id", "<i8"), ("key", "<u4"), ("lo", "<i4"), ("reach", "u1"), ("at", "u1")])


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the index of its smallest one, the leftmost of equal ones."""
    at = np.arange(len(values), dtype=np.int32)
    best, step = values, 1
    while step < width:
        jump = min(step, width - step)
        a, b = best[:-jump], best[jump:]
        right = b < a
        best = np.where(right, b, a)
        at = np.where(right, at[jump:], at[:-jump])
        step += jump
    return at


def contexts(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, gram hash, context hash, first window, windows - 1, distance of the 32-gram) of all contexts of all rows."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    rolling = RollingHash(data, BYTE_WORDS)
    starts = np.arange(n - gram + 1)
    grams = rolling.of(starts, starts + gram)
    own = leftmost_minimum(grams, length - gram + 1)
    window = np.flatnonzero(row[: n - length + 1] == row[length - 1 :])
    if not len(window):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    place = own[window].astype(np.int64)
    change = np.flatnonzero((place[1:] != place[:-1]) | (row[window[1:]] != row[window[:-1]])) + 1
    lo = window[np.concatenate([[0], change])]
    hi = window[np.concatenate([change - 1, [len(window) - 1]])]
    place = place[np.concatenate([[0], change])]
    at = place - lo
    context = rolling.of(lo, hi + length) ^ (at.astype(np.uint64) << np.uint64(56)) * np.uint64(3)
    return row[lo], grams[place], context, lo - offsets[row[lo]], hi - lo, at


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, bytes before it in its text, bytes, row offsets): rows together, or a long text in overlapping blocks.

    Every window lies in exactly one block, so what is worked on at once does not grow with a text.
    """
    for lo, hi in chunks(offsets):
        a, b = int(offsets[lo]), int(offsets[hi])
        if hi - lo > 1 or b - a <= CHUNK_BYTES + length:
            yield lo, 0, data[a:b], offsets[lo : hi + 1] - a
            continue
        for at in range(a, b - length + 1, CHUNK_BYTES):
            part = data[at : min(b, at + CHUNK_BYTES + length - 1)]
            yield lo, at - a, part, np.array([0, len(part)])


# --- Step 4 ---


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def _shared_lengths(parts: list[bytes]) -> list[int]:
    """For each string the longest prefix that it shares with another one: with a neighbour in sorted order."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for x, y in zip(order, order[1:]):
        n = _common(parts[x], parts[y])
        out[x], out[y] = max(out[x], n), max(out[y], n)
    return out


class RepeatFinder:
    """Collects groups of contexts and gives the covered windows of each as (entry, first window, last window).

    An entry is whatever the caller names a context by; entries come in the order of their places in the corpus.
    """

    def __init__(self, length: int):
        self.length = length
        self.texts: list[bytes] = []
        self.owners: list[tuple[object, int]] = []
        self.ranks: list[tuple] = []
        self.held = 0

    def add(self, entries: list[object], ranks: list[tuple], texts: list[bytes], at: list[int]) -> Iterator[tuple]:
        """A group: names, places (doc_id, key, start), bytes, and the distance of the 32-gram in them."""
        right = _shared_lengths([t[a:] for t, a in zip(texts, at)])
        left = _shared_lengths([t[:a][::-1] for t, a in zip(texts, at)])
        seen: dict[tuple[bytes, int], int] = {}
        for k in sorted(range(len(texts)), key=ranks.__getitem__):
            if left[k] + right[k] < self.length:
                continue
            begin = at[k] - left[k]
            rest = texts[k][begin : at[k] + right[k]]
            first = seen.setdefault((rest, left[k]), k)
            if first != k:
                yield entries[k], begin, begin + len(rest) - self.length
        if len(seen) > 1:
            for (rest, before), k in seen.items():
                begin = at[k] - before
                self.texts.append(rest)
                self.owners.append((entries[k], begin))
                self.ranks.append((*ranks[k][:2], ranks[k][2] + begin))
                self.held += len(rest) + 1
        if self.held >= ARRAY_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        if not self.texts:
            return
        length = self.length
        joined = np.frombuffer(bytes(1).join([*self.texts, b""]), np.uint8).astype(np.int64)
        sizes = np.array([len(t) for t in self.texts])
        begin = np.cumsum(sizes + 1) - sizes - 1
        text = np.repeat(np.arange(len(sizes)), sizes + 1)
        symbols = joined + 1
        symbols[begin + sizes] = 0  # a separator below all bytes
        order = suffix_array(symbols)
        offset = order - begin[text[order]]
        order = order[offset + length <= sizes[text[order]]]
        same = np.zeros(len(order), bool)
        span = np.arange(length)
        for a in range(1, len(order), 4096):
            now, before = order[a : a + 4096], order[a - 1 : a + 4095][: len(order) - a]
            same[a : a + 4096] = (joined[now[:, None] + span] == joined[before[:, None] + span]).all(axis=1)
        group = np.cumsum(~same) - 1
        doc_id, key, start = (np.array(x) for x in zip(*self.ranks))
        owner = text[order]
        begins = start[owner] + order - begin[owner]
        by = np.lexsort((begins, key[owner], doc_id[owner], group))
        later = by[1:][group[by[1:]] == group[by[:-1]]]
        windows = np.sort(order[later])
        if len(windows):
            cut = np.flatnonzero(np.diff(windows) > 1) + 1
            for a, b in zip(windows[np.concatenate([[0], cut])].tolist(), windows[np.concatenate([cut - 1, [len(windows) - 1]])].tolist()):
                entry, skip = self.owners[text[a]]
                yield entry, skip + a - int(begin[text[a]]), skip + b - int(begin[text[a]])
        self.texts, self.owners, self.ranks, self.held = [], [], [], 0


# --- The distributed steps ---

_SPANS = "doc_id long, key long, lo int, hi int, at int, gram long"


def _span_batch(doc_id, key, lo, hi, at=None, gram=None) -> pa.RecordBatch:
    n = len(lo)
    columns = [pa.array(doc_id, pa.int64()), pa.array(key, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())]
    columns += [pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in ((at, pa.int32()), (gram, pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "lo", "hi", "at", "gram"])


def _first_and_covered(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts in the order of their grams, contexts and places; and whether one repeats the context before it.

    Rows that are equal in doc_id and text have the same places; those count once.
    """
    found = found[np.lexsort((found["lo"], found["key"], found["doc_id"], found["context"], found["gram"]))]
    found = found[np.concatenate([[True], found[1:] != found[:-1]])[: len(found)]]
    again = np.zeros(len(found), bool)
    again[1:] = (found["gram"][1:] == found["gram"][:-1]) & (found["context"][1:] == found["context"][:-1])
    return found, again


def _contexts_by_bucket(rows: DataFrame, buckets: int, length: int) -> DataFrame:
    """Step 1: (bucket, content): packed contexts for each bucket of 32-grams, and under bucket -1 the covered ones.

    The buckets from ``buckets`` on have contexts whose 32-gram is known to be shared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, keys = (batch.column(c).to_numpy() for c in ("doc_id", "key"))
            data, offsets = text_buffers(batch.column("text"))
            for lo, before, part, bounds in _pieces(data, offsets, length):
                row, gram, context, start, reach, at = contexts(part, bounds, length, GRAM)
                found = np.zeros(len(row), _CONTEXT)
                for name, value in (("gram", gram), ("context", context), ("doc_id", doc_ids[lo + row]), ("key", keys[lo + row])):
                    found[name] = value
                found["lo"], found["reach"], found["at"] = start + before, reach, at
                found, again = _first_and_covered(found)
                first = np.concatenate([[True], found["gram"][1:] != found["gram"][:-1]])[: len(found)]
                number = np.cumsum(first) - 1
                crowded = np.bincount(number, weights=~again)[number] > CROWD if len(found) else again
                own = (found["gram"] % np.uint64(buckets)).astype(np.int64)
                apart = buckets + ((found["gram"] ^ found["context"]) % np.uint64(buckets)).astype(np.int64)
                bucket = np.where(again, -1, np.where(crowded, apart, own))
                signs = np.flatnonzero(first & crowded)
                bucket = np.concatenate([bucket, own[signs]])
                found = np.concatenate([found, found[signs]])
                found["at"][len(found) - len(signs) :] = SIGN
                order = np.argsort(bucket, kind="stable")
                found, bucket = found[order], bucket[order]
                cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-2)), len(bucket))
                content = binary_slices(found.view(np.uint8), cuts * _CONTEXT.itemsize)
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]], pa.int32()), content], names=["bucket", "content"])

    return rows.select("doc_id", "key", "text").mapInArrow(tidy(run), "bucket int, content binary")


def _meet(packed: DataFrame, buckets: int) -> DataFrame:
    """Step 2: covered spans, and the first of each different context that shares its 32-gram with others."""

    def spread(found: np.ndarray) -> pa.RecordBatch:
        return _span_batch(found["doc_id"], found["key"], found["lo"], found["lo"] + found["reach"].astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bucket"]):
            content = group.column("content")
            if group.column("bucket")[0].as_py() < 0:
                for blob in content:
                    yield spread(np.frombuffer(blob.as_buffer(), _CONTEXT))
                continue
            # Signs come last in each content, so nothing is copied to part them.
            blobs = [np.frombuffer(b.as_buffer(), _CONTEXT) for b in content]
            rest = [len(b) - np.count_nonzero(b["at"] == SIGN) for b in blobs]
            signs = np.concatenate([b["gram"][n:] for b, n in zip(blobs, rest)])
            found, again = _first_and_covered(np.concatenate([b[:n] for b, n in zip(blobs, rest)]))
            if again.any():
                yield spread(found[again])
            found = found[~again]
            if len(found) and group.column("bucket")[0].as_py() < buckets:
                number = np.cumsum(np.concatenate([[True], found["gram"][1:] != found["gram"][:-1]])) - 1
                found = found[(np.bincount(number)[number] > 1) | np.isin(found["gram"], signs)]
            if len(found):
                hi = found["lo"] + found["reach"].astype(np.int32)
                yield _span_batch(found["doc_id"], found["key"], found["lo"], hi, found["at"], found["gram"].view(np.int64))

    # What is settled already stays where it is.
    moved = packed.withColumn("salt", F.when(F.col("bucket") < 0, F.spark_partition_id()).otherwise(F.lit(0)))
    return moved.repartition("bucket", "salt").sortWithinPartitions("bucket").select("bucket", "content").mapInArrow(tidy(run), _SPANS)


def _bytes_of(rows: DataFrame, length: int) -> DataFrame:
    """Step 3: the contexts ``wanted`` by each document with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            lists = batch.column("wanted")
            counts = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            lo, hi, at, gram, hot = (flat.field(k) for k in range(5))
            row = np.repeat(np.arange(batch.num_rows), counts)
            begin = lo.to_numpy() + offsets[row]
            end = begin + (hi.to_numpy() - lo.to_numpy() + length)
            raw = memoryview(data)
            text = [bytes(raw[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
            again = pa.array(row)
            columns = [batch.column("doc_id").take(again), batch.column("key").take(again), lo, at, gram, hot, pa.array(text, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "lo", "at", "gram", "hot", "bytes"])

    return rows.select("doc_id", "key", "text", "wanted").mapInArrow(
        tidy(run), "doc_id long, key long, lo int, at int, gram long, hot boolean, bytes binary"
    )


def _covered(pieces: DataFrame, length: int) -> DataFrame:
    """Step 4: covered windows of the contexts, group by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = RepeatFinder(length)
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*[(d, k, lo + a, lo + b) for (d, k, lo), a, b in out])]
            out.clear()
            return _span_batch(*columns)

        for group in sorted_groups(batches, ["gram"], 2):
            places = list(zip(*(group.column(c).to_pylist() for c in ("doc_id", "key", "lo"))))
            out += finder.add(places, places, group.column("bytes").to_pylist(), group.column("at").to_pylist())
            if len(out) > 50_000:
                yield batch()
        out += finder.flush()
        if out:
            yield batch()

    rows = pieces.repartition("gram").sortWithinPartitions("gram")
    return rows.select("doc_id", "key", "lo", "at", "gram", "bytes").mapInArrow(tidy(run), _SPANS).select("doc_id", "key", "lo", "hi")


def _covered_hot(pieces: DataFrame, length: int) -> DataFrame:
    """Step 4 for a 32-gram with more contexts than one task should hold: its windows are compared one by one.

    Equal windows meet by their bytes; only the earliest start of each is kept, before the shuffle.
    """
    offset = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)).alias("offset")
    rows = pieces.select("doc_id", "key", "lo", offset, "bytes")
    window = F.substring("bytes", F.col("offset") + 1, F.lit(length))
    rows = rows.select("doc_id", "key", (F.col("lo") + F.col("offset")).alias("lo"), F.sha2(window, 256).alias("window"))
    first = rows.groupBy("window").agg(F.min(F.struct("doc_id", "key", "lo")).alias("first"))
    later = rows.join(first, "window").filter(F.struct("doc_id", "key", "lo") != F.col("first"))
    return later.select("doc_id", "key", "lo", F.col("lo").alias("hi"))


def _removed(rows: DataFrame, length: int, keep_text: bool) -> DataFrame:
    """Step 5: what is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            raw = memoryview(data)
            spans, copies = batch.column("spans"), batch.column("copy").to_numpy(zero_copy_only=False)
            bounds = spans.offsets.to_numpy()
            flat = spans.flatten()
            los, his = flat.field(0).to_numpy(), flat.field(1).to_numpy() + length
            valid = spans.is_valid().to_numpy(zero_copy_only=False)
            base = bounds[0]
            removed, runs, digests, texts = [], [], [], []
            for i in range(batch.num_rows):
                text = raw[offsets[i] : offsets[i + 1]]
                n = len(text)
                if copies[i] and n >= length:
                    lo, hi = [0], [n]
                elif valid[i] and bounds[i + 1] > bounds[i]:
                    a, b = los[bounds[i] - base : bounds[i + 1] - base], his[bounds[i] - base : bounds[i + 1] - base]
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order])
                    fresh = np.concatenate([[True], a[1:] > b[:-1]])
                    lo = a[fresh].tolist()
                    hi = b[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(b) - 1]])].tolist()
                else:
                    lo, hi = [], []
                left = b"".join(text[x:y] for x, y in zip([0, *hi], [*lo, n]))
                removed.append(n - len(left))
                runs.append(len(lo))
                digests.append(hashlib.sha256(left).hexdigest())
                texts.append(left)
            columns = [
                batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                pa.array(digests, pa.string()),
            ]
            if keep_text:
                columns.append(pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string()))
            columns += [batch.column(c) for c in extra]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    extra = [c for c in rows.columns if c not in ("doc_id", "key", "text", "spans", "copy")]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * keep_text, *extra]
    types = dict(rows.dtypes)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * keep_text
    return rows.mapInArrow(tidy(run), schema + "".join(f", `{c}` {types[c]}" for c in extra))


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, with ``keep_text`` also ``kept``, and ``carry``) of all rows.
    ``kept`` is the text that is left, without the rests of code points that were cut.

    Each byte below a string of ``length`` bytes that also starts earlier is removed: in a document with a smaller
    doc_id, or further left in the same one. Null texts are empty. Null doc_ids come before all others. Rows that
    repeat a doc_id are ordered by a checksum of their texts; of rows with equal texts, too, the first one stays.
    Other columns are not read.

    Texts are shuffled once for steps 3 and 5 together. What is removed does not depend on the partitions.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.crc32(raw.cast("binary")).alias("key"), raw.alias("text"), *carry
    )
    buckets = 4 * shuffle_partitions(spark)
    spans = materialize(_meet(_contexts_by_bucket(rows, buckets, length), buckets), "repeat-spans")
    shared = spans.filter("gram is not null")
    hot = shared.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP_ROWS)
    shared = shared.join(hot, "gram", "left").withColumn("hot", F.col("n").isNotNull())
    wanted = shared.groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("lo", "hi", "at", "gram", "hot")).alias("wanted")
    )
    # Rows with one doc_id and text need their bytes only once, but are all looked at in the end.
    pieces = _bytes_of(rows.join(wanted, ["doc_id", "key"]), length)
    pieces = materialize(pieces.dropDuplicates(["doc_id", "key", "lo"]), "repeat-contexts")
    late = _covered(pieces.filter("not hot"), length)
    if pieces.filter("hot").limit(1).count():
        late = late.unionByName(_covered_hot(pieces.filter("hot"), length))
    covered = spans.filter("gram is null").select("doc_id", "key", "lo", "hi").unionByName(late)
    covered = covered.groupBy("doc_id", "key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    copy = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("doc_id")) > 1
    out = _removed(rows.join(covered, ["doc_id", "key"], "left").withColumn("copy", copy), length, keep_text)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
