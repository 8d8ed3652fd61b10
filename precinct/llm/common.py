"""What the operators share: Arrow text buffers, rolling hashes, ordered buckets, components and scratch tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from precinct.session import materialize

# Bytes of text that a task works on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 19

# glibc's; other C libraries have none.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

_GOLDEN = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2^64


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- Arrow and numpy ---


def give_back() -> None:
    """Free memory that Arrow's pool and the C library keep for later goes back to the system.

    A worker process lives as long as its executor; what one stage has touched would be kept beside the next one's.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` over the batches of a partition, behind which the worker gives its free memory back.

    So what a worker keeps between tasks is its state, not the most that a task has needed.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column, without a copy, and the row offsets into them; null is empty.

    What the batches before have left behind goes back to the system.
    """
    give_back()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)

    def parts() -> tuple[np.ndarray, pa.Buffer | None]:
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1]
        return offsets.astype(np.int64), data

    offsets, data = parts()
    # Arrow lets a null have bytes; only then the column is copied without them.
    if column.null_count and np.diff(offsets)[column.is_null().to_numpy(zero_copy_only=False)].any():
        binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
        column = pc.fill_null(column, b"" if binary else "")
        offsets, data = parts()
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary_slices(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of ``data`` between neighbouring ``cuts`` (bytes, from 0 to the end) as a binary column, without a copy.

    pyarrow never frees the memory of memoryviews that it makes a column of; nor are there Python objects for the slices.
    """
    offsets = pa.py_buffer(np.ascontiguousarray(cuts, np.int32))
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(data))])


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``limit`` bytes together, at least one row each."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, min(end, rows)
        row = end


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes of all ranges [start, start + length), one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (xor-shift and multiply)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * np.uint64(_GOLDEN))


BYTE_WORDS = random_words(256, 1)


# Powers of the base and of its inverse within a block; a block number turns them into those of any place.
_BLOCK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & ((1 << 64) - 1), np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS, _INVERSES = _powers(_BASE, _BLOCK), _powers(pow(_BASE, -1, 1 << 64), _BLOCK)


class RollingHash:
    """Hashes of byte ranges of one buffer: prefix sums of byte words times powers, modulo 2^64.

    ``words`` gives the word of each byte value. Besides the sums nothing grows with the buffer, and nothing outlives it.
    """

    def __init__(self, data: np.ndarray, words: np.ndarray):
        blocks = -(-len(data) // _BLOCK) or 1
        steps = _powers(pow(_BASE, _BLOCK, 1 << 64), blocks)
        self.inverse_steps = _powers(pow(_BASE, -_BLOCK, 1 << 64), blocks + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        for k in range(blocks):
            part = words[data[k * _BLOCK : (k + 1) * _BLOCK]]
            part *= _POWERS[: len(part)]
            part *= steps[k]
            out = self.sums[k * _BLOCK + 1 : k * _BLOCK + 1 + len(part)]
            np.cumsum(part, out=out)
            out += self.sums[k * _BLOCK]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = self.sums[ends] - self.sums[starts]
        raw *= _INVERSES[starts & (_BLOCK - 1)]
        if len(self.inverse_steps) > 2:
            raw *= self.inverse_steps[starts >> 16]
        return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(_GOLDEN))


# --- State of a worker process ---

_HELD: dict[tuple, object] = {}


def held_state(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept for the next tasks of this worker until another operator holds a state of its own.

    A worker outlives the stages of a job; so it never has the vocabularies and tables of two of them.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
        give_back()
    return _HELD[key]


# --- Order ---


def ordered_buckets(df: DataFrame, key: str, buckets: int, bucket: str = "bucket") -> tuple[DataFrame, int]:
    """``df`` with a column of ascending range buckets of the integer ``key``, and how many there are.

    The bounds are approximate quantiles of all keys, one per bucket; equal keys share a bucket and null keys
    have the last one. Only the bounds come to the driver: their number is the parameter ``buckets``.
    """
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(key, shares, 20 * buckets).alias("q")).first()["q"] if shares else None
    bounds = sorted({float(x) for x in found or ()})
    splits = [float("-inf"), *(bounds or [0.0]), float("inf")]
    scratch = f"{bucket}__key"
    out = Bucketizer(splits=splits, inputCol=scratch, outputCol=bucket, handleInvalid="keep").transform(
        df.withColumn(scratch, F.col(key).cast("double"))
    )
    return out.drop(scratch).withColumn(bucket, F.coalesce(F.col(bucket).cast("int"), F.lit(len(splits) - 1))), len(splits)


def running_sums(
    df: DataFrame, within: list[str], bucket: str, order: list[Column], sums: dict[str, Column]
) -> DataFrame:
    """``df`` with exclusive running sums over ``order``, restarted for each value of ``within``.

    A hot group is not sorted by one task: each range bucket is summed by itself, and the totals of the
    buckets before it are added (one row for each group and bucket).
    """
    keys = [*within, bucket]
    kept = df.withColumns({f"{name}__value": value for name, value in sums.items()})
    totals = kept.groupBy(*keys).agg(*[F.sum(f"{name}__value").alias(f"{name}__total") for name in sums])
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"{k}__key") for k in keys],
        *[F.coalesce(F.sum(f"{name}__total").over(before), F.lit(0)).alias(f"{name}__before") for name in sums],
    )
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = kept.withColumns(
        {f"{name}__local": F.coalesce(F.sum(f"{name}__value").over(inner), F.lit(0)) for name in sums}
    )
    same = [F.col(k).eqNullSafe(F.col(f"{k}__key")) for k in keys]
    joined = local.join(offsets, same, "left")
    return joined.select(
        *df.columns, *[(F.col(f"{name}__local") + F.col(f"{name}__before")).alias(name) for name in sums]
    )


# --- Components ---


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (root, member) of the forest that union-find makes of the given edges; a root is its smallest node."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(index[: len(a)].tolist(), index[len(a) :].tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.array([find(x) for x in range(len(nodes))], np.int64)
    member = roots != np.arange(len(nodes))
    return nodes[roots[member]], nodes[member]


def _forest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch.column("a").to_numpy()])
        b = np.concatenate([b, batch.column("b").to_numpy()])
        if len(a) > 1 << 20:
            a, b = local_forest(a, b)
            if len(a) > 1 << 19:  # a forest that stays large is passed on as it is
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a = b = np.zeros(0, np.int64)
    if len(a):
        a, b = local_forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, component) for every node of the links ``a`` - ``b``: the smallest node that can be reached.

    Union-find within each partition leaves a forest; then each node passes its neighbours on to the smallest
    of them (large and small stars in turn) until only stars are left. Each round is stored in the shared
    folder, so that nothing is recomputed and lost executors do not matter.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    edges = edges.mapInArrow(tidy(_forest_batches), "a long, b long")
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = materialize(edges, name)
    while True:
        # Large star: larger neighbours of each node are linked with its smallest neighbour.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        # Small star: smaller neighbours, and the node itself, are linked with the smallest of them.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
        small = small.filter("a <> b").distinct()
        after = materialize(small, name)
        stars = after.groupBy("b").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count() == 0
        centres = after.select(F.col("a").alias("b")).join(after.select("b"), "b", "left_semi").limit(1).count() == 0
        edges = after
        if stars and centres:
            break
    members = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


# --- Groups in sorted partitions ---


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 1) -> Iterator[pa.Table]:
    """The groups of ``keys`` in a partition that is sorted by them, one table for each with ``least`` rows or more."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        change[0] = last is not None and first != last
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if k and held:
                if sum(h.num_rows for h in held) >= least:
                    yield pa.Table.from_batches(held)
                held = []
            # A group that is too small and ends inside the batch is not even sliced.
            if b > a and (b == batch.num_rows or b - a >= least or held):
                held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if sum(h.num_rows for h in held) >= least:
        yield pa.Table.from_batches(held)
