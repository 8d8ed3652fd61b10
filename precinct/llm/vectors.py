"""Near-duplicate embeddings: cross-polytope hashing after fast Hadamard rotations, multiprobe, verified links.

A hash function turns a vector by three rounds of random signs and a Walsh-Hadamard transform and takes the largest
coordinate with its sign. Two functions make a table's code. Each vector stands in its own bucket of every table and in
the one it misses most narrowly. Buckets give verified links, links give components; as every link lies within one
component, exact block products inside the components then count all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import components, local_forest, mix64, random_words, sorted_groups, tidy
from precinct.session import materialize

THRESHOLD = 0.93
TABLES, FUNCTIONS, PROBES = 8, 2, 1
# Rows of a bucket, and of a block of a component, that are multiplied at once.
BUCKET_ROWS, BLOCK_ROWS = 2048, 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row; the width is a power of two."""
    width, step = x.shape[1], 1
    while step < width:
        y = x.reshape(len(x), -1, 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), width)
        step *= 2
    return x / np.sqrt(width)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """The pseudo-random rotation ``number`` of each row, padded to a power of two."""
    width = 1 << max(x.shape[1] - 1, 1).bit_length()
    out = np.zeros((len(x), width))
    out[:, : x.shape[1]] = x
    for turn in range(3):
        signs = 1.0 - 2.0 * (random_words(width, 97 + 3 * number + turn) >> np.uint64(63)).astype(np.float64)
        out = hadamard(out * signs)
    return out


def codes(x: np.ndarray, tables: int = TABLES, functions: int = FUNCTIONS, probes: int = PROBES) -> np.ndarray:
    """(rows, tables, 1 + probes) 64-bit bucket codes: the own bucket, then the nearest others."""
    rows = len(x)
    out = np.zeros((rows, tables, 1 + probes), np.uint64)
    every = np.arange(rows)
    for table in range(tables):
        best, other, gaps = [], [], []
        for k in range(functions):
            y = rotated(x, table * functions + k)
            size = np.abs(y)
            order = np.argpartition(size, -2, axis=1)[:, -2:]
            swap = size[every, order[:, 0]] > size[every, order[:, 1]]
            first, second = np.where(swap, order[:, 0], order[:, 1]), np.where(swap, order[:, 1], order[:, 0])
            best.append(2 * first + (y[every, first] < 0))
            other.append(2 * second + (y[every, second] < 0))
            gaps.append(size[every, first] - size[every, second])

        def code(digits: list[np.ndarray]) -> np.ndarray:
            total = np.full(rows, table + 1, np.uint64)
            for d in digits:
                total = mix64(total + d.astype(np.uint64))
            return total

        out[:, table, 0] = code(best)
        rank = np.argsort(np.stack(gaps, axis=1), axis=1)
        for p in range(min(probes, functions)):
            digits = [np.where(rank[:, p] == k, other[k], best[k]) for k in range(functions)]
            out[:, table, 1 + p] = code(digits)
    return out


def unit_rows(column: pa.Array) -> np.ndarray:
    """The vectors of a list column as rows of length one, in double precision. All have the same width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _bucket_rows(classes: DataFrame, tables: int, functions: int, probes: int) -> DataFrame:
    """(bucket, cid, embedding): each class in all its buckets; labels and widths never share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.diff(batch.column("embedding").offsets.to_numpy())
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                for lo in range(0, len(at), 1024):
                    part = batch.take(pa.array(at[lo : lo + 1024]))
                    found = codes(unit_rows(part.column("embedding")), tables, functions, probes)
                    found = found.reshape(len(found), -1)
                    label = part.column("label").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(width)
                    bucket = mix64(found + mix64(label)[:, None]).view(np.int64)
                    n = found.shape[1]
                    again = pa.array(np.repeat(np.arange(len(found)), n))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket.reshape(-1)), part.column("cid").take(again), part.column("embedding").take(again)],
                        names=["bucket", "cid", "embedding"],
                    )

    kind = dict(classes.dtypes)["embedding"]
    return classes.select("cid", "label", "embedding").mapInArrow(tidy(run), f"bucket long, cid long, embedding {kind}")


def _groups(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the smallest row that can be reached."""
    root = np.full(len(near), -1)
    while (root < 0).any():
        start = int(np.argmax(root < 0))
        front = np.array([start])
        root[start] = start
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & (root < 0))
            root[front] = start
    return root


def _join(near: np.ndarray, to: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The roots ``to`` of all groups after the links ``near`` between rows of the groups ``one`` and ``two``."""
    left, right = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    a, at = np.unique(one[left], return_index=True)
    b, below = np.unique(two[right], return_index=True)
    met = np.logical_or.reduceat(np.logical_or.reduceat(near[left], at, axis=0)[:, right], below, axis=1)
    i, j = np.nonzero(met)
    low, member = local_forest(a[i], b[j])
    moved = np.arange(len(to))
    moved[member] = low
    return moved[to]


def join_blocks(
    x: np.ndarray, threshold: float, to: np.ndarray, group: np.ndarray, one: np.ndarray, two: np.ndarray, main: int
) -> np.ndarray:
    """The roots ``to`` of all groups after the links between two blocks of rows of ``x``.

    ``group`` is the group of each row. Pairs of rows that are both in the root ``main`` are not multiplied.
    """
    in_one, in_two = to[group[one]] == main, to[group[two]] == main
    for rows, columns in ((one[~in_one], two), (one[in_one], two[~in_two])):
        if len(rows) and len(columns):
            to = _join(x[rows] @ x[columns].T >= threshold, to, to[group[rows]], to[group[columns]])
    return to


def connected(x: np.ndarray, threshold: float, block: int) -> np.ndarray:
    """For each row of ``x`` the smallest row of its group under the links of all pairs, multiplied in blocks.

    Pairs in the largest group of the moment are connected already; all others are multiplied.
    """
    n = len(x)
    every = np.arange(n)
    to = every.copy()
    for lo in range(0, n, block):
        own = every[lo : lo + block]
        to[own] = lo + _groups(x[own] @ x[own].T >= threshold)
        for before in range(0, lo, block):
            main = int(np.bincount(to[: lo + len(own)]).argmax())
            to = join_blocks(x, threshold, to, every, every[before : before + block], own, main)
    return to


def _bucket_links(rows: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that connect what is connected in each part of a bucket: for each vector one to the first of its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bucket", "salt"], 2):
            ids = group.column("cid").to_numpy()
            _, first = np.unique(ids, return_index=True)
            if len(first) < 2:
                continue
            group, ids = group.take(pa.array(np.sort(first))), ids[np.sort(first)]
            root = connected(unit_rows(group.column("embedding")), threshold, BUCKET_ROWS)
            member = np.flatnonzero(root != np.arange(len(root)))
            if len(member):
                yield pa.RecordBatch.from_arrays([pa.array(ids[root[member]]), pa.array(ids[member])], names=["a", "b"])

    return rows.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt").mapInArrow(tidy(run), "a long, b long")


def _links_across(placed: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between the parts of large buckets, (bucket, parts, salt, cid, embedding), for each two groups.

    Two rows in the largest group of their bucket are connected already. All others meet, one task for each pair of
    parts: a row outside of that group goes to all other parts, and one inside to those that have a row outside.
    """
    rows = placed.join(groups, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    most = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    most = most.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    most = materialize(most, "vector-main")
    rows = rows.join(most, "bucket").withColumn("inside", F.col("component") == F.col("main")).drop("main")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    open_parts = rows.filter("not inside").select("bucket", F.col("salt").alias("other")).distinct()
    outside = rows.filter("not inside").select("*", every)
    inside = rows.filter("inside").join(open_parts, "bucket").select(*outside.columns)
    rows = outside.unionByName(inside).filter("other <> salt").select(
        "bucket", F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"),
        (F.col("salt") > F.col("other")).alias("second"), "inside", "component", "embedding",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bucket", "i", "j"], 2):
            ids, root = np.unique(group.column("component").to_numpy(), return_inverse=True)
            second, inside = (group.column(c).to_numpy(zero_copy_only=False) for c in ("second", "inside"))
            x = unit_rows(group.column("embedding"))
            main = int(root[np.argmax(inside)]) if inside.any() else -1
            one, two = np.flatnonzero(~second), np.flatnonzero(second)
            # The nodes of the forest are the groups: rows follow their group to its new root.
            to = np.arange(len(ids))
            for a in range(0, len(one), BUCKET_ROWS):
                for b in range(0, len(two), BUCKET_ROWS):
                    known = to[main] if main >= 0 else -1
                    to = join_blocks(x, threshold, to, root, one[a : a + BUCKET_ROWS], two[b : b + BUCKET_ROWS], known)
            member = np.flatnonzero(to != np.arange(len(to)))
            if len(member):
                yield pa.RecordBatch.from_arrays([pa.array(ids[to[member]]), pa.array(ids[member])], names=["a", "b"])

    keys = ["bucket", "i", "j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidy(run), "a long, b long")


def _link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(cid, links): how many rows each class is linked with, itself included, by block products in its component."""
    # Sizes by an aggregate and a join, so that no task sorts all vectors of a large component.
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).alias("second"), "cid", "n", "embedding",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["component", "i", "j"]):
            second = group.column("second").to_numpy(zero_copy_only=False)
            ids, n, x = group.column("cid").to_numpy(), group.column("n").to_numpy(), unit_rows(group.column("embedding"))
            same = group.column("i")[0].as_py() == group.column("j")[0].as_py()
            left = np.flatnonzero(~second)
            right = left if same else np.flatnonzero(second)
            if not len(left) or not len(right):
                continue
            near = (x[left] @ x[right].T >= threshold).astype(np.float64)
            if same:
                np.fill_diagonal(near, 1.0)
            out, counts = ids[left], near @ n[right]
            if not same:
                out, counts = np.concatenate([out, ids[right]]), np.concatenate([counts, near.T @ n[left]])
            yield pa.RecordBatch.from_arrays([pa.array(out), pa.array(counts.astype(np.int64))], names=["cid", "links"])

    keys = ["component", "i", "j"]
    counted = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidy(run), "cid long, links long")
    return counted.groupBy("cid").agg(F.sum("links").alias("links"))


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, functions: int = FUNCTIONS, probes: int = PROBES
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Vectors of equal labels and widths are linked when their cosine is ``threshold`` or more. Vectors that are null,
    empty, zero, or hold null or non-finite components, and those without a label, are linked with nothing. Equal
    vectors form one class that is hashed and multiplied once and counts as many rows as it has. Rows that repeat
    a vec_id are vectors of their own. A null vec_id is below all others. Other columns are not read.
    """
    none = -(1 << 63)
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    kind = dict(vectors.dtypes)["embedding"]
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(none)).alias("vec_id"),
        F.col("embedding").cast(kind).alias("embedding"),
        F.col("label").cast("long").alias("label"),
    )
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad)
    good = F.coalesce(good, F.lit(False)) & F.coalesce(F.exists("embedding", lambda v: v != 0), F.lit(False))
    # Both zeros are one: the key of a class is a hash of its label and components.
    plain = F.transform("embedding", lambda v: F.when(v == 0, F.lit(0).cast("double")).otherwise(v.cast("double")))
    rows = rows.withColumn("cid", F.when(good, F.xxhash64("label", plain)))
    classes = rows.filter("cid is not null").groupBy("cid").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    classes = materialize(classes, "vector-classes")
    placed = _bucket_rows(classes, tables, functions, probes)
    # A bucket beyond the size of a part is split; what its parts do not connect is compared across all of them.
    size = F.ceil(F.col("size") / (4 * BUCKET_ROWS)).cast("int")
    large = placed.groupBy("bucket").agg(F.count("*").alias("size")).filter(f"size > {4 * BUCKET_ROWS}")
    large = materialize(large.select("bucket", size.alias("parts")), "vector-buckets")
    placed = placed.join(large, "bucket", "left")
    parts = F.coalesce("parts", F.lit(1))
    placed = placed.select("bucket", "parts", F.pmod(F.xxhash64("cid"), parts).cast("int").alias("salt"), "cid", "embedding")
    links = materialize(_bucket_links(placed, threshold), "vector-links")
    groups = materialize(components(links, "vector-groups").withColumnRenamed("node", "cid"), "vector-groups")
    if large.limit(1).count():
        links = links.unionByName(_links_across(placed.filter("parts > 1"), groups, threshold))
        groups = materialize(components(links, "vector-groups").withColumnRenamed("node", "cid"), "vector-groups")
    members = classes.select("cid", "n", "embedding").join(groups, "cid")
    counts = _link_counts(members, threshold)
    least = classes.join(groups, "cid").groupBy("component").agg(F.min("rep").alias("least"))
    found = classes.select("cid", "rep", "n").join(groups, "cid", "left").join(least, "component", "left").join(counts, "cid", "left")
    found = found.select(
        "cid", F.coalesce("least", "rep").alias("least"), (F.coalesce("links", "n") - 1).alias("links")
    )
    out = rows.select("vec_id", "cid").join(found, "cid", "left")
    component = F.coalesce("least", "vec_id")
    back = lambda c: F.when(c != none, c)
    return out.select(
        back(F.col("vec_id")).alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        back(component).alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )
