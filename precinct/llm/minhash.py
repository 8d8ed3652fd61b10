"""Near-duplicate documents by SuperMinHash signatures, banding, verification on full sets and union-find.

Word shingles become 64-bit hashes. SuperMinHash gives each element its own random permutation of the registers; in
step j the element offers j plus a random fraction to the j-th register of its permutation. As soon as every register
holds less than j + 1, no later step can matter, so a text with many shingles is done after two or three steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import BYTE_WORDS, RollingHash, binary_slices, chunks, components, mix64, ragged, sorted_groups, text_buffers, tidy
from precinct.session import materialize

WIDTH = 5
# 20 bands of 4: two sets with a similarity of 0.85 share no band in fewer than one of two million cases.
BANDS, ROWS = 20, 4
# Classes of a bucket that one task holds at once.
BUCKET_ROWS = 2048

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER_WORDS = BYTE_WORDS[_LOWER]
_FACTORS = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD)]


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of all rows start and end, and the row offsets in them."""
    word = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], word])[: len(data)] & ~edge[:-1]
    after = np.concatenate([word[1:], [False]])[: len(data)] & ~edge[1:]
    starts = np.flatnonzero(word & ~before)
    return starts, np.flatnonzero(word & ~after) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all rows, and the row offsets in them."""
    starts, ends, bounds = word_places(data, offsets)
    return RollingHash(data, _LOWER_WORDS).of(starts, ends), bounds


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and the row offsets in them.

    A row with fewer than ``width`` words has its whole sequence as the only shingle, one without words has none.
    """
    words, bounds = word_hashes(data, offsets)
    if len(words) >= width:
        hashes = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):
            hashes += (words[k : len(hashes) + k] ^ np.uint64(k + 1)) * _FACTORS[k % 5]
        hashes = mix64(hashes)
    else:
        hashes = np.zeros(0, np.uint64)
    sets, sizes = [], np.zeros(len(bounds) - 1, np.int64)
    for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b - a >= width:
            own = np.sort(hashes[a : b - width + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            short = np.zeros(1, np.uint64)
            for k in range(b - a):
                short += (words[a + k : a + k + 1] ^ np.uint64(k + 1)) * _FACTORS[k % 5]
            own = mix64(short + np.uint64(b - a))
        else:
            continue
        sets.append(own)
        sizes[row] = len(own)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def super_minhash(elements: np.ndarray, bounds: np.ndarray, registers: int) -> np.ndarray:
    """Signatures (rows, registers) of all rows; those of empty rows stay infinite.

    Works on all elements of a step at once. The j-th place of a Fisher-Yates shuffle is found from the draws of
    the steps so far: a place was last filled, in step t, from place t.
    """
    rows = len(bounds) - 1
    out = np.full((rows, registers), np.inf)
    flat = out.reshape(-1)
    row = np.repeat(np.arange(rows), np.diff(bounds))
    draws: list[np.ndarray] = []
    for step in range(registers):
        if not len(row):
            break
        random = mix64(elements + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        fraction = (random >> np.uint64(24)).astype(np.float64) / float(1 << 40)
        place = step + ((random & np.uint64(0xFFFFFF)) * np.uint64(registers - step) >> np.uint64(24)).astype(np.int16)
        draws.append(place)
        for t in range(step - 1, -1, -1):
            place = np.where(place == draws[t], np.int16(t), place)
        np.minimum.at(flat, row * registers + place, step + fraction)
        open_rows = out.max(axis=1) >= step + 1  # an early stop for all others
        active = open_rows[row]
        if not active.all():
            row, elements = row[active], elements[active]
            draws = [d[active] for d in draws]
    return out


def band_hashes(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit hash for each band of each signature."""
    bits = np.ascontiguousarray(signatures).view(np.uint64).reshape(len(signatures), bands, rows)
    out = np.zeros((len(signatures), bands), np.uint64)
    for k in range(rows):
        out = mix64(out + bits[:, :, k] * _FACTORS[k % 5])
    return mix64(out + np.arange(bands, dtype=np.uint64))


def text_key() -> Column:
    """A hash of a row's text, which tells rows that repeat a doc_id apart."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")


def _digests(sets: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over the scrambled elements of each row: equal for equal sets."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(sets + np.uint64(s)))]) for s in (1, 2)]
    return [(s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums]


def _profile(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, two digests of the set, and the band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in chunks(offsets):
                sets, bounds = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                bands = band_hashes(super_minhash(sets, bounds, BANDS * ROWS)).view(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(bands.reshape(-1)), BANDS).cast(pa.list_(pa.int64()))
                own = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_key")]
                columns = [*own, pa.array(np.diff(bounds)), *map(pa.array, _digests(sets, bounds)), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n_shingles", "one", "two", "bands"])

    schema = "doc_id long, text_key long, n_shingles long, one long, two long, bands array<long>"
    return docs.select("doc_id", "text", text_key()).mapInArrow(tidy(run), schema)


def _sets(docs: DataFrame) -> DataFrame:
    """n_shingles, the digests, and the sorted shingle hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for lo, hi in chunks(offsets):
                sets, bounds = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                columns = [pa.array(np.diff(bounds)), *map(pa.array, _digests(sets, bounds)), binary_slices(sets, 8 * bounds)]
                yield pa.RecordBatch.from_arrays(columns, names=["n_shingles", "one", "two", "set"])

    return docs.select("text").mapInArrow(tidy(run), "n_shingles long, one long, two long, set binary")


def linked(sets: list[np.ndarray], percent: int, expand: np.ndarray | None = None) -> np.ndarray:
    """For each set the smallest index of its component under the links of the sets.

    An inverted index gives the intersections of one set with all others at once. The component of the first set with
    a link is the main one; only sets that are not in it yet are compared with all others, so a large group takes
    few comparisons, and two sets in different components have been compared. With ``expand``, only the sets it
    marks are compared with all others.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(codes, kind="stable")
    owner = owner[order]
    begin = np.concatenate([[0], np.cumsum(np.bincount(codes))])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    main = None
    for x in range(n):
        if expand is not None:
            if not expand[x]:
                continue
        elif main is not None and find(x) == find(main):
            continue
        own = codes[bounds[x] : bounds[x + 1]]
        shared = np.bincount(owner[ragged(begin[own], begin[own + 1] - begin[own])], minlength=n)
        for y in np.flatnonzero(100 * shared >= percent * (sizes + sizes[x] - shared)).tolist():
            if y != x:
                main = x if main is None else main
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return np.array([find(x) for x in range(n)])


def _bucket_links(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links (a, b) that connect what is linked within each group of ``keys``, from (cid, set, expand)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, keys, 2):
            _, first = np.unique(group.column("cid").to_numpy(), return_index=True)
            if len(first) < 2:
                continue
            group = group.take(pa.array(np.sort(first)))
            ids = group.column("cid").to_numpy()
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in group.column("set")]
            marked = group.column("expand")
            expand = None if marked.null_count else marked.to_numpy(zero_copy_only=False)
            roots = linked(sets, percent, expand)
            member = np.flatnonzero(roots != np.arange(len(roots)))
            if len(member):
                yield pa.RecordBatch.from_arrays([pa.array(ids[roots[member]]), pa.array(ids[member])], names=["a", "b"])

    # A row that others are compared with comes after those that repeat it with a mark.
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, F.col("expand").desc_nulls_last(), "cid")
    return rows.select(*keys, "cid", "set", "expand").mapInArrow(tidy(run), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key, group_key) for every row of ``docs``.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets; component_id is the
    smallest doc_id that can be reached. Null and wordless texts have an empty set and are linked with nothing. Rows
    with a null doc_id take part under one id below all others, which is null again in the result. Rows that repeat
    a doc_id are linked by their own sets; ``group_key`` tells components apart that such rows give the same
    component_id. Other columns are not read.

    Equal sets are one class that goes on once, however many copies it has. Buckets of different bands with the same
    members are looked at once. A bucket of more than BUCKET_ROWS classes is split into parts; what is in one
    component after the parts is not compared again, and those outside the largest component of such a bucket
    are compared with all of its parts. No cap is set.
    """
    none = -(1 << 63)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(none)).alias("doc_id"), "text")
    cid = F.xxhash64("n_shingles", "one", "two").alias("cid")
    profile = materialize(_profile(docs).select("doc_id", "text_key", "n_shingles", cid, "bands"), "minhash-profile")
    classes = profile.filter("n_shingles > 0").groupBy("cid").agg(F.min("doc_id").alias("rep"), F.min("bands").alias("bands"))
    classes = materialize(classes, "minhash-classes")
    buckets = classes.select("cid", "rep", F.posexplode("bands").alias("band", "hash"))
    # Sums over scrambled members tell which buckets are alike.
    alike = [F.count("*").alias("n"), *[F.sum(F.shiftright(F.xxhash64("cid", F.lit(k)), 24)).alias(f"sum{k}") for k in (1, 2)]]
    sizes = buckets.groupBy("band", "hash").agg(*alike).filter("n > 1")
    once = sizes.groupBy("n", "sum1", "sum2").agg(F.min(F.struct("band", "hash")).alias("b"))
    shared = buckets.join(once.select("b.band", "b.hash", "n"), ["band", "hash"])
    parts = F.ceil(F.col("n") / BUCKET_ROWS).cast("int")
    shared = shared.select("band", "hash", "cid", "rep", parts.alias("parts"), F.pmod(F.xxhash64("cid"), parts).cast("int").alias("part"))
    shared = materialize(shared, "minhash-buckets")
    # The same kind of join at every size, so that what is shuffled grows with the input.
    own = shared.select(F.col("rep").alias("doc_id")).distinct().hint("merge")
    sets = _sets(docs.join(own, "doc_id", "left_semi")).select(cid, "set").dropDuplicates(["cid"])
    sets = materialize(sets, "minhash-sets")
    keys = ["band", "hash", "part"]
    with_sets = shared.join(sets, "cid")
    links = _bucket_links(with_sets.withColumn("expand", F.lit(None).cast("boolean")), keys, percent)
    links = materialize(links, "minhash-links")
    groups = components(links, "minhash-groups")
    split = shared.filter("parts > 1")
    if split.limit(1).count():
        named = split.join(groups.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        named = materialize(named, "minhash-named")
        most = named.groupBy("band", "hash", "component").count().groupBy("band", "hash").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
        outside = named.join(most, ["band", "hash"]).filter("component <> main")
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        outside = outside.select("band", "hash", every, "cid", F.lit(True).alias("expand"))
        rows = named.select(*keys, "cid", F.lit(False).alias("expand"))
        rows = rows.join(outside.select(*keys).distinct(), keys, "left_semi").unionByName(outside)
        more = _bucket_links(rows.join(sets, "cid"), keys, percent)
        groups = components(links.unionByName(more), "minhash-groups")
    found = classes.select("cid", "rep").join(groups.withColumnRenamed("node", "cid"), "cid")
    least = found.groupBy("component").agg(F.min("rep").alias("least"))
    found = found.join(least, "component").select("cid", "least", "component")
    # A class that is linked with no other one has its own smallest doc_id.
    found = classes.select("cid", "rep").join(found, "cid", "left").select(
        "cid", F.coalesce("least", "rep").alias("least"), F.coalesce("component", "cid").alias("group_key")
    )
    out = profile.select("doc_id", "text_key", "n_shingles", "cid").join(found, "cid", "left")
    component = F.coalesce("least", "doc_id")
    back = lambda c: F.when(c != none, c)
    return out.select(
        back(F.col("doc_id")).alias("doc_id"), "n_shingles", back(component).alias("component_id"),
        (F.col("doc_id") == component).alias("kept"), "text_key", "group_key",
    )


def without_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id, and all without words.

    If several rows of a component have that doc_id, the one with the smallest ``text_key`` stays; of rows that
    repeat both, one.
    """
    found = near_duplicates(docs, percent).filter("kept")
    words = found.filter("n_shingles > 0").groupBy("group_key").agg(F.min(F.struct("doc_id", "text_key")).alias("k"))
    words = words.select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_key").alias("kept_key"), F.lit(True).alias("single"))
    empty = found.filter("n_shingles = 0").select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"), F.lit(False).alias("single")).distinct()
    keyed = docs.withColumn("__key", text_key())
    same = keyed["doc_id"].cast("long").eqNullSafe(F.col("kept_id")) & (keyed["__key"] == F.col("kept_key"))
    rows = keyed.join(words.unionByName(empty), same)
    first = F.row_number().over(Window.partitionBy("doc_id", "__key").orderBy("single"))
    return rows.withColumn("__first", first).filter("not single or __first = 1").select(*docs.columns)
