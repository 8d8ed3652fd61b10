"""Mixing sources to target weights by fixed-length blocks.

The words of a source, in doc_id order, are cut into blocks of equal length. Every source gets as many slots of the
mix as its target asks for. Output shards draw their counts of slots for each source: multinomial draws given the
sums over all shards, so the mix as a whole meets the targets. The slots of a source are numbered through; a pseudo-
random permutation of its block numbers, another one for each pass over the source, says which block a slot holds.
Slots and blocks meet in a join on (source, block).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precinct.llm.common import chunks, mix64, ordered_buckets, running_sums, shuffle_partitions, text_buffers, tidy
from precinct.llm.minhash import text_key, word_places
from precinct.session import materialize

BLOCK_WORDS = 64
SHARD_SLOTS = 8192
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[int], most: float = MOST_REPEATS) -> list[float]:
    """Shares of the sum of ``sizes`` in proportion to ``weights``, none above ``most`` times its size.

    What a source cannot take is shared by weight among the others until none is above.
    """
    out = [0.0] * len(sizes)
    left, open_ = float(sum(sizes)), list(range(len(sizes)))
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] > most * sizes[i] * weight]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudo-random permutation of 0 .. n-1, one for each ``key``, applied to ``index``.

    Four Feistel rounds permute the next power of four; numbers that leave the range are permuted again.
    """
    bits = np.maximum(np.ceil(np.log2(np.maximum(n, 2)) / 2).astype(np.uint64), np.uint64(1))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    n, out = n.astype(np.uint64), index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        b, m, k = bits[todo], mask[todo], key[todo]
        left, right = out[todo] >> b, out[todo] & m
        for step in range(4):
            left, right = right, left ^ (mix64(right + k + np.uint64(step * 0x51ED2701)) & m)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _draw(rng: np.random.Generator, left: np.ndarray, sizes: list[int]) -> Iterator[np.ndarray]:
    """Counts by source for parts of the given sizes, which together use up ``left``.

    The counts of a part are a multinomial draw with the shares of what is left, one binomial for each source; a count stays
    within what is left of its source and what the sources behind it can still fill.
    """
    left = left.copy()
    for size in sizes:
        counts, rest, total = np.zeros_like(left), size, int(left.sum())
        for i, n in enumerate(left.tolist()):
            behind = total - n
            if rest > 0 and n > 0:
                counts[i] = min(max(int(rng.binomial(rest, n / total)), rest - behind), n)
            rest -= int(counts[i])
            total = behind
        left -= counts
        yield counts


def slots(
    spark, blocks: list[int], wanted: list[int], shard_slots: int = SHARD_SLOTS, seed: int = 1
) -> DataFrame:
    """(shard, slot, source_no, block): what each slot of each shard holds.

    ``blocks`` and ``wanted`` are the blocks and slots of each source. The shards are drawn in two levels, groups
    of shards first, so the driver draws about the square root of their number.
    """
    total = sum(wanted)
    shards = max(1, -(-total // shard_slots))
    group = max(1, math.isqrt(shards))
    sizes = [min(group * shard_slots, total - at) for at in range(0, total, group * shard_slots)]
    used = np.zeros(len(wanted), np.int64)
    rows = []
    for number, counts in enumerate(_draw(np.random.default_rng(seed), np.array(wanted, np.int64), sizes)):
        rows.append((number, counts.tolist(), used.tolist()))
        used += counts
    groups = spark.createDataFrame(rows, "part int, counts array<long>, used array<long>")
    n_blocks = np.array(blocks, np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, counts, used in zip(batch["part"], batch["counts"], batch["used"]):
                counts, used = np.asarray(counts, np.int64), np.array(used, np.int64)
                total = int(counts.sum())
                sizes = [min(shard_slots, total - at) for at in range(0, total, shard_slots)]
                rng = np.random.default_rng([seed, int(part)])
                for k, drawn in enumerate(_draw(rng, counts, sizes)):
                    source = np.repeat(np.arange(len(drawn)), drawn)
                    number = np.arange(len(source)) - np.repeat(np.cumsum(drawn) - drawn, drawn) + used[source]
                    used += drawn
                    n = n_blocks[source]
                    key = mix64((number // n).astype(np.uint64) * np.uint64(1_000_003) + source.astype(np.uint64) + np.uint64(seed << 40))
                    block = permuted(number % n, n, key)
                    slot = np.empty(len(source), np.int64)
                    slot[rng.permutation(len(source))] = np.arange(len(source))
                    yield pd.DataFrame({"shard": int(part) * group + k, "slot": slot, "source_no": source, "block": block})

    return groups.repartition(max(1, min(len(rows), shuffle_partitions(spark))), "part").mapInPandas(
        tidy(run), "shard long, slot long, source_no int, block long"
    )


class Mix:
    """The mix of ``docs`` (doc_id, source, and ``size``, a count of words).

    Sources stand in code point order with null last and get the weights 1, 2, 3 in turn; their number is what
    the driver holds. ``documents`` has doc_id, source, size, source_size, target and ``row``, a number that tells
    repeated rows apart; ``pieces`` has one row for each block and document in it (source_no, block, row, doc_id,
    first_word, words); ``slots`` has one for each slot. Documents without words belong to no block. Rows are
    ordered by doc_id, null last, then by size. ``carry`` names more columns that tell rows apart.
    """

    def __init__(self, docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 1,
                 carry: tuple[str, ...] = ()):
        spark, self.carry = docs.sparkSession, carry
        light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("size").cast("long").alias("size"), *carry)
        light, _ = ordered_buckets(light, "doc_id", 4 * shuffle_partitions(spark))
        light = materialize(light, "mix-sizes")
        found = light.groupBy("source").agg(F.sum("size").alias("size")).collect()
        found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        sizes = [r["size"] for r in found]
        aims = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))])
        blocks = [-(-s // block_words) for s in sizes]
        wanted = [min(round(t * n / s), MOST_REPEATS * n) if s else 0 for t, n, s in zip(aims, blocks, sizes)]
        names = spark.createDataFrame(
            [(i, r["source"], r["size"], t) for i, (r, t) in enumerate(zip(found, aims))],
            "source_no int, name string, source_size long, target double",
        )
        self.source_sizes, self.targets, self.wanted = sizes, aims, wanted
        numbered = light.join(names, F.col("source").eqNullSafe(F.col("name"))).drop("name")
        order = [F.col("doc_id").asc_nulls_last(), F.col("size"), *carry]
        placed = running_sums(
            numbered, ["source_no"], "bucket", order, {"start": F.col("size"), "number": F.lit(1).cast("long")}
        )
        # The number of a row among those of its source, made unique over all sources.
        row = F.col("number") * F.lit(max(len(sizes), 1)) + F.col("source_no")
        self.documents = materialize(
            placed.select("doc_id", "source", "source_no", "size", "source_size", "target", "start", row.alias("row"), *carry), "mix-documents"
        )
        first, last = F.col("start"), F.col("start") + F.col("size") - 1
        length = F.lit(block_words)
        covered = F.sequence(F.floor(first / length), F.floor(last / length))
        pieces = self.documents.filter("size > 0").select("source_no", "doc_id", "row", "start", "size", F.explode(covered).alias("block"))
        begin = F.greatest(F.col("block") * length, first)
        end = F.least((F.col("block") + 1) * length, last + 1)
        self.pieces = pieces.select(
            "source_no", "block", "row", "doc_id", (begin - first).alias("first_word"), (end - begin).alias("words")
        )
        self.slots = slots(spark, blocks, wanted, shard_slots, seed)

    def spans(self) -> DataFrame:
        """(shard, slot, source_no, block, row, doc_id, first_word, words): the words that the mix takes."""
        return self.slots.join(self.pieces, ["source_no", "block"])

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) of every document; taken counts repeats."""
        # A block is read once, with the number of slots that hold it.
        drawn = self.slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
        sums = self.pieces.join(drawn, ["source_no", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        out = self.documents.join(sums, "row", "left")
        return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def row_spans(self) -> DataFrame:
        """(doc_id, the carried columns, spans): for rows with taken words, their spans (first_word, words, times)."""
        drawn = self.slots.groupBy("source_no", "block").agg(F.count("*").cast("int").alias("times"))
        spans = self.pieces.join(drawn, ["source_no", "block"]).groupBy("row").agg(
            F.collect_list(F.struct("first_word", "words", "times")).alias("spans")
        )
        return self.documents.select("row", "doc_id", *self.carry).join(spans, "row").drop("row")


def span_texts(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns of ``rows`` and, as ``text``, the words of ``spans`` in their order, each span as often as it was drawn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in chunks(offsets):
                part = batch.slice(lo, hi - lo)
                own = data[offsets[lo] : offsets[hi]]
                raw = memoryview(own)
                starts, ends, bounds = word_places(own, offsets[lo : hi + 1] - offsets[lo])
                texts = []
                for row, spans in enumerate(part.column("spans").to_pylist()):
                    parts = []
                    for span in sorted(spans, key=lambda s: s["first_word"]):
                        a = bounds[row] + span["first_word"]
                        words = bytes(raw[starts[a] : ends[a + span["words"] - 1]])
                        parts += [words] * span["times"]
                    texts.append(b"\n".join(parts).decode())
                columns = [part.column(c) for c in keep] + [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text"])

    types = dict(rows.dtypes)
    return rows.select(*keep, "text", "spans").mapInArrow(tidy(run), "".join(f"`{c}` {types[c]}, " for c in keep) + "text string")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, n_chars) as the mix has them: of each document the words that it takes, repeats
    included. Documents of which it takes none go; rows that repeat doc_id and text become one.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", text_key())
    mix = Mix(keyed.withColumn("size", word_count(F.col("text"))), carry=("text_key",))
    spans = mix.row_spans().groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    once = F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy("source", "lang"))
    rows = keyed.withColumn("copy", once).filter("copy = 1").drop("copy")
    spans = spans.select(F.col("doc_id").alias("id"), F.col("text_key").alias("own_key"), "spans")
    rows = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("own_key")))
    out = span_texts(rows, "doc_id", "lang", "source")
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
