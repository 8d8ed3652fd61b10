"""Language-model scoring with a probabilistic suffix tree over words.

The nodes of the tree are contexts: the last one, two, ... words before a token. A context is looked at if it makes up a
fixed share of all training tokens, so a level of the tree has at most so many nodes at any size of the corpus, and the tree
travels to the tasks. What follows the contexts grows with the corpus and stays spread: a next-token distribution is
smoothed with that of the context without its oldest word, down to the add-one distribution of single tokens.

A context stays in the tree if its distribution diverges from its parent's in favour of what came: the sum of the
log ratios of both, each occurrence judged by the counts of all others, must be above zero. The contexts that lead to one
that stays do so, too. A token is scored in the state of the longest suffix of what is before it that the tree holds.

1. Texts become chunks of tokens. Distinct words are counted chunk by chunk, then level by level the contexts.
2. Each chunk asks once for its distinct pairs of context and next token, with its own training counts. Pairs meet
   by the next token, or by token and last word where both are frequent, so no task gets all of a hot word. There
   counts are summed up, each pair's share of its context's divergence is found, and the sums go back to the chunks.
3. With the contexts that stay, the chunks score their tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import chunks, give_back, mix64, ragged, shuffle_partitions, sorted_groups, text_buffers, tidy
from precinct.llm.minhash import word_hashes
from precinct.session import materialize

# A context makes up at least this share of the training tokens: at most 65,536 contexts of a length.
LEAST_SHARE = 2.0**-16
# Words of the longest contexts, and how many observations the distribution of the parent counts as, by length.
DEPTH, WEIGHTS = 3, (1024.0, 256.0, 64.0)
# Tokens of a chunk; bytes of text that are split into words at once.
CHUNK_TOKENS, BLOCK_BYTES = 1 << 21, 1 << 19
# Tokens of a chunk that are looked up at once: what is only needed for them does not grow with the chunk.
STEP = 1 << 18
# What stands before the first and behind the last word of a text; no word hash is special otherwise.
BEGIN, END = np.uint64(0x9D5C0FB3A1E24C67), np.uint64(0x3B7E151628AED2A6)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Divergences are summed as whole numbers of this fraction, so that no order of the sums matters.
_UNIT = float(1 << 24)


class Tree(NamedTuple):
    """Contexts by length: words by hash, longer ones by (place of the context without the oldest word, place of that word).

    ``keys`` are sorted; a context's place in them is its name. ``counts`` are the training tokens behind each, ``last``
    the place of its last word. ``kept`` is empty until the divergences are known.
    """

    tokens: int
    distinct: int
    words: np.ndarray
    word_counts: np.ndarray
    keys: list[np.ndarray]
    counts: list[np.ndarray]
    last: list[np.ndarray]
    kept: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.keys)

    def parent(self, level: int, places: np.ndarray) -> np.ndarray:
        return (self.keys[level][places] >> np.uint64(16)).astype(np.int64)

    def base(self, count: np.ndarray) -> np.ndarray:
        """The add-one probability of a token with ``count`` training occurrences."""
        return (count + 1.0) / (self.tokens + self.distinct + 1.0)

    def smoothed(self, level: int, places: np.ndarray, count: np.ndarray, parent: np.ndarray) -> np.ndarray:
        weight = WEIGHTS[min(level, len(WEIGHTS) - 1)]
        return (count + weight * parent) / (self.counts[level][places] + weight)

    def divergence(self, level: int, places: np.ndarray, count: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Sum over the ``count`` occurrences of log (smoothed probability without the occurrence / the parent's)."""
        weight = WEIGHTS[min(level, len(WEIGHTS) - 1)]
        others = self.counts[level][places] - 1.0 + weight
        return count * np.log(((count - 1.0) / parent + weight) / others)


def _place(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, -1 where it is not there."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order and the place of each value in them: ``np.unique`` with half of its memory."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    distinct = ordered[new]
    del ordered
    inverse = np.empty(len(values), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    return distinct, inverse


def _bytes_of(n: int) -> int:
    """Bytes, one at least, that every number below ``n`` fits into."""
    return max(1, -(-max(n - 1, 0).bit_length() // 8))


def _ranked_codes(code: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """``_ranked`` of numbers up to ``largest``, which are overwritten: number and place are sorted as one word where both fit."""
    bits = len(code).bit_length()
    if largest.bit_length() + bits > 63:
        return _ranked(code)
    for a in range(0, len(code), STEP):
        part = code[a : a + STEP]
        part <<= bits
        part |= np.arange(a, a + len(part))
    code.sort()
    order = np.empty(len(code), np.int32)
    for a in range(0, len(code), STEP):
        order[a : a + STEP] = code[a : a + STEP] & ((1 << bits) - 1)
    code >>= bits
    new = np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    distinct = code[new]
    del code
    places, inverse = np.cumsum(new, dtype=np.int32), np.empty(len(new), np.int32)
    places -= 1
    inverse[order] = places
    return distinct, inverse


# --- Small numbers: one byte each, larger ones behind ---


def pack_small(values: np.ndarray) -> bytes:
    large = values >= 255
    head = np.array([len(values)], "<u8").tobytes()
    return head + np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<u8").tobytes()


def unpack_small(raw: bytes) -> np.ndarray:
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    out = np.frombuffer(raw, np.uint8, n, 8).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, "<u8", -1, 8 + n)
    return out


# --- Chunks of tokens ---

# A chunk is some MB in one row: each is written, compressed and read as a row group of its own, or several would be held at once.
_ONE_BY_ONE = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false"}
_CHUNK = (
    "chunk long, n_train long, words binary, tokens binary, rows array<long>, doc_ids array<long>, held array<boolean>,"
    " sizes array<long>, skip array<long>"
)


def _blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, bool, bool]]:
    """(first row, last row, first byte, last byte, begins, ends): rows together, or a part of one long text."""
    for lo, hi in chunks(offsets, BLOCK_BYTES):
        a, b = int(offsets[lo]), int(offsets[hi])
        if b - a <= BLOCK_BYTES:
            yield lo, hi, a, b, True, True
            continue
        at = a
        while at < b:  # cut behind white space, or where the word that reaches over the block ends
            end = min(at + BLOCK_BYTES, b)
            if end < b:
                space = np.flatnonzero(_SPACE[data[at:end]])
                if len(space):
                    end = at + int(space[-1]) + 1
                else:
                    while end < b and not _SPACE[data[end]]:
                        end += 1
            yield lo, hi, at, end, at == a, end == b
            at = end


def token_chunks(docs: DataFrame, held_out: Column) -> DataFrame:
    """Tokens of all rows of ``docs`` (doc_id, text) as places in the chunk's list of distinct words.

    The lowest bytes of all places come first; no more bytes are stored for each than the largest needs.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, row = TaskContext.get().partitionId() << 32, 0, 0
        streams: list[np.ndarray] = []
        ids: list[tuple[int, int | None, bool]] = []
        sizes: list[int] = []
        skip: list[int] = []
        size = 0

        def flush(open_row: bool) -> Iterator[pa.RecordBatch]:
            """A chunk. Of a text that goes on, the next chunk begins with the words before."""
            nonlocal chunk, size
            stream = np.concatenate(streams)
            streams.clear()
            before = stream[len(stream) - min(DEPTH, sizes[-1]) :].copy() if open_row else stream[:0]
            words, inverse = _ranked(stream)
            del stream
            order = np.argsort(-np.bincount(inverse, minlength=len(words)), kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            planes = rank[inverse].astype("<u4").view(np.uint8).reshape(-1, 4).T[: _bytes_of(len(words))]
            train = sum(s - k for (_, _, held), s, k in zip(ids, sizes, skip) if not held)
            columns = [
                pa.array([part + chunk]), pa.array([train]), pa.array([words[order].astype("<u8").tobytes()], pa.binary()),
                pa.array([planes.tobytes()], pa.binary()), pa.array([[i for i, _, _ in ids]], pa.list_(pa.int64())),
                pa.array([[d for _, d, _ in ids]], pa.list_(pa.int64())), pa.array([[h for _, _, h in ids]], pa.list_(pa.bool_())),
                pa.array([sizes], pa.list_(pa.int64())), pa.array([skip], pa.list_(pa.int64())),
            ]
            last = ids[-1]
            chunk += 1
            ids.clear(), sizes.clear(), skip.clear()
            size = 0
            if open_row:
                streams.append(before)
                ids.append(last)
                sizes.append(len(before))
                skip.append(len(before))
            yield pa.RecordBatch.from_arrays(columns, names=[c.split(" ")[0] for c in _CHUNK.split(", ")])

        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            doc_ids, held = batch.column("doc_id").to_pylist(), batch.column("held").to_pylist()
            for lo, hi, a, b, begins, ends in _blocks(data, offsets):
                bounds = np.clip(offsets[lo : hi + 1], a, b) - a
                words, cuts = word_hashes(data[a:b], bounds)
                n = np.diff(cuts) + begins + ends
                ends_at = np.cumsum(n)
                stream = np.empty(int(ends_at[-1]), np.uint64)
                stream[ragged(ends_at - n + begins, np.diff(cuts))] = words
                if begins:
                    stream[ends_at - n] = BEGIN
                if ends:
                    stream[ends_at - 1] = END
                streams.append(stream)
                size += len(stream)
                if begins:
                    ids += [(part + row + k, doc_ids[lo + k], held[lo + k]) for k in range(hi - lo)]
                    row += hi - lo
                    sizes += n.tolist()
                    skip += [1] * (hi - lo)
                else:
                    sizes[-1] += int(n[0])
                if size >= CHUNK_TOKENS:
                    yield from flush(not ends)
        if ids:
            yield from flush(False)

    return rows.mapInArrow(tidy(run), _CHUNK)


class _Chunk:
    """A stored chunk: words, tokens as places in them, and of each token whether it counts and where its text begins.

    What there is for each token has four bytes or less: a worker has some of these beside the chunk's Arrow batch.
    """

    def __init__(self, row: dict):
        self.words = np.frombuffer(row["words"], "<u8")
        self.sizes = np.array(row["sizes"], np.int64)
        planes = np.frombuffer(row["tokens"], np.uint8).reshape(-1, int(self.sizes.sum()))
        self.tokens = np.zeros(planes.shape[1], "<i4")
        self.tokens.view(np.uint8).reshape(-1, 4)[:, : len(planes)] = planes.T
        starts = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)
        self.back = np.arange(len(self.tokens), dtype=np.int32) - np.repeat(starts, self.sizes)  # tokens before it in its text
        self.scored = self.back >= np.repeat(np.array(row["skip"], np.int32), self.sizes)
        self.train = self.scored & ~np.repeat(np.array(row["held"], bool), self.sizes)

    def rows(self) -> np.ndarray:
        """The row of each token."""
        return np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)

    def by_text(self, value: Callable[[np.ndarray], np.ndarray | float]) -> np.ndarray:
        """The sum of ``value`` over the scored tokens of each text, added up in their order; some tokens are asked for at once."""
        out, rows = np.zeros(len(self.sizes)), self.rows()
        for a in range(0, len(rows), STEP):
            at = a + np.flatnonzero(self.scored[a : a + STEP])
            np.add.at(out, rows[at], value(at))
        return out

    def word_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the words; BEGIN is not scored but counted as a context, once for each text."""
        counts = np.bincount(self.tokens[self.train], minlength=len(self.words))
        begin = np.flatnonzero(self.words == BEGIN)
        if len(begin):
            first = self.train & (self.back == 1) & (np.roll(self.tokens, 1) == begin[0])
            counts[begin[0]] = np.count_nonzero(first)
        return self.words, counts

    def _before(self, tree: Tree, level: int) -> np.ndarray:
        """The place of the word ``level + 1`` tokens before each token, -1 where it is none of the tree's."""
        frequent = _place(tree.words, self.words).astype(np.int32)[self.tokens]
        before = np.full(len(self.tokens), -1, np.int32)
        before[level + 1 :] = frequent[: len(frequent) - level - 1]
        before[self.back <= level] = -1
        return before

    def levels(self, tree: Tree) -> Iterator[np.ndarray]:
        """For one length after the other the place of the context of each token, -1 where there is none."""
        now = self._before(tree, 0)
        yield now
        for level in range(1, tree.depth):
            before = self._before(tree, level)
            found = np.full(len(now), -1, np.int32)
            for a in range(0, len(now), STEP):
                known = a + np.flatnonzero((now[a : a + STEP] >= 0) & (before[a : a + STEP] >= 0))
                found[known] = _place(tree.keys[level], ((now[known].astype(np.int64) << 16) | before[known]).astype(np.uint64))
            now = found
            del before, found
            yield now

    def contexts(self, tree: Tree) -> list[np.ndarray]:
        """The contexts of all lengths at once."""
        return list(self.levels(tree))

    def longer(self, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the contexts that are one word longer than the tree's longest, and the training tokens behind them."""
        for now in self.levels(tree):
            pass
        before = self._before(tree, tree.depth)
        good = self.train & (now >= 0) & (before >= 0)
        return np.unique(((now[good].astype(np.int64) << 16) | before[good]).astype(np.uint64), return_counts=True)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Each row; what is binary stays where it is in the batch."""
    for batch in batches:
        for k in range(batch.num_rows):
            values = {name: batch.column(name)[k] for name in batch.schema.names}
            yield {name: v.as_buffer() if isinstance(v, pa.BinaryScalar) else v.as_py() for name, v in values.items()}


# --- Frequent words and contexts ---


def _summed(found: DataFrame, counted: Callable[[_Chunk], tuple[np.ndarray, np.ndarray]], least: float, buckets: int) -> DataFrame:
    """(key, n, distinct): all keys with ``least`` or more training tokens, and rows without a key that count the others."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys, counts = counted(_Chunk(row))
            keys, counts = keys[counts > 0], counts[counts > 0]
            bucket = (mix64(keys) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((keys, bucket))
            keys, counts, bucket = keys[order], counts[order], bucket[order]
            cuts = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(bucket)]
            columns = [
                pa.array([int(bucket[a]) for a in cuts[:-1]], pa.int32()),
                pa.array([keys[a:b].astype("<u8").tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                pa.array([pack_small(counts[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["bucket"]):
            keys = np.concatenate([np.frombuffer(k.as_buffer(), "<u8") for c in group.column("keys").chunks for k in c])
            counts = np.concatenate([unpack_small(k) for k in group.column("counts").to_pylist()])
            keys, inverse = np.unique(keys, return_inverse=True)
            counts = np.bincount(inverse, weights=counts).astype(np.int64)
            often = counts >= least
            n = int(often.sum())
            columns = [
                pa.array([*keys[often].astype(np.int64).tolist(), None], pa.int64()),
                pa.array([*counts[often].tolist(), None], pa.int64()),
                pa.array([*[None] * n, int((keys != BEGIN).sum())], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "distinct"])

    packed = found.mapInArrow(tidy(part), "bucket int, keys binary, counts binary")
    rows = packed.repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(tidy(total), "key long, n long, distinct long")


def _collected(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys in order with their numbers: no more than one for each LEAST_SHARE of the corpus; and how many keys there are in all."""
    found = rows.collect()
    keys = np.array([r["key"] for r in found if r["key"] is not None], np.int64).astype(np.uint64)
    counts = np.array([r["n"] for r in found if r["key"] is not None], np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order], sum(r["distinct"] for r in found if r["distinct"] is not None)


def learn_contexts(found: DataFrame, depth: int = DEPTH, share: float = LEAST_SHARE) -> Tree:
    """The contexts of up to ``depth`` words that make up ``share`` of the training tokens of the chunks ``found``."""
    buckets = 4 * shuffle_partitions(found.sparkSession)
    tokens = int(found.agg(F.sum("n_train")).first()[0] or 0)
    least = max(1.0, share * tokens)
    words, counts, distinct = _collected(_summed(found, _Chunk.word_counts, least, buckets))
    here = np.arange(len(words))
    tree = Tree(tokens, distinct, words, counts, [words], [counts], [here], [])
    for _ in range(1, depth):
        keys, counts, _ = _collected(_summed(found, lambda chunk, tree=tree: chunk.longer(tree), least, buckets))
        last = tree.last[-1][(keys >> np.uint64(16)).astype(np.int64)]
        tree = tree._replace(keys=[*tree.keys, keys], counts=[*tree.counts, counts], last=[*tree.last, last])
    return tree


# --- Pairs of context and next token ---


class _Pairs:
    """The distinct pairs of a chunk by length of the context, in the order in which buckets are asked for them.

    ``rare`` next tokens are named by their hash, frequent ones by their place in the tree. One length is looked at at a time,
    with the contexts that the chunk gives for it.
    """

    def __init__(self, chunk: _Chunk, tree: Tree, buckets: int):
        self.chunk, self.tree, self.buckets = chunk, tree, buckets
        place = _place(tree.words, chunk.words)
        self.place = place
        # Rare words come in the order of their buckets.
        rare = np.flatnonzero(place < 0)
        home = (mix64(chunk.words) % np.uint64(buckets)).astype(np.int64)
        self.rare = rare[np.lexsort((chunk.words[rare], home[rare]))]
        self.rare_cuts = np.searchsorted(home[self.rare], np.arange(buckets + 1))
        self.order_of = np.full(len(chunk.words), -1, np.int64)
        self.order_of[self.rare] = np.arange(len(self.rare))

    def asked(self, contexts: np.ndarray) -> np.ndarray:
        """The tokens that are scored and have a context of this length."""
        return np.flatnonzero(self.chunk.scored & (contexts >= 0)).astype(np.int32)

    def codes(self, contexts: np.ndarray, asked: np.ndarray) -> np.ndarray:
        out = self.chunk.tokens[asked].astype(np.int64)
        out <<= 16
        out |= contexts[asked]
        return out

    def order(self, level: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct codes the frequent ones, their buckets, the rare ones, and the rare word that each of these is of."""
        word, context = code >> 16, code & 0xFFFF
        often = self.place[word] >= 0
        f, r = np.flatnonzero(often), np.flatnonzero(~often)
        pair = (self.place[word[f]] << 16) | context[f]
        met = mix64(((self.place[word[f]] << 32) | self.tree.last[level][context[f]]).astype(np.uint64))
        bucket = (met % np.uint64(self.buckets)).astype(np.int32)
        by = np.lexsort((pair, bucket))
        r = r[np.lexsort((context[r], self.order_of[word[r]]))]
        return f[by], bucket[by], r, self.order_of[word[r]]

    def questions(self, level: int, contexts: np.ndarray) -> dict[str, np.ndarray]:
        """The distinct pairs with their training counts, and where each bucket's begin."""
        asked = self.asked(contexts)
        code = self.codes(contexts, asked)
        code <<= 1
        code |= self.chunk.train[asked]
        del asked
        code.sort()
        new = np.ones(len(code), bool)
        np.greater(code[1:] ^ code[:-1], 1, out=new[1:])  # equal but for the lowest bit: the same pair
        first = np.flatnonzero(new)
        del new
        counts = np.add.reduceat(code & 1, first) if len(first) else np.zeros(0, np.int64)
        code = code[first] >> 1
        f, bucket, r, owner = self.order(level, code)
        return {
            "pair": ((self.place[code[f] >> 16] << 16) | (code[f] & 0xFFFF)).astype("<u4"), "pair_count": counts[f].astype(np.int32),
            "pair_cuts": np.searchsorted(bucket, np.arange(self.buckets + 1)),
            "context": (code[r] & 0xFFFF).astype("<u2"), "rare_count": counts[r].astype(np.int32),
            "rare_cuts": np.searchsorted(owner, self.rare_cuts), "spans": np.bincount(owner, minlength=len(self.rare)),
        }


_ASK = (
    "bucket int, chunk long, pairs array<binary>, pair_counts array<binary>, words binary, known binary,"
    " spans array<binary>, contexts array<binary>, context_counts array<binary>"
)
_BYTES, _LISTS = pa.binary(), pa.list_(pa.binary())


def _asked(found: DataFrame, tree: Tree, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = _Chunk(row)
            pairs = _Pairs(chunk, tree, buckets)
            levels = [pairs.questions(level, contexts) for level, contexts in enumerate(chunk.levels(tree))]
            hashes = chunk.words[pairs.rare].astype("<u8")
            known = np.bincount(chunk.tokens[chunk.train], minlength=len(chunk.words))[pairs.rare]
            cuts = pairs.rare_cuts
            out: list[list] = []
            for b in range(buckets):
                w = slice(cuts[b], cuts[b + 1])
                fs = [slice(x["pair_cuts"][b], x["pair_cuts"][b + 1]) for x in levels]
                rs = [slice(x["rare_cuts"][b], x["rare_cuts"][b + 1]) for x in levels]
                if w.start == w.stop and all(f.start == f.stop for f in fs):
                    continue
                out.append(
                    [
                        b, row["chunk"],
                        [x["pair"][f].tobytes() for x, f in zip(levels, fs)],
                        [pack_small(x["pair_count"][f]) for x, f in zip(levels, fs)],
                        hashes[w].tobytes(), pack_small(known[w]),
                        [pack_small(x["spans"][w]) for x in levels],
                        [x["context"][r].tobytes() for x, r in zip(levels, rs)],
                        [pack_small(x["rare_count"][r]) for x, r in zip(levels, rs)],
                    ]
                )
            if out:
                columns = [pa.array(list(c), t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    types = [pa.int32(), pa.int64(), _LISTS, _LISTS, _BYTES, _BYTES, _LISTS, _LISTS, _LISTS]
    names = [c.split(" ")[0] for c in _ASK.split(", ")]
    return found.select("chunk", "words", "tokens", "held", "sizes", "skip").mapInArrow(tidy(run), _ASK)


class _Divergences:
    """Sums of the divergences of all contexts, in whole units."""

    def __init__(self, tree: Tree):
        self.tree = tree
        self.sums = [np.zeros(len(k), np.int64) for k in tree.keys]

    def add(self, names: list[np.ndarray], counts: list[np.ndarray], base: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
        """Sums of the counts of equal names (next token << 16 | context) by length, for each name; ``base`` by next token."""
        out, before, chances = [], None, None
        for level, (name, count) in enumerate(zip(names, counts)):
            name, inverse = np.unique(name, return_inverse=True)
            total = np.bincount(inverse, weights=count, minlength=len(name)).astype(np.int64)
            out.append(total[inverse])
            token, context = name >> 16, name & 0xFFFF
            if level:
                parent = chances[np.searchsorted(before, (token << 16) | self.tree.parent(level, context))]
            else:
                parent = base(token)
            seen = total > 0
            share = self.tree.divergence(level, context[seen], total[seen].astype(float), parent[seen])
            np.add.at(self.sums[level], context[seen], np.rint(share * _UNIT).astype(np.int64))
            before, chances = name, self.tree.smoothed(level, context, total.astype(float), parent)
        return out


_ANSWER = "chunk long, bucket int, pairs array<binary>, known binary, contexts array<binary>, level int, context int, divergence long"


def _answered(asked: DataFrame, tree: Tree) -> DataFrame:
    """For each question the sums of all chunks, and the task's part of the divergence of each context."""
    depth = tree.depth

    def parts_of(column: pa.ChunkedArray, level: int, read: Callable[[bytes], np.ndarray]) -> list[np.ndarray]:
        return [read(lists[level]) for lists in column.to_pylist()]

    def cut(values: np.ndarray, parts: list[np.ndarray]) -> list[bytes]:
        ends = np.cumsum([0, *map(len, parts)]).tolist()
        return [pack_small(values[a:b]) for a, b in zip(ends, ends[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Divergences(tree)
        for group in sorted_groups(batches, ["bucket"]):
            n = group.num_rows
            parts = [parts_of(group.column("pairs"), k, lambda raw: np.frombuffer(raw, "<u4").astype(np.int64)) for k in range(depth)]
            counts = [np.concatenate(parts_of(group.column("pair_counts"), k, unpack_small)) for k in range(depth)]
            totals = sums.add([np.concatenate(p) for p in parts], counts, lambda token: tree.base(tree.word_counts[token]))
            pairs = [cut(t, p) for t, p in zip(totals, parts)]

            word_parts = [np.frombuffer(raw, "<u8") for raw in group.column("words").to_pylist()]
            words, number = np.unique(np.concatenate(word_parts), return_inverse=True)
            known = np.concatenate([unpack_small(raw) for raw in group.column("known").to_pylist()])
            known = np.bincount(number, weights=known, minlength=len(words)).astype(np.int64)
            names, parts = [], []
            for k in range(depth):
                own = parts_of(group.column("contexts"), k, lambda raw: np.frombuffer(raw, "<u2").astype(np.int64))
                spans = np.concatenate(parts_of(group.column("spans"), k, unpack_small))
                names.append((np.repeat(number, spans) << 16) | np.concatenate(own))
                parts.append(own)
            counts = [np.concatenate(parts_of(group.column("context_counts"), k, unpack_small)) for k in range(depth)]
            totals = sums.add(names, counts, lambda token: tree.base(known[token]))
            contexts = [cut(t, p) for t, p in zip(totals, parts)]
            columns = [
                group.column("chunk").combine_chunks(), group.column("bucket").combine_chunks(), pa.array([list(x) for x in zip(*pairs)], _LISTS),
                pa.array(cut(known[number], word_parts), _BYTES), pa.array([list(x) for x in zip(*contexts)], _LISTS),
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names_out)
        for level, own in enumerate(sums.sums):
            context = np.flatnonzero(own)
            if len(context):
                n = len(context)
                columns = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), _LISTS, _BYTES, _LISTS)]
                columns += [pa.array(np.full(n, level, np.int32)), pa.array(context, pa.int32()), pa.array(own[context])]
                yield pa.RecordBatch.from_arrays(columns, names=names_out)

    names_out = [c.split(" ")[0] for c in _ANSWER.split(", ")]
    return asked.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(tidy(run), _ANSWER)


def _with_kept(tree: Tree, answers: DataFrame) -> Tree:
    """The tree with the contexts that stay: those with a divergence above zero, and their parents."""
    sums = answers.filter("level is not null").groupBy("level", "context").agg(F.sum("divergence").alias("d"))
    kept = [np.zeros(len(k), bool) for k in tree.keys]
    for r in sums.filter("d > 0").collect():  # bounded like the tree
        kept[r["level"]][r["context"]] = True
    for level in range(tree.depth - 1, 0, -1):
        kept[level - 1][tree.parent(level, np.flatnonzero(kept[level]))] = True
    return tree._replace(kept=kept)


_SCORES = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score_chunk(row: dict, got: list[dict], tree: Tree, buckets: int) -> pa.Table:
    """The ``_SCORES`` of each part of a text in a chunk; ``got`` are the answers to it in the order of their buckets."""
    chunk = _Chunk(row)
    pairs = _Pairs(chunk, tree, buckets)
    count = np.where(pairs.place >= 0, tree.word_counts[pairs.place] if len(tree.words) else 0, 0)
    count[pairs.rare] = np.concatenate([unpack_small(a["known"]) for a in got])
    chance = tree.base(count)[chunk.tokens]
    tokens, known = chunk.by_text(lambda at: 1.0), chunk.by_text(lambda at: (count > 0)[chunk.tokens[at]])
    base = chunk.by_text(lambda at: np.log10(chance[at]))
    score = chance.copy()
    for level, contexts in enumerate(chunk.levels(tree)):
        at = pairs.asked(contexts)
        code, inverse = _ranked_codes(pairs.codes(contexts, at), len(chunk.words) << 16)
        frequent, _, rare, _ = pairs.order(level, code)
        total = np.zeros(len(code), np.int64)
        total[frequent] = np.concatenate([unpack_small(a["pairs"][level]) for a in got])
        total[rare] = np.concatenate([unpack_small(a["contexts"][level]) for a in got])
        for a in range(0, len(at), STEP):
            part = at[a : a + STEP]
            context = contexts[part]
            chance[part] = tree.smoothed(level, context, total[inverse[a : a + STEP]].astype(float), chance[part])
            state = part[tree.kept[level][context]]
            score[state] = chance[state]
        del at, code, inverse, frequent, rare, total
    del chance, pairs
    columns = [
        pa.array(row["rows"], pa.int64()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()),
        pa.array(tokens.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base),
        pa.array(chunk.by_text(lambda at: np.log10(score[at]))),
    ]
    return pa.table(columns, names=[c.split(" ")[0] for c in _SCORES.split(", ")])


def _scored(found: DataFrame, answers: DataFrame, tree: Tree, buckets: int) -> DataFrame:
    """``_SCORES`` of each part of a text in a chunk.

    A chunk meets its answers as a group of its own, so a worker has one chunk at a time and no row holds both.
    """

    def run(chunk: pa.Table, got: pa.Table) -> pa.Table:
        give_back()  # what the chunk before has left
        own = got.select(["pairs", "known", "contexts"]).take(pc.sort_indices(got.column("bucket")))
        return pa.concat_tables([score_chunk(row, own.to_pylist(), tree, buckets) for row in _rows(chunk.to_batches())])

    replies = answers.filter("chunk is not null").select("chunk", "bucket", "pairs", "known", "contexts")
    return found.drop("n_train").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, _SCORES)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id's text, modulo 7, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_documents(docs: DataFrame, held: Column, depth: int = DEPTH, share: float = LEAST_SHARE) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text).

    A tree is learned from the rows that are not ``held``; scores are log10 probabilities of all tokens of a text. Words
    are lower-cased (A-Z), white space parts them, and each text ends with a token of its own. A null or empty text has that
    one alone; repeated rows count and are scored each for themselves; without training rows every token has probability
    one. Words are told apart by 64-bit hashes. Other columns are not read. Scores do not depend on the chunks, but
    for the last bits of a text that lies in two.
    """
    spark = docs.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    found = materialize(token_chunks(docs, held), "token-chunks", **_ONE_BY_ONE)
    tree = learn_contexts(found, depth, share)
    answers = materialize(_answered(_asked(found, tree, buckets), tree), "pair-counts")
    parts = _scored(found, answers, _with_kept(tree, answers), buckets)
    # A long text is in several chunks.
    return parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.lit(tree.tokens).cast("long").alias("train_tokens"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score"),
    ).drop("row")
