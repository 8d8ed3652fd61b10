"""Byte-level BPE by prefix dynamic programming, and its decoding.

The encoding of a text is settled by one value for each of its byte prefixes: the last token of that prefix's own
encoding. A token ending at a position is that value exactly when it does not react with the last token of the
prefix before it. The values of a prefix never change when bytes are appended, and behind an edit they soon fall
back into step, so appends and edits only recompute a part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from precinct.llm.common import binary_slices, chunks, held_state, ragged, text_buffers, tidy
from precinct.llm.pretokens import PieceTable, split_pieces

_SPAN = 1 << 20
# Bound of the memory for pairs that were judged already; it only saves time.
_JUDGED = 100_000
BATCH_BYTES = 1 << 19
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """The tokens of a rank file, the two parts that each was merged from, and which tokens may stand together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ids = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        # Every ending of a token with its own id, or -1 where it is none.
        self.endings = {token[i:]: -1 for token in ranks for i in range(1, len(token))} | ranks
        self.first_part = list(range(len(self.tokens)))
        self.last_part = list(range(len(self.tokens)))
        self.merged: dict[int, int] = {}
        self.judged: dict[int, bool] = {}
        for rank, token in enumerate(self.tokens):
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut], rank), ranks.get(token[cut:], rank)
                if left < rank and right < rank and self._stable(left, right):
                    self.first_part[rank], self.last_part[rank] = left, right
                    self.merged[left * _SPAN + right] = rank
                    break
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.lengths = lengths
        self.starts = np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def _stable(self, left: int, right: int) -> bool:
        """Whether no merge across the border of two tokens comes before the merges that made them.

        The later made of the two border tokens is taken apart, step by step; a merge across the border
        that ranks before that token would have been done instead.
        """
        before = _SPAN
        while True:
            across = self.merged.get(left * _SPAN + right)
            if across is not None and across < before:
                return False
            take_left = left > right
            part = self.last_part[left] if take_left else self.first_part[right]
            if part == (left if take_left else right):  # a single byte: the other one is taken apart
                take_left = not take_left
                part = self.last_part[left] if take_left else self.first_part[right]
                if part == (left if take_left else right):
                    return True
            if take_left:
                before, left = left, part
            else:
                before, right = right + 1, part

    def stable(self, left: int, right: int) -> bool:
        key = left * _SPAN + right
        known = self.judged.get(key)
        if known is None:
            if len(self.judged) >= _JUDGED:
                self.judged.clear()
            known = self.judged[key] = self._stable(left, right)
        return known

    def extend(self, piece: bytes, last: list[int], end: int | None = None) -> None:
        """Append the last tokens of the prefixes of ``piece`` that are longer than those in ``last``."""
        ending, judged, stable = self.endings.get, self.judged.get, self.stable
        for stop in range(len(last) + 1, (len(piece) if end is None else end) + 1):
            start = stop - 1
            found = []
            token = ending(piece[start:stop])
            while token is not None:
                if token >= 0:
                    found.append((start, token))
                if not start:
                    break
                start -= 1
                token = ending(piece[start:stop])
            for start, token in reversed(found):
                if not start:
                    last.append(token)
                    break
                before = last[start - 1]
                fits = judged(before * _SPAN + token)
                if stable(before, token) if fits is None else fits:
                    last.append(token)
                    break

    def backtrack(self, last: list[int]) -> list[int]:
        out, stop = [], len(last)
        while stop:
            out.append(last[stop - 1])
            stop -= len(self.tokens[out[-1]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern; a match that is a token itself is that token."""
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(piece, last)
        return self.backtrack(last)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """``encode_piece`` of each; in sorted order, the values of a common prefix are kept from piece to piece."""
        out: list[list[int]] = [[]] * len(pieces)
        before, last = b"", []
        for at in sorted(range(len(pieces)), key=pieces.__getitem__):
            piece = pieces[at]
            whole = self.ids.get(piece)
            if whole is not None:
                out[at] = [whole]
                continue
            same = 0
            for x, y in zip(before, piece):
                if x != y:
                    break
                same += 1
            del last[same:]
            self.extend(piece, last)
            before = piece
            out[at] = self.backtrack(last)
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids."""
        return self.bytes[ragged(self.starts[ids], self.lengths[ids])]


class PrefixTable:
    """The last token of each prefix of one piece: exact encodings of growing and edited pieces."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, piece, []
        vocabulary.extend(piece, self.last)
        self.longest = int(vocabulary.lengths.max(initial=1))

    def append(self, more: bytes) -> None:
        self.piece += more
        self.vocabulary.extend(self.piece, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of the bytes [start, stop); returns how many prefixes were computed anew.

        A value depends on as many bytes and values before it as the longest token has; after that many
        equal values in a row behind the edit, all later ones are equal as well.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.piece = self.piece[:start] + new + self.piece[stop:]
        last, same = old[:start], 0
        while len(last) < len(self.piece):
            at = len(last)
            self.vocabulary.extend(self.piece, last, at + 1)
            inside = at >= start + len(new)
            same = same + 1 if inside and last[at] == old[at - shift] else 0
            if same >= self.longest:
                done = len(last)
                last += old[done - shift :]
                self.last = last
                return done - start
        self.last = last
        return len(last) - start

    def ids(self) -> list[int]:
        return self.vocabulary.encode_piece(self.piece) if self.piece in self.vocabulary.ids else self.vocabulary.backtrack(self.last)


def _encoder(path: str) -> tuple[Vocabulary, PieceTable]:
    def make() -> tuple[Vocabulary, PieceTable]:
        vocabulary = Vocabulary(load_ranks(path))
        return vocabulary, PieceTable(vocabulary.encode_pieces)

    return held_state(("bpe", path), make)


def encode_batch(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all rows, the row offsets in them, and the bytes that the ids decode to.

    Pieces are looked up by a hash; as the decoded bytes are compared with the text, a row in which two
    pieces were taken for each other is encoded piece by piece instead.
    """
    vocabulary, table = _encoder(path)
    ids, bounds = table.encode(data, offsets)
    decoded = vocabulary.decode(ids)
    if len(decoded) == len(data) and np.array_equal(decoded, data):
        return ids, bounds, decoded
    rows = []
    for row in range(len(offsets) - 1):
        part = data[offsets[row] : offsets[row + 1]]
        own = ids[bounds[row] : bounds[row + 1]]
        if not np.array_equal(vocabulary.decode(own), part):
            begins = split_pieces(part, np.array([0, len(part)]))
            raw, ends = part.tobytes(), np.append(begins[1:], len(part)).tolist()
            pieces = [raw[a:b] for a, b in zip(begins.tolist(), ends)]
            own = np.array([i for piece in pieces for i in vocabulary.encode_piece(piece)], np.uint32)
        rows.append(own)
    ids = np.concatenate(rows)
    return ids, np.concatenate([[0], np.cumsum([len(r) for r in rows])]), vocabulary.decode(ids)


def encode(docs: DataFrame, path: str = VOCABULARY, text: str = "text", with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, and the ids themselves unless ``with_ids`` is off).

    One pass without a shuffle. A null text counts as empty and has no ids; repeated rows are encoded each for
    themselves; other columns are not read. ``ids`` is binary, little-endian unsigned 32-bit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for lo, hi in chunks(offsets, BATCH_BYTES):
                part = data[offsets[lo] : offsets[hi]]
                ids, bounds, decoded = encode_batch(path, part, offsets[lo : hi + 1] - offsets[lo])
                packed = ids.astype("<u4")
                raw, back = memoryview(packed).cast("B"), memoryview(decoded)
                sizes = np.concatenate([[0], np.cumsum(_encoder(path)[0].lengths[ids])])[bounds].tolist()
                cuts = (4 * bounds).tolist()
                n = hi - lo
                columns = [
                    batch.column(0).slice(lo, n),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([hashlib.sha256(raw[cuts[i] : cuts[i + 1]]).hexdigest() for i in range(n)], pa.string()),
                    pa.array([hashlib.sha256(back[sizes[i] : sizes[i + 1]]).hexdigest() for i in range(n)], pa.string()),
                ]
                if with_ids:
                    columns.append(binary_slices(packed, 4 * bounds))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return docs.select(docs["doc_id"].cast("long"), docs[text]).mapInArrow(tidy(run), schema)
