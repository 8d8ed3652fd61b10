"""Language identification by cross-parsing: how few phrases of a language's reference text make up a document.

For each language a suffix automaton of labelled text finds the longest match at each point of a document; a phrase is
such a match, and the next one begins behind it. Phrases, weighted by what a pointer into the reference costs, estimate
the cross entropy; the language with the least wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import chunks, held_state, ragged, text_buffers, tidy

UNKNOWN = "und"
# Bounds of what is learned of a language, and the defaults of ``learn``: so many whole documents, of so many bytes in all.
SAMPLE_DOCUMENTS, REFERENCE_BYTES = 64, 16384
# A document is parsed in segments of this many symbols, all of them side by side.
SEGMENT = 1024
BATCH_BYTES = 1 << 20
LETTER = r"\p{L}"


def normalized(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and bytes of wider characters stay (in lower case), every run of other ASCII becomes one blank."""
    kept = (data >= 0x80) | ((data | 0x20) >= ord("a")) & ((data | 0x20) <= ord("z"))
    out = np.where(kept, np.where(data < 0x80, data | 0x20, data), 0x20).astype(np.uint8)
    repeated = np.zeros(len(data), bool)
    repeated[1:] = ~kept[1:] & ~kept[:-1]
    repeated[offsets[:-1][offsets[:-1] < len(data)]] = False
    places = np.concatenate([[0], np.cumsum(~repeated)])
    return out[~repeated], places[offsets]


class SuffixAutomaton:
    """All substrings of a byte string, as a list of transitions of each state; state 0 is the empty string."""

    def __init__(self, text: bytes):
        self.next: list[dict[int, int]] = [{}]
        length, link, last = [0], [-1], 0
        for byte in text:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and byte not in self.next[at]:
                self.next[at][byte] = new
                at = link[at]
            if at >= 0:
                target = self.next[at][byte]
                if length[at] + 1 == length[target]:
                    link[new] = target
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[target]))
                    length.append(length[at] + 1)
                    link.append(link[target])
                    while at >= 0 and self.next[at].get(byte) == target:
                        self.next[at][byte] = copy
                        at = link[at]
                    link[target] = link[new] = copy
            last = new


class CrossParser:
    """Counts the phrases of many texts in several references at once.

    The automata become one table: entry (state, symbol) is the next state, or, where a phrase cannot be
    continued, the state after a new phrase began with the symbol, marked by a negative number. A symbol that a reference
    does not have is a phrase of its own and leads to a state from which nothing can be continued.
    """

    def __init__(self, references: tuple[tuple[str, bytes], ...]):
        self.languages = [name for name, _ in references]
        self.cost = np.array([np.log2(len(text) + 2.0) for _, text in references])
        used = sorted(set(b"".join(text for _, text in references)))
        self.symbol = np.zeros(256, np.uint8)
        self.symbol[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        tables, self.start, base = [], [], 0
        for _, text in references:
            states = SuffixAutomaton(text).next
            dead = len(states)
            fresh = np.full(width, dead, np.int64)
            for byte, target in states[0].items():
                fresh[self.symbol[byte]] = target
            table = np.tile(~(base + fresh * width), (dead + 1, 1))
            rows = np.repeat(np.arange(dead), [len(s) for s in states])
            columns = self.symbol[[b for s in states for b in s]]
            table[rows, columns] = base + np.array([t for s in states for t in s.values()], np.int64) * width
            tables.append(table.astype(np.int32).reshape(-1))
            self.start.append(base + dead * width)
            base += (dead + 1) * width
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(rows, languages) numbers of phrases of normalized texts."""
        rows, sizes = len(offsets) - 1, np.diff(offsets)
        parts = -(-sizes // SEGMENT)
        row = np.repeat(np.arange(rows), parts)
        number = ragged(np.zeros(rows, np.int64), parts)
        begin = offsets[:-1][row] + number * SEGMENT
        length = np.minimum(SEGMENT, offsets[1:][row] - begin)
        order = np.argsort(-length, kind="stable")
        begin, length, row = begin[order], length[order], row[order]
        symbols = self.symbol[data].astype(np.int32)
        state = np.repeat(np.array(self.start, np.int32)[:, None], len(begin), axis=1)
        count = np.zeros(state.shape, np.int32)
        for step in range(int(length[0]) if len(length) else 0):
            active = int(np.searchsorted(-length, -step, "left"))  # segments longer than the steps so far
            found = self.table[state[:, :active] + symbols[begin[:active] + step]]
            broken = found >> 31  # -1 where a phrase ended
            count[:, :active] -= broken
            state[:, :active] = found ^ broken
        out = np.zeros((rows, len(self.languages)), np.int64)
        np.add.at(out, row, count.T)
        return out


def _parser(references: tuple[tuple[str, bytes], ...]) -> CrossParser:
    return held_state(("language", references), lambda: CrossParser(references))


def learn(
    labelled: DataFrame, documents: int = SAMPLE_DOCUMENTS, reference_bytes: int = REFERENCE_BYTES
) -> tuple[tuple[str, bytes], ...]:
    """The reference text of each language of ``labelled`` (doc_id, text, lang), which comes to the driver.

    A sample of rows is learned from, its texts whole: of each language up to ``documents`` documents, those whose ids have the
    smallest hashes in as many classes, in the order of their hashes, as far as they fit into ``reference_bytes`` bytes together.
    A longer document is passed over. If not one fits, the shortest of them is learned alone, at any length. Null
    languages and texts teach nothing. Languages with more documents come first.
    """
    rows = labelled.filter("lang is not null and text is not null").select(
        "lang", "text", F.xxhash64("doc_id").alias("hash"), F.octet_length("text").alias("size")
    )
    rows = rows.withColumn("class", F.pmod("hash", F.lit(documents)))
    fits = F.when(F.col("size") <= reference_bytes, F.struct("hash", "size"))
    found = rows.groupBy("lang", "class").agg(
        F.min(fits).alias("first"), F.min(F.struct("size", "hash")).alias("least"), F.count("*").alias("n")
    ).collect()  # bounded: ``documents`` rows without their texts for each language
    if not found:
        return ()
    number: dict[str, int] = {}
    for r in found:
        number[r["lang"]] = number.get(r["lang"], 0) + r["n"]
    chosen: list[tuple[str, int, int]] = []
    for lang in number:
        own = sorted((r["first"]["hash"], r["first"]["size"]) for r in found if r["lang"] == lang and r["first"])
        room = reference_bytes
        for key, size in own:
            if size <= room:
                chosen.append((lang, key, size))
                room -= size + 1
        if not own:
            size, key = min((r["least"]["size"], r["least"]["hash"]) for r in found if r["lang"] == lang)
            chosen.append((lang, key, size))
    picks = labelled.sparkSession.createDataFrame(chosen, "lang string, hash long, size int")
    # Rows that share a doc_id and a length give one text.
    sample = rows.join(F.broadcast(picks), ["lang", "hash", "size"]).groupBy("lang", "hash").agg(F.min("text").alias("text"))
    parts: dict[str, list[bytes]] = {}
    for r in sample.orderBy("lang", "hash").collect():
        data, offsets = text_buffers(pa.array([r["text"].lower()]))
        parts.setdefault(r["lang"], []).append(normalized(data, offsets)[0].tobytes())
    order = sorted(parts, key=lambda lang: (-number[lang], lang))
    return tuple((lang, b" ".join(parts[lang])) for lang in order)


def identify(docs: DataFrame, references: tuple[tuple[str, bytes], ...], *keep: Column | str) -> DataFrame:
    """``keep`` columns of ``docs`` with lang_pred, score and ``phrase_rate``.

    ``score`` is one minus the ratio of the best to the second-best cross entropy, scaled to reach 1 for half the
    entropy or less; ``phrase_rate`` is the number of phrases for each symbol in the best language. A null
    text, or one without a letter, is ``und`` with score 0 and rate 1. Equal entropies go to the reference that
    comes first.
    One pass without a shuffle over whole texts.
    """
    has_letter = F.coalesce(F.col("text").rlike(LETTER), F.lit(False))
    rows = docs.select(*keep, F.lower("text").alias("__text"), has_letter.alias("__letter"))
    names = [*rows.columns[:-2], "lang_pred", "score", "phrase_rate"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(references)
        languages = np.array([*parser.languages, UNKNOWN], object)
        for batch in batches:
            data, offsets = text_buffers(batch.column("__text"))
            for lo, hi in chunks(offsets, BATCH_BYTES):
                part = batch.slice(lo, hi - lo)
                symbols, bounds = normalized(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                n = np.maximum(np.diff(bounds), 1)
                letter = part.column("__letter").to_numpy(zero_copy_only=False)
                best, score, rate = np.full(len(n), len(languages) - 1), np.zeros(len(n)), np.ones(len(n))
                if parser.languages:
                    counts = parser.phrases(symbols, bounds)
                    entropy = counts * parser.cost / n[:, None]
                    first = entropy.argmin(axis=1)
                    least = entropy[np.arange(len(n)), first]
                    if len(parser.languages) > 1:
                        second = np.partition(entropy, 1, axis=1)[:, 1]
                        score = np.minimum(1.0, 2.0 * (1.0 - least / np.maximum(second, 1e-9)))
                    else:
                        score[:] = 1.0
                    rate = counts[np.arange(len(n)), first] / n
                    best = np.where(letter, first, best)
                    score, rate = np.where(letter, score, 0.0), np.where(letter, rate, 1.0)
                columns = [part.column(i) for i in range(part.num_columns - 2)]
                columns += [pa.array(languages[best], pa.string()), pa.array(score), pa.array(rate)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-2])
    schema = ", ".join(x for x in (kept, "lang_pred string, score double, phrase_rate double") if x)
    return rows.mapInArrow(tidy(run), schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id's text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
