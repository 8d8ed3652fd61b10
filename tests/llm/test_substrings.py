"""Suffix arrays and the removal of repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from precinct.llm import substrings
from precinct.llm.suffix_array import lyndon_groups, suffix_array


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_is_sorted(symbols):
    assert suffix_array(np.array(symbols, np.int64)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_suffix_array_of_periodic_and_long_texts():
    rng = random.Random(1)
    for text in (b"a" * 3000, b"abaab" * 700, bytes(rng.choices(b"ab", k=4000)), b"ba" * 999 + b"c"):
        assert suffix_array(np.frombuffer(text, np.uint8)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_groups_are_lyndon_prefixes():
    text = [2, 1, 3, 1, 2, 1, 3, 1, 1, 2, 0]
    group, before = lyndon_groups(text)
    smaller = [max((j for j in range(i) if text[j:] < text[i:]), default=-1) for i in range(len(text))]
    assert before == smaller
    after = [min((j for j in range(i + 1, len(text)) if text[j:] < text[i:]), default=len(text)) for i in range(len(text))]
    prefix = [tuple(text[i:j]) for i, j in enumerate(after)]
    for i in range(len(text)):
        for j in range(len(text)):
            assert (group[i] < group[j]) == (prefix[i] < prefix[j])


def brute(rows, length=100):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    for k in order:
        text = (rows[k][1] or "").encode()
        spans = []
        for s in range(len(text) - length + 1):
            window = text[s : s + length]
            if window in seen:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + length
                else:
                    spans.append([s, s + length])
            seen.add(window)
        left = b"".join(text[a:b] for a, b in zip([0] + [e for _, e in spans], [s for s, _ in spans] + [len(text)]))
        out.append((rows[k][0] if rows[k][0] is not None else -1, len(text), len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "é", "ana", "nan", "\n", "ba", "ß", "x"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(n) for n in (40, 60, 90, 33)]
    out = ["", None, "z" * 99, "z" * 100, "z" * 350, "ab" * 200, "q" + "ab" * 150, "same " * 90, "same " * 90]
    for _ in range(40):
        parts = [text(rng.randint(0, 60)) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            parts.insert(rng.randint(0, len(parts)), p[a : len(p) - rng.randint(0, len(p) // 3)])
        out.append("".join(parts))
    out += [out[12], out[13] + "tail", "head" + out[14]]
    return out


@pytest.mark.parametrize("group_rows", [20_000, 2])
def test_removal_equals_brute_force(make_docs, monkeypatch, group_rows):
    monkeypatch.setattr(substrings, "GROUP_ROWS", group_rows)  # small: windows of common places meet one by one
    rows = list(zip(random.Random(3).sample(range(900), 52), corpus(1)))
    rows = [*rows, (None, rows[20][1])]
    found = substrings.remove_repeats(make_docs(rows, extra=["key", "spans", "bytes"])).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found)
    assert got == brute(rows) and sum(r[2] for r in got) > 1000


def test_repeated_rows_and_empty_table(make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    found = substrings.remove_repeats(make_docs([(5, text), (5, text), (5, text)]), keep_text=True).collect()
    assert sorted(r["n_removed"] for r in found) == [0, len(text), len(text)]
    assert sorted(r["kept"] for r in found) == ["", "", text]
    assert substrings.remove_repeats(make_docs([])).count() == 0


def test_leftmost_minimum():
    rng = np.random.default_rng(1)
    for n, width in ((10, 1), (50, 7), (69, 69), (200, 69)):
        values = rng.integers(0, 5, n)
        want = [i + int(np.argmin(values[i : i + width])) for i in range(n - width + 1)]
        assert substrings.leftmost_minimum(values, width).tolist() == want


def test_crowded_places_are_spread(make_docs, monkeypatch):
    """One passage between other words in most documents: its contexts at both ends differ everywhere."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(words, k=40))
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows = [(i, " ".join([text(rng.randint(5, 40)), passage, text(rng.randint(5, 40))]) if i % 5 else text(80)) for i in range(150)]
    found = substrings.remove_repeats(make_docs(rows)).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found)
    assert got == brute(rows)


def test_a_lone_earlier_context_of_a_crowded_place_counts(spark, monkeypatch):
    """Copies lie in one piece of text with edited ones, which stand between them and the first copy in the order of ids."""
    monkeypatch.setattr(substrings, "CROWD", 1)
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))
    first, rest = [], []
    for group in range(12):
        copy = text(70)
        first.append((10 * group, copy))
        rest += [(10 * group + 5, text(20) + copy[80:300] + text(20)), (10 * group + 9, copy)]
    monkeypatch.setattr(substrings, "chunks", lambda offsets: [(0, 12), (12, 36)] if len(offsets) == 37 else [(0, len(offsets) - 1)])
    docs = spark.createDataFrame(first + rest, "doc_id long, text string").coalesce(1)
    found = substrings.remove_repeats(docs).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found)
    assert got == brute(first + rest)


def test_blocks_of_a_long_text_hold_each_window_once(monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 300)
    monkeypatch.setattr("precinct.llm.common.CHUNK_BYTES", 300)
    rng = np.random.default_rng(2)
    sizes = [0, 50, 1000, 399, 400, 401, 5000, 120, 99]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = rng.integers(0, 4, offsets[-1]).astype(np.uint8)
    found = []
    for row, before, part, bounds in substrings._pieces(data, offsets, 100):
        assert len(part) <= 500 or len(bounds) > 2
        own, _, _, lo, reach, _ = substrings.contexts(part, bounds, 100, 32)
        found += [(row + r, before + a + k) for r, a, n in zip(own.tolist(), lo.tolist(), reach.tolist()) for k in range(n + 1)]
    assert sorted(found) == [(r, w) for r, n in enumerate(sizes) for w in range(n - 99)]


def test_long_texts_equal_brute_force(spark, make_docs):
    """Texts beyond a block, with passages that repeat across its borders, inside a text and between texts."""
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage, short = noise(3000), noise(100)
    edge = substrings.CHUNK_BYTES
    first = noise(edge - 1500) + passage + noise(200_000) + short
    second = noise(1000) + first[edge - 5000 : edge + 5000] + noise(edge) + passage + noise(50) + short + noise(10)
    rows = [(1, first), (2, second), (3, short + "x" + passage[:150]), (4, None)]
    got = substrings.remove_repeats(make_docs(rows)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)
