"""Suffix-tree scores against a plain computation with dictionaries, for any chunking, and edge cases."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from precinct.llm import queries, suffix_tree

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered) + [None]  # None: the end


def plain_scores(rows, depth, share):
    """[(n_tokens, n_known, train_tokens, base, score)] of (doc_id, text, held) rows by the definition of the model."""
    texts = [(["<begin>", *tokens_of(text)], held) for _, text, held in rows]
    single, following = Counter(), [defaultdict(Counter) for _ in range(depth)]
    for words, held in texts:
        if held:
            continue
        for at in range(1, len(words)):
            single[words[at]] += 1
            for k in range(depth):
                if at - 1 - k >= 0:
                    following[k][tuple(words[at - 1 - k : at])][words[at]] += 1
    total, distinct = sum(single.values()), len(single)
    least = max(1.0, share * total)
    # Words that are frequent as contexts; longer contexts need their parts to be contexts, which their number implies.
    contexts = [{s: sum(c.values()) for s, c in level.items() if sum(c.values()) >= least} for level in following]

    def base(w):
        return (single[w] + 1) / (total + distinct + 1)

    def chain(history, w):
        """(context, probability) from the shortest context on."""
        p, out = base(w), []
        for k in range(depth):
            s = tuple(history[len(history) - 1 - k :]) if len(history) > k else None
            if s is None or s not in contexts[k]:
                break
            weight = suffix_tree.WEIGHTS[k]
            p = (following[k][s][w] + weight * p) / (contexts[k][s] + weight)
            out.append((s, p))
        return out

    kept = set()
    for k in range(depth):
        weight = suffix_tree.WEIGHTS[k]
        for s, n in contexts[k].items():
            gain = 0.0
            for w, c in following[k][s].items():
                parent = base(w) if k == 0 else dict(chain(list(s)[1:], w))[s[1:]]
                gain += c * math.log(((c - 1) + weight * parent) / (n - 1 + weight) / parent)
            if gain > 1e-9:
                kept |= {s[i:] for i in range(len(s))}
    out = []
    for words, _ in texts:
        base_score = score = 0.0
        for at in range(1, len(words)):
            p = base(words[at])
            base_score += math.log10(p)
            for s, q in chain(words[:at], words[at]):
                p = q if s in kept else p
            score += math.log10(p)
        out.append((len(words) - 1, sum(single[w] > 0 for w in words[1:]), total, base_score, score))
    return out, kept


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "Tab\tbed", "a\x0bb"]
    phrases = [[rng.choice(words) for _ in range(5)] for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [w for _ in range(rng.randint(0, 6)) for w in (rng.choice(phrases) if rng.random() < 0.6 else [rng.choice(words)])]
        rows.append((i, " ".join(parts), i % 7 == 2))
    # A word that is most of the corpus, copies, empty and null texts, odd white space.
    rows += [(200 + i, "hot " * 60 + f"Odd{i}", i % 5 == 0) for i in range(10)]
    rows += [(300, rows[3][1], False), (300, rows[3][1], True), (None, "w1 w2 w3", False), (301, "", False), (302, None, True), (303, " \n ", False)]
    return rows


def scored(spark, rows, depth=3, share=0.002, extra=()):
    df = spark.createDataFrame(rows, "doc_id long, text string, flag boolean").repartition(3)
    df = df.select("*", *[F.lit("x").alias(c) for c in extra])
    got = suffix_tree.score_documents(df, F.col("flag"), depth, share).collect()
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], *list(r)[2:]) for r in got)


def wanted(rows, depth=3, share=0.002):
    found, kept = plain_scores(rows, depth, share)
    return sorted((d is None, d or 0, h, *f) for (d, _, h), f in zip(rows, found)), kept


def assert_equal(got, expected):
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:6] == b[:6]
        assert np.allclose(a[6:], b[6:], rtol=1e-9, atol=1e-9), (a, b)


@pytest.mark.parametrize("depth,share", [(1, 0.002), (3, 0.002), (3, 0.02), (2, 0.0)])
def test_equals_the_plain_model(spark, depth, share):
    rows = corpus(depth)
    expected, kept = wanted(rows, depth, share)
    assert kept
    assert_equal(scored(spark, rows, depth, share, extra=("chunk", "words", "held", "row")), expected)


@pytest.mark.parametrize("tokens,block", [(1, 16), (50, 7), (300, 64)])
def test_long_texts_in_many_chunks_score_the_same(spark, monkeypatch, tokens, block):
    monkeypatch.setattr(suffix_tree, "CHUNK_TOKENS", tokens)
    monkeypatch.setattr(suffix_tree, "BLOCK_BYTES", block)
    rows = corpus(9, 40) + [(400, "w1 w2 " * 100 + "x" * 200 + " w3", False), (401, "y" * 50, False), (402, " " * 90, True)]
    assert_equal(scored(spark, rows), wanted(rows)[0])


def test_contexts_are_variable_in_length(spark):
    """A word pair that foretells what comes stays as a context; one that something else follows each time goes."""
    rng = random.Random(1)
    rows = []
    for i in range(300):
        rows.append((i, f"new york {'city' if rng.random() < 0.95 else 'state'}", False))
        rows.append((1000 + i, f"old york {rng.choice(['minster', 'walls', 'river'])}", False))
        rows.append((2000 + i, f"{rng.choice('abcd')} filler only{i}", False))
    _, kept = wanted(rows, 2, 0.0)
    assert ("new", "york") in kept and ("old", "york") in kept
    assert not {s for s in kept if s[-1] == "filler"}
    assert_equal(scored(spark, rows, 2, 0.0), wanted(rows, 2, 0.0)[0])


def test_distributions_sum_to_one(spark):
    """Over all training tokens and one unseen token, the probabilities behind a context add up to one."""
    rows = corpus(4)
    every = sorted({w for _, t, h in rows if not h for w in tokens_of(t) if w})
    start = "w1 w2"
    probes = [(5000 + i, f"{start} {w}", True) for i, w in enumerate([*every, "unseen"])] + [(6000, start, True)]
    got = {r[1]: r[-1] for r in scored(spark, rows + probes)}
    # The text without its last two tokens: what is before them is the same in all probes.
    model = wanted(rows + probes)[0]
    assert_equal(scored(spark, rows + probes), model)
    before = plain_prefix(rows, start)
    ends = {w: plain_end(rows, start, w) for w in [*every, "unseen"]}
    mass = sum(10 ** (got[5000 + i] - before - ends[w]) for i, w in enumerate([*every, "unseen"]))
    assert np.isclose(mass + 10 ** (got[6000] - before), 1, atol=1e-9)


def plain_prefix(rows, start):
    """log10 probability of the words of ``start`` alone."""
    n = len(start.split())
    return _partial(rows, start, 0, n)


def plain_end(rows, start, word):
    """log10 probability of the end behind ``start`` and ``word``."""
    n = len(start.split()) + 1
    return _partial(rows, f"{start} {word}", n, n + 1)


def _partial(rows, text, lo, hi):
    """Score of the tokens [lo, hi) of a held-out text, as a difference of whole texts of the plain model."""
    words = text.split()
    probe = [(9000, text, True)]
    found, kept = plain_scores(rows + probe, 3, 0.002)
    whole = found[-1][-1]
    if (lo, hi) == (0, len(words)):
        end = plain_scores_tail(rows, words, kept)
        return whole - end
    return plain_scores_tail(rows, words, kept)


def plain_scores_tail(rows, words, kept):
    """log10 probability of the end token behind ``words``."""
    single, following = Counter(), [defaultdict(Counter) for _ in range(3)]
    for _, text, held in rows:
        if held:
            continue
        full = ["<begin>", *tokens_of(text)]
        for at in range(1, len(full)):
            single[full[at]] += 1
            for k in range(3):
                if at - 1 - k >= 0:
                    following[k][tuple(full[at - 1 - k : at])][full[at]] += 1
    total, least = sum(single.values()), max(1.0, 0.002 * sum(single.values()))
    p = best = (single[None] + 1) / (total + len(single) + 1)
    history = ["<begin>", *[w.lower() for w in words]]
    for k in range(3):
        s = tuple(history[len(history) - 1 - k :]) if len(history) > k else None
        n = sum(following[k][s].values()) if s else 0
        if n < least:
            break
        p = (following[k][s][None] + suffix_tree.WEIGHTS[k] * p) / (n + suffix_tree.WEIGHTS[k])
        best = p if s in kept else best
    return math.log10(best)


def test_nothing_to_learn_from(spark):
    assert scored(spark, []) == []
    rows = [(1, "a b", True), (2, None, True)]
    assert_equal(scored(spark, rows), wanted(rows)[0])
    assert [r[-1] for r in scored(spark, rows)] == [0.0, 0.0]


def test_query_learns_without_the_held_out_rows(spark, folder):
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_suffix_tree_scores"](spark, folder).collect()}
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in table}
    rows = [(r["doc_id"], r["text"], held[r["doc_id"]]) for r in table]
    counts = Counter(t for _, text, h in rows if not h for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for doc_id, text, h in rows:
        r, own = got[doc_id], tokens_of(text)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, len(own), sum(counts[t] > 0 for t in own), n)
        assert np.isclose(r["base_score"], sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own), rtol=1e-9)
    new = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in new) > sum(r["base_score"] for r in new)


def test_a_chunk_keeps_few_bytes_for_each_token():
    """Workers have little beside their batch: what is kept for each token, contexts of all lengths included, and what looking up takes."""
    rng, n, words = np.random.default_rng(1), 1 << 20, np.sort(np.random.default_rng(2).integers(1, 1 << 62, 1000, dtype=np.uint64))
    tokens = rng.integers(0, len(words), n).astype("<u4")
    row = {
        "words": words.astype("<u8").tobytes(), "tokens": tokens.view(np.uint8).reshape(-1, 4).T.tobytes(),
        "sizes": [n // 64] * 64, "skip": [1] * 64, "held": [k % 7 == 2 for k in range(64)],
    }
    counts, here = np.full(1000, n // 1000), np.arange(1000)
    pairs = np.unique(rng.integers(0, 1000, 5000) << 16 | rng.integers(0, 1000, 5000)).astype(np.uint64)
    many = np.full(len(pairs), 10)
    tree = suffix_tree.Tree(n, 1000, words, counts, [words, pairs], [counts, many], [here, (pairs & np.uint64(0xFFFF)).astype(int)], [])
    tracemalloc.start()
    try:
        chunk = suffix_tree._Chunk(row)
        contexts = chunk.contexts(tree)
        kept, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(contexts) == 2 and kept < 24 * n and peak < 48 * n


def test_no_more_bytes_are_stored_for_a_token_than_the_words_need(spark):
    for words, wide in ((3, 1), (255, 2), (70_000, 3)):  # BEGIN and END are words, too
        rows = [(1, " ".join(f"w{i}" for i in range(words)), False), (2, "w0", False)]
        df = spark.createDataFrame(rows, "doc_id long, text string, flag boolean").coalesce(1)
        (row,) = suffix_tree.token_chunks(df, F.col("flag")).collect()
        assert len(row["tokens"]) == wide * sum(row["sizes"]) and len(row["words"]) == 8 * (words + 2)
        chunk = suffix_tree._Chunk(row.asDict())
        assert np.bincount(chunk.tokens).tolist() == [2] * 3 + [1] * (words - 1)


def test_chunks_are_held_one_at_a_time(spark, monkeypatch, tmp_path):
    """A stored chunk is a row group of its own, and scoring gets it as a group beside its answers, not in rows that hold both."""
    paths, store = {}, suffix_tree.materialize

    def kept(df, name, **options):
        paths[name] = str(tmp_path / name)
        return store(df, path=paths[name], **options)

    monkeypatch.setattr(suffix_tree, "CHUNK_TOKENS", 50)
    monkeypatch.setattr(suffix_tree, "materialize", kept)
    rows = corpus(5, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string, flag boolean").repartition(2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")  # each batch is a block at least
    try:
        got = suffix_tree.score_documents(df, F.col("flag"), 3, 0.002)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    files = [pq.ParquetFile(p).metadata for p in Path(paths["token-chunks"]).glob("*.parquet")]
    groups = [m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)]
    assert len(groups) > 8 and set(groups) == {1}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CoGroupsInArrow" in plan and "collect_list" not in plan
    assert_equal(sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], *list(r)[2:]) for r in got.collect()), wanted(rows)[0])


def test_scoring_a_chunk_takes_few_bytes_for_each_token():
    rng, n, texts = np.random.default_rng(3), 1 << 20, 64
    words = np.sort(np.random.default_rng(4).integers(1, 1 << 62, 1000, dtype=np.uint64))
    tokens = rng.integers(0, len(words), n).astype("<u4")
    row = {
        "words": words.astype("<u8").tobytes(), "tokens": tokens.view(np.uint8).reshape(-1, 4).T[:2].tobytes(),
        "sizes": [n // texts] * texts, "skip": [1] * texts, "held": [k % 7 == 2 for k in range(texts)],
        "rows": list(range(texts)), "doc_ids": list(range(texts)),
    }
    often, here = words[::2], np.arange(500)
    counts = np.bincount(tokens, minlength=1000)[::2]
    tree = suffix_tree.Tree(n, 1000, often, counts, [often], [counts], [here], [here % 2 == 0])
    chunk = suffix_tree._Chunk(row)
    pairs = suffix_tree._Pairs(chunk, tree, 1)
    asked = pairs.questions(0, next(chunk.levels(tree)))
    known = np.bincount(tokens, minlength=1000)[pairs.rare]
    got = [{"known": suffix_tree.pack_small(known), "pairs": [suffix_tree.pack_small(asked["pair_count"])], "contexts": [suffix_tree.pack_small(asked["rare_count"])]}]
    del chunk, pairs, asked
    tracemalloc.start()
    try:
        out = suffix_tree.score_chunk(row, got, tree, 1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert out.num_rows == texts and out.column("n_tokens").to_pylist() == [n // texts - 1] * texts and peak < 80 * n


@pytest.mark.parametrize("largest", [3000, 1 << 61])
def test_codes_are_ranked_like_unique_values(largest):
    """Also where number and place do not fit into one word."""
    for n in (0, 1, 5000):
        code = np.random.default_rng(n).integers(0, largest, n) // 7 * 7
        distinct, inverse = np.unique(code, return_inverse=True)
        got = suffix_tree._ranked_codes(code.copy(), largest)
        assert np.array_equal(got[0], distinct) and np.array_equal(got[1], inverse)
