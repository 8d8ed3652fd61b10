"""Fingerprints, mixing, sharding, language and quality on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from precinct.llm import common, fingerprint, language, mixing, quality, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = ["", None, " ", "a", "é中", "one two three", "x" * 5000, "same text", "same text"]


def prose(n, seed=1, words=("the", "of", "and", "river", "stone", "bridge", "water", "light", "field", "house")):
    rng = random.Random(seed)
    return [" ".join(rng.choices(words, k=rng.randint(1, 200))) for _ in range(n)]


# --- Fingerprints ---


def test_fingerprints_of_edited_texts(make_docs):
    texts = EDGE + prose(40)
    rows = list(zip(random.Random(2).sample(range(500), len(texts)), texts))
    found = {r["doc_id"]: r for r in fingerprint.edited_copies(make_docs(rows, extra=["bucket", "next_text"])).collect()}
    order = sorted((i, t or "") for i, t in rows)
    prints = {}
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = found[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        a, b = fingerprint.parse(r["fingerprint"]), fingerprint.parse(r["edited_fingerprint"])
        assert fingerprint.likeness(a, b)[0] == pytest.approx(r["near_edited"])
        assert (r["near_next"] == 1) >= (text == after)
    assert np.mean([r["near_edited"] for r in found.values()]) > np.mean([r["near_next"] for r in found.values()])


def test_counts_of_triplets_equal_a_loop():
    texts = [b"", b"ab", b"abc", b"abcdefg", b"zzzzzz"]
    data, offsets = common.text_buffers(pa.array(texts))
    counts = fingerprint.bucket_counts(data, offsets)
    for row, text in enumerate(texts):
        slow = np.zeros(fingerprint.BUCKETS, int)
        for k, (second, third) in enumerate(fingerprint.TRIPLETS):
            for i in range(third, len(text)):
                pair = int(fingerprint._MIX[k][(text[i] << 8) | text[i - second]]) & 0xFF
                slow[fingerprint._LAST[k][(pair << 8) | text[i - third]]] += 1
        assert np.array_equal(counts[row], slow)


def test_single_repeated_and_missing_documents(make_docs):
    assert fingerprint.edited_copies(make_docs([])).count() == 0
    (one,) = fingerprint.edited_copies(make_docs([(3, "abcd")])).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    rows = [(1, "aaaa"), (1, "aaaa"), (None, "bbbb"), (None, None)]
    assert fingerprint.edited_copies(make_docs(rows)).count() == 4


# --- Mixing ---


def naive_targets(sizes, weights):
    left, out, open_ = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while True:
        shares = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        above = [i for i in open_ if shares[i] > 3 * sizes[i]]
        if not above:
            for i in open_:
                out[i] = shares[i]
            return out
        for i in above:
            out[i] = 3.0 * sizes[i]
            open_.discard(i)
            left -= out[i]
        if not open_:
            return out


def mix_rows(seed=4):
    rng = random.Random(seed)
    texts = EDGE + prose(300, seed)
    sources = ["b", "a", None, "c", "Ω"]
    return [(i, t, None, rng.choices(sources, [10, 1, 3, 3, 1])[0]) for i, t in enumerate(texts)]


def test_the_mix_meets_its_targets(make_docs):
    rows = mix_rows()
    docs = make_docs(rows, extra=["size_", "target", "row"]).drop("size_")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mix = mixing.Mix(sized, shard_slots=64)
    out = {r["doc_id"]: r for r in mix.taken().collect()}
    words = {i: len(WORD.findall(t or "")) for i, t, _, _ in rows}
    by_source, taken = Counter(), Counter()
    for i, _, _, s in rows:
        by_source[s] += words[i]
        taken[s] += out[i]["taken"]
        assert out[i]["size"] == words[i] and out[i]["taken"] <= 3 * words[i]
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    aims = dict(zip(names, naive_targets([by_source[s] for s in names], [1, 2, 3, 1, 2])))
    for i, _, _, s in rows:
        assert out[i]["source_size"] == by_source[s] and out[i]["target"] == pytest.approx(aims[s])
    for s in names:
        assert abs(taken[s] - aims[s]) <= 2 * mixing.BLOCK_WORDS
    again = {r["doc_id"]: r["taken"] for r in mixing.Mix(sized.repartition(7), shard_slots=64).taken().collect()}
    assert again == {i: r["taken"] for i, r in out.items()}
    # Slots: gapless in their shards, and each holds a block of its source.
    spans = mix.spans().collect()
    slots = defaultdict(set)
    for s in spans:
        slots[s["shard"]].add(s["slot"])
    assert all(v == set(range(len(v))) for v in slots.values()) and len(slots) == -(-sum(mix.wanted) // 64)
    counts = Counter()
    for s in spans:
        counts[s["doc_id"]] += s["words"]
    assert counts == Counter({i: r["taken"] for i, r in out.items() if r["taken"]})


def test_mixed_documents_hold_the_taken_words(make_docs):
    rows = mix_rows()
    docs = make_docs(rows)
    taken = {r["doc_id"]: r["taken"] for r in mixing.Mix(
        docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), mixing.text_key()), carry=("text_key",)).taken().collect()}
    out = {r["doc_id"]: r for r in mixing.mixed_documents(docs).collect()}
    assert set(out) == {i for i, n in taken.items() if n}
    for i, t, _, s in rows:
        if i in out:
            assert len(WORD.findall(out[i]["text"])) == taken[i] and out[i]["source"] == s
            assert set(WORD.findall(out[i]["text"])) <= set(WORD.findall(t))
    assert mixing.mixed_documents(make_docs([])).count() == 0
    assert mixing.mixed_documents(make_docs(["", None])).count() == 0


def test_permutations_are_bijections():
    for n in (1, 2, 3, 17, 64, 1000):
        seen = [mixing.permuted(np.arange(n), np.full(n, n), np.full(n, k, np.uint64)) for k in range(3)]
        assert all(sorted(p.tolist()) == list(range(n)) for p in seen)
    assert not np.array_equal(seen[0], seen[1])


# --- Sharding ---


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(1)
    for _ in range(30):
        supply = [rng.randint(0, 50) for _ in range(rng.randint(1, 6))]
        shards = rng.randint(1, 7)
        demand = sharding.even_capacities(sum(supply), shards)
        flows = sharding.min_cost_flow(supply, demand, {(i, i): 0 for i in range(min(len(supply), shards))})
        assert all(sum(x for (i, _), x in flows.items() if i == k) == s for k, s in enumerate(supply))
        assert all(sum(x for (_, j), x in flows.items() if j == k) == d for k, d in enumerate(demand))
        stays = sum(min(s, d) for s, d in zip(supply, demand))
        assert sum(x for (i, j), x in flows.items() if i != j) == sum(supply) - stays


def test_shards_are_even_and_complete(make_docs):
    rng = random.Random(5)
    rows = [(i, t, None, rng.choices(["a", "b", None], [8, 1, 1])[0]) for i, t in enumerate(EDGE + prose(600, 7))]
    rows += [(None, "no id"), (3, "again")]
    docs = sharding.old_layout(make_docs(rows, extra=["slot", "shard", "block"]), 5)
    plan = sharding.Resharding(docs, 5, 8)
    out = plan.rewrite().collect()
    text = Counter((i, t) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["text"]) for r in out) == text
    size, slots = Counter(), defaultdict(list)
    for r in out:
        size[r["shard"]] += len((r["text"] or "").encode()) + 8
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8
    assert max(size.values()) < 1.03 * sum(size.values()) / 8
    stays = sum(len((r["text"] or "").encode()) + 8 for r in out if r["old_shard"] == r["shard"])
    assert stays >= 0.9 * (sum(size.values()) - plan.moved)


def test_shards_that_fit_are_not_rewritten(make_docs, tmp_path):
    docs = make_docs([(i, "ten bytes.") for i in range(40)])
    even = docs.select("doc_id", "text", (F.col("doc_id") % 4).cast("int").alias("old_shard"))
    plan = sharding.Resharding(even, 4, 4)
    assert plan.affected == [] and plan.moved == 0
    assert all(r["shard"] == r["old_shard"] for r in plan.rewrite(str(tmp_path / "new")).collect())
    assert not (tmp_path / "new").exists()
    assert sharding.Resharding(sharding.old_layout(make_docs([])), 5).rewrite().count() == 0


# --- Language ---


def tongue(kind, n, seed):
    syllables = {"xx": ["tha", "ing", "er", "wo"], "yy": ["ção", "é", "ari", "lho"], "zz": ["sch", "ü", "ung", "ei"]}[kind]
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(3, 60))) for _ in range(n)]


def test_language_of_held_out_documents(make_docs):
    rows = [(i, t, kind) for i, (kind, t) in enumerate((k, t) for k in ("xx", "yy", "zz") for t in tongue(k, 60, ord(k[0])))]
    rows += [(900, None, "xx"), (901, "12 -- !", "yy"), (902, "", None), (903, "Thaing Wo", None)]
    docs = make_docs(rows, extra=["score", "held_out", "hash"])
    references = language.learn(docs.filter(~language.held_out(F.col("doc_id"))))
    assert [name for name, _ in references] == ["xx", "yy", "zz"]
    out = {r["doc_id"]: r for r in language.identify(docs, references, "doc_id", language.held_out(F.col("doc_id")).alias("out")).collect()}
    assert all(out[i]["lang_pred"] == kind for i, _, kind in rows[:180])
    assert [out[i]["lang_pred"] for i in (900, 901, 902, 903)] == ["und", "und", "und", "xx"]
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert all(out[i]["out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in out)


def test_whole_texts_of_bounded_rows_are_learned(make_docs):
    rows = [(i, f"{'a' * i} {'b' * i}", "xx") for i in range(1, 60)] + [(100, "c" * 500, "yy"), (101, "d" * 400, "yy"), (102, None, "xx")]
    learned = dict(language.learn(make_docs(rows), documents=8, reference_bytes=120))
    parts = learned["xx"].split(b" ")
    assert len(learned["xx"]) <= 120 and 2 <= len(parts) <= 16
    assert all(len(a) == len(b) and set(a) == {97} and set(b) == {98} for a, b in zip(parts[::2], parts[1::2]))
    assert learned["yy"] == b"d" * 400  # nothing fits: the shortest
    assert dict(language.learn(make_docs(rows), 1000, 10**6))["xx"].count(b"b" * 59) == 1


def test_phrases_equal_a_greedy_parse():
    rng = random.Random(1)
    references = tuple((k, "".join(rng.choices("abc ", k=200)).encode()) for k in "pq")
    parser = language.CrossParser(references)
    texts = ["".join(rng.choices("abcd ", k=rng.randint(0, 80))).encode() for _ in range(50)]
    data, offsets = common.text_buffers(pa.array(texts))
    counts = parser.phrases(data, offsets)
    for row, text in enumerate(texts):
        for column, (_, reference) in enumerate(references):
            at = n = 0
            while at < len(text):
                size = 1
                while at + size < len(text) and text[at : at + size + 1] in reference:
                    size += 1
                at, n = at + size, n + 1
            assert counts[row, column] == n


def test_long_documents_are_parsed_in_segments():
    parser = language.CrossParser((("p", b"abab"),))
    data = np.frombuffer(b"ab" * 5000, np.uint8)
    assert parser.phrases(data, np.array([0, 0, len(data)]))[:, 0].tolist() == [0, 2500 + 0]


def test_nothing_learned(make_docs):
    docs = make_docs([(1, "text"), (2, None)])
    assert language.learn(docs) == ()
    assert {r["lang_pred"] for r in language.identify(docs, (), "doc_id").collect()} == {"und"}
    assert language.identify(make_docs([]), (("en", b"abc"),), "doc_id").count() == 0


# --- Quality ---


def test_quality_of_held_out_documents(make_docs, spark):
    rng = random.Random(3)
    good, bad = prose(120, 11), [" ".join(w.upper() + "!!" for w in t.split()) for t in prose(60, 12)]
    rows = list(enumerate(good + bad)) + [(500, ""), (501, None)]
    docs = make_docs(rows, extra=["score", "quality"])
    learned = [i for i in range(180) if rng.random() < 0.7]
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in learned] + [(7, None, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(docs.drop("quality"), labels)
    out = {r["doc_id"]: r for r in quality.score(docs, model, "doc_id").collect()}
    right = [out[i]["predicted"] == int(i < 120) for i in range(180) if i not in learned]
    assert np.mean(right) > 0.95 and all(0 <= r["score"] <= 1 for r in out.values())
    assert out[500]["score"] == out[501]["score"] == pytest.approx(np.mean([i < 120 for i in learned]))
    bounded = quality.learn(docs.drop("quality"), labels, sample_rows=10)
    assert len(bounded.labels) == 10


def test_quality_without_labels(make_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = make_docs([(1, "text"), (2, "")])
    assert {r["score"] for r in quality.score(docs, quality.learn(docs, none), "doc_id").collect()} == {0.5}


def test_blocked_products_are_exact():
    rng = np.random.default_rng(1)
    terms, labels = rng.random((50, quality.TERMS)).astype(np.float32), rng.integers(0, 2, 50).astype(float)
    model = quality.fit(terms, labels)
    query = rng.random((9, quality.TERMS)).astype(np.float32)
    latent = model.latent(query)
    for row, score in enumerate(model.scores(query)):
        cosines = np.array([float(v @ latent[row]) for v in model.vectors])
        near = np.argsort(-cosines)[: quality.NEIGHBOURS]
        weight = np.maximum(cosines[near], 0) ** quality.SHARPNESS
        assert score == pytest.approx((weight * labels[near]).sum() / weight.sum(), abs=1e-4)


@pytest.mark.parametrize("scale", [1, 10**4, 10**9, 10**12])
def test_draws_use_up_what_is_left_at_every_size(scale):
    """One way of drawing at all sizes: shares of what is left, within what is left, exact sums."""
    left = np.array([5 * scale, 0, 3 * scale, 2 * scale], np.int64)
    sizes = [scale] * 9 + [scale - scale // 3, scale // 3]
    rng = np.random.default_rng(3)
    drawn = list(mixing._draw(rng, left, sizes))
    assert [int(d.sum()) for d in drawn] == sizes and (sum(drawn) == left).all()
    assert all((d >= 0).all() for d in drawn)
    if scale >= 10**4:
        assert np.allclose(drawn[0] / scale, [0.5, 0, 0.3, 0.2], atol=0.03)
