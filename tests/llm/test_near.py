"""Near-duplicate documents and vectors against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from precinct.llm import common, minhash, vectors
from precinct.llm.minhash import linked, shingle_sets, super_minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def corpus(seed=1, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ß x", "A'b"]
    texts = ["", None, " \n ", "one two", "One  TWO", "one two three", "a b c d e", "a b c d e f", "é É", "É É"]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n", "\t "]).join(copy))
    texts += texts[-5:]
    return texts


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    root = components_of(range(len(rows)), links)
    low = {}
    for i, r in root.items():
        low[r] = min(low.get(r, rows[i][0]), rows[i][0])
    return sorted((rows[i][0], len(sets[i]), low[root[i]], rows[i][0] == low[root[i]]) for i in range(len(rows)))


@pytest.mark.parametrize("bucket_rows", [2048, 3])
def test_near_duplicates_equal_brute_force(make_docs, monkeypatch, bucket_rows):
    monkeypatch.setattr(minhash, "BUCKET_ROWS", bucket_rows)  # small: buckets are split into parts
    texts = corpus()
    order = random.Random(2).sample(range(1000), len(texts))
    rows = list(zip(order, texts))
    found = minhash.near_duplicates(make_docs(rows, extra=["component_id", "set", "rep"])).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found) == expected(rows)


def test_repeated_and_null_ids(make_docs):
    near = " ".join(f"x{i}" for i in range(60))
    rows = [(7, near), (7, near), (7, "something else entirely different here now"), (9, near + " y"), (None, "alone in the text of nobody")]
    found = minhash.near_duplicates(make_docs(rows)).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in found) == [
        (-1, -1, True), (7, 7, True), (7, 7, True), (7, 7, True), (9, 7, False)
    ]
    kept = minhash.without_near_duplicates(make_docs(rows)).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept) == [(-1, rows[4][1]), (7, rows[2][1]), (7, near)]


def test_empty_tables(make_docs, spark):
    assert minhash.near_duplicates(make_docs([])).count() == 0
    assert minhash.near_duplicates(make_docs(["", None])).count() == 2
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(none).count() == 0


def test_super_minhash_equals_the_sequential_algorithm():
    rng = np.random.default_rng(4)
    sizes = [0, 1, 2, 30, 200]
    elements = rng.integers(0, 1 << 63, sum(sizes)).astype(np.uint64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    m = 16
    found = super_minhash(elements, bounds, m)
    for row in range(len(sizes)):
        slow = np.full(m, np.inf)
        for e in elements[bounds[row] : bounds[row + 1]]:
            places = list(range(m))
            for step in range(m):
                r = int(common.mix64(np.array([(int(e) + (step + 1) * 0x9E3779B97F4A7C15) % (1 << 64)], np.uint64))[0])
                k = step + ((r & 0xFFFFFF) * (m - step) >> 24)
                places[step], places[k] = places[k], places[step]
                slow[places[step]] = min(slow[places[step]], step + (r >> 24) / (1 << 40))
        assert np.array_equal(found[row], slow)


def test_signatures_estimate_similarity():
    words = [f"w{i}" for i in range(400)]
    a, b = " ".join(words), " ".join(words[:380] + [f"v{i}" for i in range(20)])
    import pyarrow as pa

    sets, bounds = shingle_sets(*common.text_buffers(pa.array([a, b])))
    one, two = super_minhash(sets, bounds, 512)
    left, right = shingles(a), shingles(b)
    assert abs((one == two).mean() - len(left & right) / len(left | right)) < 0.05


def test_linked_stops_early_but_loses_nothing():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(120):
        base = rng.integers(0, 60, 30) + 1000 * rng.integers(0, 3)
        sets.append(np.unique(base).astype(np.uint64))
    links = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 50 * len(np.union1d(sets[i], sets[j]))
    ]
    root = components_of(range(len(sets)), links)
    assert linked(sets, 50).tolist() == [root[i] for i in range(len(sets))]


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(100, 200)] + [(300, 300)]
    random.Random(1).shuffle(edges)
    found = common.components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    root = components_of({x for e in edges for x in e}, edges)
    assert {r["node"]: r["component"] for r in found} == {n: r for n, r in root.items() if n != 300}


@pytest.mark.parametrize("block_rows", [1024, 4])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(7)
    rows = []
    for group in range(30):
        base = rng.normal(size=32)
        for _ in range(int(rng.integers(1, 9))):
            rows.append(((base + rng.normal(size=32) * rng.uniform(0, 0.35)).astype(np.float32).tolist(), group % 3))
    rows += rows[:4] + [([0.0] * 32, 1), (None, 1), ([float("nan")] * 32, 1), ([1.0, None], 1), ([], 1), (rows[0][0], None), ([1.0, 2.0], 1), ([2.0, 4.0], 1)]
    table = [(i, e, label, "x") for i, (e, label) in enumerate(rows)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int, bucket string").repartition(4)

    def good(e):
        return bool(e) and all(v is not None and np.isfinite(v) for v in e) and any(e)

    links = []
    for i, (a, x) in enumerate(rows):
        for j, (b, y) in enumerate(rows[:i]):
            if x is not None and x == y and good(a) and good(b) and len(a) == len(b):
                a64, b64 = np.array(a), np.array(b)
                if a64 @ b64 / np.sqrt(a64 @ a64) / np.sqrt(b64 @ b64) >= 0.93:
                    links.append((i, j))
    root = components_of(range(len(rows)), links)
    count = [sum(i in link for link in links) for i in range(len(rows))]
    found = {r["vec_id"]: r for r in vectors.near_vectors(df).collect()}
    assert len(links) > 50
    assert [(found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) for i in range(len(rows))] == [
        (count[i], root[i], root[i] == i) for i in range(len(rows))
    ]


def chains(seed, n, width):
    """Vectors on arcs: neighbours are near, ends of an arc are not; in no order."""
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        a, b = np.linalg.qr(rng.normal(size=(width, 2)))[0].T
        out += [np.cos(t) * a + np.sin(t) * b for t in np.arange(0, 1.6, 0.33)]
    out = [out[i].astype(np.float32) for i in rng.permutation(len(out))][:n]
    return out


def cosine_links(rows):
    x = vectors.unit_rows(pa.array([r.tolist() for r in rows]))
    i, j = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
    return list(zip(i.tolist(), j.tolist()))


@pytest.mark.parametrize("block", [1, 3, 7, 2048])
def test_connected_equals_brute_force_over_slices(block):
    for seed in range(20):
        rows = chains(seed, 40, width=6)
        root = components_of(range(len(rows)), cosine_links(rows))
        x = vectors.unit_rows(pa.array([r.tolist() for r in rows]))
        assert vectors.connected(x, 0.93, block).tolist() == [root[i] for i in range(len(rows))]


def test_slices_of_a_bucket_are_all_compared(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BUCKET_ROWS", 3)
    links = []
    for seed in range(12):
        rows = chains(seed, 12, width=6)
        root = components_of(range(len(rows)), cosine_links(rows))
        table = [(0, 0, i, r.tolist()) for i, r in enumerate(rows)]
        df = spark.createDataFrame(table, "bucket long, salt int, cid long, embedding array<float>").coalesce(1)
        found = [(r["a"], r["b"]) for r in vectors._bucket_links(df, 0.93).collect()]
        assert components_of(range(len(rows)), found) == root
        links += cosine_links(rows)
    assert len(links) > 50


def test_parts_of_a_large_bucket_are_all_compared(spark, monkeypatch):
    """All vectors share one bucket, whose parts have about twelve entries."""
    monkeypatch.setattr(vectors, "BUCKET_ROWS", 3)
    rows = [r for seed in range(8) for r in chains(seed, 30, width=16)]
    links = cosine_links(rows)
    root = components_of(range(len(rows)), links)
    count = np.bincount(np.array(links).reshape(-1), minlength=len(rows))
    one_bucket = lambda x, tables, functions, probes: np.zeros((len(x), 1, 1), np.uint64)
    monkeypatch.setattr(vectors, "codes", one_bucket)
    table = [(i, r.tolist(), 1) for i, r in enumerate(rows)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").repartition(4)
    found = {r["vec_id"]: r for r in vectors.near_vectors(df).collect()}
    assert [(found[i]["n_links"], found[i]["component_id"]) for i in range(len(rows))] == [(count[i], root[i]) for i in range(len(rows))]


def test_rotations_keep_lengths_and_codes_find_near_vectors():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert np.allclose(np.linalg.norm(vectors.rotated(x, 3), axis=1), 1)
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    near = 0.935 * x + np.sqrt(1 - 0.935**2) * noise
    a, b = (vectors.codes(v).reshape(len(v), -1) for v in (x, near))
    met = np.array([bool(set(p) & set(q)) for p, q in zip(a.tolist(), b.tolist())])
    assert met.mean() > 0.995
