"""The corpus pipeline: each stage against a plain computation on its own input."""

import hashlib
import random
import re

import public_tokenizers
import tiktoken

import corpus_pipeline
from precinct.llm import bpe_prefix
from precinct.session import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(seed=3):
    rng = random.Random(seed)
    tongues = {"en": ["tha", "ing", "er", "wo", "re"], "fr": ["é", "eau", "que", "ai", "ou"]}
    word = lambda k: "".join(rng.choices(tongues[k], k=rng.randint(1, 4)))
    out = []
    for i in range(160):
        lang = rng.choice(["en", "fr"])
        out.append([i, " ".join(word(lang) for _ in range(rng.randint(30, 120))), lang, rng.choice("ab")])
    passage = " ".join(word("en") for _ in range(60))
    for i in (20, 40, 60):
        out[i][1] += "\n" + passage + "\n" + out[i][1][::-1]
    for i in (100, 101, 102):
        out[i][1] = out[7][1]
    out[110][1] = out[8][1] + " more"
    out[120][1], out[121][1], out[122][1] = "12 -- 34", "", None
    return [tuple(r) for r in out]


def test_stages_in_order(make_docs, spark, tmp_path):
    docs = make_docs(rows())
    given = {r[0]: r[1] for r in rows()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "repeated_strings", "mixing", "tokens"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, "unused"), name)
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            kept[name] = {r["doc_id"]: r for r in docs.collect()}
            assert all(r["n_chars"] == len(r["text"]) for r in kept[name].values())
    assert set(given) - set(kept["language"]) == {120, 121, 122}
    assert set(kept["language"]) - set(kept["near_duplicates"]) == {100, 101, 102, 110}
    repeats = kept["repeated_strings"]
    assert set(repeats) == set(kept["near_duplicates"])
    for i, r in repeats.items():
        before = kept["near_duplicates"][i]["text"]
        assert (r["text"] == before) == (i not in (40, 60)) and len(r["text"]) <= len(before)
    words = lambda table, s: sum(len(WORD.findall(r["text"])) for r in table.values() if r["source"] == s)
    total = words(repeats, "a") + words(repeats, "b")
    first = min(total / 3, 3 * words(repeats, "a"))
    assert abs(words(kept["mixing"], "a") - first) <= 130
    for i, r in kept["mixing"].items():
        assert set(WORD.findall(r["text"])) <= set(WORD.findall(repeats[i]["text"]))
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_prefix.load_ranks(bpe_prefix.VOCABULARY), special_tokens={}
    )
    tokens = {r["doc_id"]: r for r in docs.collect()}
    assert set(tokens) == set(kept["mixing"])
    for i, r in tokens.items():
        text = kept["mixing"][i]["text"]
        assert r["n_tokens"] == len(own.encode_ordinary(text))
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_language_stage_keeps_short_texts_and_drops_other_scripts(make_docs, spark):
    more = [(200, "A", "en", "a"), (201, "Ok", "fr", "a"), (202, "жизнь и судьба " * 9, None, "a"), (203, "?!", None, "a")]
    found = corpus_pipeline.language_stage(spark, make_docs(rows() + more), "unused")
    assert {r["doc_id"] for r in found.collect()} & {200, 201, 202, 203} == {200, 201}


def test_near_duplicate_stage_equals_brute_force_from_80_percent(make_docs, spark):
    rng = random.Random(11)
    texts = []
    for group in range(40):
        base = [f"g{group}w{i}" for i in range(rng.randint(90, 130))]
        changes = 1 + group % 4
        step = len(base) // (changes + 1)
        copy = [f"x{group}y{i}" if i % step == 0 and 0 < i <= changes * step else w for i, w in enumerate(base)]
        texts += [" ".join(base), " ".join(copy)]
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (t.split(" ") for t in texts)]
    shared = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, len(sets), 2)]
    assert sum(0.80 <= s < 0.85 for s in shared) >= 8 and sum(s < 0.80 for s in shared) >= 8
    wanted = {i for i in range(len(texts)) if i % 2 == 0 or shared[i // 2] < 0.80}
    found = corpus_pipeline.near_duplicate_stage(spark, make_docs(texts), "unused")
    assert {r["doc_id"] for r in found.collect()} == wanted


def run_on(docs, folder, spark):
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, str(folder))


def test_run_takes_odd_tables(make_docs, spark, tmp_path):
    """Null ids and sources, repeated rows, one text many times, and columns whose names clash with those of the stages."""
    odd = [(None, "nobody knows this one", "en", "a"), (5, rows()[5][1], "en", "a"), (300, "one more text for nobody", None, None)]
    odd += [(400 + i, "over and over again the same old text", "en", "b") for i in range(30)]
    plain = run_on(make_docs(rows() + odd), tmp_path / "plain", spark).collect()
    extra = ["key", "hash", "score", "lang_pred", "phrase_rate", "bucket", "kept", "component_id", "size", "block", "shard", "slot"]
    again = run_on(make_docs(rows() + odd, extra), tmp_path / "extra", spark).collect()
    assert sorted(map(str, plain)) == sorted(map(str, again)) and len(plain) > 100
    ids = [r["doc_id"] for r in plain]
    assert {400} >= {i for i in ids if i and i >= 400} and not {120, 121, 122} & set(ids)


def test_run_without_documents_or_languages(make_docs, spark, tmp_path):
    assert run_on(make_docs([]), tmp_path / "empty", spark).count() == 0
    texts = [(i, f"word{i} and some more of text {i * 7} here", None, "a") for i in range(10)] + [(10, "12 34", None, "a")]
    kept = corpus_pipeline.language_stage(spark, make_docs(texts), "unused")
    assert {r["doc_id"] for r in kept.collect()} == set(range(10))
    assert run_on(make_docs(texts), tmp_path / "no-lang", spark).count() > 0


def test_queries_give_the_columns_asked_for(spark):
    from precinct.llm.queries import QUERIES

    wanted = {
        "op1": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op2": "doc_id n_shingles component_id kept",
        "op3": "doc_id size source_size target taken",
        "op4": "doc_id held_out score predicted",
        "op5": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op6": "doc_id size text_crc32 law shard slot grown_shard",
        "op7": "vec_id n_links component_id kept",
        "op8": "doc_id held_out lang_pred score",
        "op9": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op10": "doc_id start n_tokens ids_crc32",
        "op11": "vec_id component n deviation whitened explained identity_error",
        "op12": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
        "op13": "doc_id held_out n_tokens n_known train_tokens base_score score",
    }
    folder = "/root/testdata/sf0.001"
    for name, query in QUERIES.items():
        df, op = query(spark, folder), name.split("_")[0]
        assert df.columns == wanted[op].split()
        table = {"op7": "embeddings", "op11": "embeddings", "op12": "conversations"}.get(op, "documents")
        rows = spark.read.parquet(f"{folder}/{table}.parquet")
        expected = {"op11": 4 * rows.count(), "op12": rows.select("conv_id").distinct().count() if op == "op12" else 0}
        assert df.count() == expected.get(op, rows.count())
    assert len(QUERIES) == 13
