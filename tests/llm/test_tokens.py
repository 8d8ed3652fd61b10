"""Byte-level BPE by prefix values, and the packed token files, against the tokenizer libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from precinct.llm import bpe_prefix, common, pretokens, token_files
from precinct.llm.common import text_buffers
from precinct.llm.pretokens import split_pieces

import pyarrow as pa

EDGE = ["", None, " ", "\n\n  \n", "it's 'Re we'll x's ''s 's", "é中文 ß́ ‘a’", "a" * 3000, "  ab  cd\t\n e ", "12 345x\x1cy\x85z", "same", "same"]


def libraries():
    ranks = bpe_prefix.load_ranks(bpe_prefix.VOCABULARY)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    other = Tokenizer.from_file(token_files.VOCABULARY)
    other.encode_special_tokens = True
    return own, other


def noise(n, seed=3):
    rng = random.Random(seed)
    letters = " \n\t'stremvldabcABC012é中文ß،😀.,!?$\x1c\x85"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_pieces_are_the_matches_of_the_pattern():
    texts = [t or "" for t in EDGE] + noise(3000)
    data, offsets = text_buffers(pa.array(texts))
    begins = split_pieces(data, offsets)
    raw, ends = data.tobytes(), [*begins[1:].tolist(), len(data)]
    found = [raw[a:b].decode() for a, b in zip(begins.tolist(), ends)]
    assert found == [m for t in texts for m in regex.findall(public_tokenizers.PATTERN, t)]


def test_encoding_equals_the_library(make_docs):
    own, _ = libraries()
    texts = EDGE + noise(500)
    rows = {r["doc_id"]: r for r in bpe_prefix.encode(make_docs(texts, extra=["ids", "n_tokens"])).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = own.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        assert bytes(rows[i]["ids"]) == raw and rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_appends_and_edits_equal_a_new_encoding():
    vocabulary, _ = bpe_prefix._encoder(bpe_prefix.VOCABULARY)
    rng = random.Random(5)
    table = bpe_prefix.PrefixTable(vocabulary, b"thereafter" * 40)
    for _ in range(200):
        if rng.random() < 0.3:
            table.append(bytes(rng.choices(b"abcthe ", k=rng.randint(0, 5))))
        else:
            a = rng.randint(0, len(table.piece))
            b = min(len(table.piece), a + rng.randint(0, 6))
            table.replace(a, b, bytes(rng.choices(b"abcther", k=rng.randint(0, 6))))
        assert table.ids() == bpe_prefix.PrefixTable(vocabulary, table.piece).ids()
    middle = len(table.piece) // 2
    assert table.replace(middle, middle + 1, b"q") < len(table.piece) // 2  # only a part is computed anew


def test_a_wrong_lookup_is_noticed(monkeypatch):
    vocabulary, table = bpe_prefix._encoder(bpe_prefix.VOCABULARY)
    monkeypatch.setattr(table, "encode", lambda data, offsets: (np.array([0, 1], np.uint32), np.array([0, 1, 2])))
    data, offsets = text_buffers(pa.array(["hello there", "x y"]))
    ids, bounds, decoded = bpe_prefix.encode_batch(bpe_prefix.VOCABULARY, data, offsets)
    assert decoded.tobytes() == b"hello therex y" and len(bounds) == 3


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    for bits in (1, 7, 8, 15, 16, 17, 24, 31):
        for n in (0, 1, 8, 9, 5000):
            ids = rng.integers(0, 1 << bits, n).astype(np.uint32)
            assert np.array_equal(token_files.unpack(token_files.pack(ids, bits), bits, n), ids)


def test_segments_give_random_access():
    ids = np.arange(10_000, dtype=np.uint32) % 50_000
    content = token_files.segment(np.array([4, 9]), np.array([3000, 7000]), ids, 11, 16) + b"\n"
    found = next(token_files.segments(content * 2))
    assert found.before == 11 and np.array_equal(found.ids(), ids)
    assert np.array_equal(found.ids(4000, 9001), ids[4000:9001]) and np.array_equal(found.block(2), ids[8192:])
    assert len(list(token_files.segments(content * 2))) == 2


def test_token_files_equal_the_library(make_docs, monkeypatch):
    _, other = libraries()
    texts = EDGE + noise(300) + ["<|endoftext|> as text"]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, "no id"), (6, "again")]
    out = token_files.token_table(make_docs(rows, extra=["bucket", "start"])).collect()
    assert len(out) == len(rows)
    start = 0
    order = sorted(out, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted((r[0] for r in rows), key=lambda i: (i is None, i or 0))
    wanted = {}
    for i, text in rows:
        ids = [*other.encode(text or "", add_special_tokens=False).ids, 0]
        wanted.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in order:
        assert r["start"] == start
        start += r["n_tokens"]
        assert (r["n_tokens"], r["ids_crc32"]) in wanted[r["doc_id"]]


def test_op10_equals_the_unmodified_library(make_docs, spark, tmp_path):
    from precinct.llm.queries import QUERIES

    other = Tokenizer.from_file(token_files.VOCABULARY)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"{end}x", f"x \n {end}", f"é{end}中 {end}  y", "<|endof", "text|>", "plain", "", None] + noise(50)
    make_docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    out = sorted(QUERIES["op10_token_files"](spark, str(tmp_path)).collect(), key=lambda r: r["doc_id"])
    start = 0
    for r, text in zip(out, texts, strict=True):
        ids = [*other.encode(text or "", add_special_tokens=False).ids, 0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_added_tokens_with_flags_equal_the_library(tmp_path):
    from tokenizers import AddedToken

    other = Tokenizer.from_file(token_files.VOCABULARY)
    other.add_tokens([AddedToken("foo", single_word=True), AddedToken("<m>", lstrip=True, rstrip=True)])
    path = str(tmp_path / "flags.json")
    other.save(path)
    texts = ["foobar", "a foo b", " <m>  x", "<|endoftext|> y", "", "plain"]
    data, offsets = text_buffers(pa.array(texts))
    ids, counts = token_files.encode(path, data, offsets, None, added=True)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [other.encode(t, add_special_tokens=False).ids for t in texts]


def test_empty_table(make_docs):
    assert bpe_prefix.encode(make_docs([])).count() == 0
    assert token_files.token_table(make_docs([])).count() == 0


def test_a_worker_holds_one_state():
    """The state of the operator before is let go, so a worker does not gather those of all stages."""
    made = []
    state = lambda name: common.held_state((name,), lambda: made.append(name) or [name])
    assert state("a") is state("a") and state("b") == ["b"] and made == ["a", "b"]
    assert state("a") == ["a"] and made == ["a", "b", "a"]
    assert list(common._HELD) == [("a",)]


def test_rolling_hashes_of_long_buffers():
    """Equal ranges have equal hashes wherever they are, beyond the blocks of powers, too; memory is given back."""
    data = np.random.default_rng(4).integers(0, 256, 400_000).astype(np.uint8)
    shifted = np.concatenate([data[:90_001], data])
    starts = np.arange(0, 399_000, 97)
    here = common.RollingHash(data, common.BYTE_WORDS).of(starts, starts + 900)
    assert (here == common.RollingHash(shifted, common.BYTE_WORDS).of(starts + 90_001, starts + 90_901)).all()
    assert len(np.unique(here)) == len(starts)
    common.RollingHash(np.zeros(32 << 20, np.uint8), common.BYTE_WORDS)
    tables = (v for v in vars(common).values() if isinstance(v, np.ndarray))
    assert sum(v.nbytes for v in tables) < 4 << 20
    assert common.RollingHash(data[:0], common.BYTE_WORDS).of(np.array([0]), np.array([0])).shape == (1,)


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_generations_of_pieces(most):
    """Any bound gives the same ids; pieces that keep coming are encoded once as long as a generation holds them."""
    asked = []
    table = pretokens.PieceTable(lambda pieces: asked.extend(pieces) or [[p[0], len(p)] for p in pieces], most)
    rng = np.random.default_rng(most)
    for k in range(30):
        texts = [f" hot w{rng.integers(0, 40)} hot n{k} é".encode() for _ in range(5)]
        data, offsets = common.text_buffers(pa.array(texts))
        ids, bounds = table.encode(data, offsets)
        for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
            pieces = [m.encode() for m in regex.findall(public_tokenizers.PATTERN, text.decode())]
            assert ids[a:b].tolist() == [x for p in pieces for x in (p[0], len(p))]
    assert asked.count(b" hot") == 1
