"""Byte-level BPE and wavelet shards against the public libraries."""

import base64
import hashlib
import inspect
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bytebpe, wavelet
from tidemark.session import folder

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")


def strange_texts(n=1500):
    rng = random.Random(2)
    pick = lambda: chr(
        rng.choice(
            [
                rng.randrange(32, 0x2FFF),
                rng.randrange(0x3000, 0xD7FF),
                rng.randrange(0x10000, 0x10FFFF),
                rng.randrange(0x300, 0x370),
                rng.choice((9, 10, 13, 32, 32, 39, 0x85, 0xA0)),
                rng.randrange(128),
            ]
        )
    )
    texts = ["".join(pick() for _ in range(rng.randrange(40))) for _ in range(n)]
    return texts + ["", " " * 3000, "a" * 9000, "\n \n  b   c\r\n", "<|endoftext|> x", "it's, we'll. x.. 's. A.b, ǅ. ΟΣ. İ, é. K."]


@pytest.fixture(scope="module")
def truth():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def words():
    tool = Tokenizer.from_file(WORDS)
    tool.encode_special_tokens = True
    return tool


def test_bytes_as_the_library(truth):
    tool = bytebpe.ByteBpe(RANKS, PATTERN)
    texts = strange_texts()
    for text, ids in zip(texts, tool.encode_batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == truth.encode_ordinary(text)
        assert tool.decode_bytes(ids) == text.encode()


def test_offsets_and_split_characters(truth):
    tool = bytebpe.ByteBpe(RANKS, PATTERN)
    text = "naïve 🙂 日本語 x"
    ids = next(tool.encode_batch([text]))
    starts, ends = tool.offsets(text, ids)
    lengths = [len(tool.bytes[i]) for i in np.frombuffer(ids, "<u4")]
    at = 0
    for n, s, e in zip(lengths, starts, ends):
        covered = text.encode()[at : at + n]
        assert covered in text[s:e].encode() and len(text[s:e].encode()) < n + 8
        at += n
    singles = [ids[k : k + 4] for k in range(0, len(ids), 4)]
    assert "".join(tool.decode_parts(singles)) == text
    assert any("\ufffd" in tool.decode(one) for one in singles)  # a character lies across tokens


def test_cache_starts_anew(monkeypatch, truth):
    monkeypatch.setattr(bytebpe, "CACHE", 3)
    tool = bytebpe.ByteBpe(RANKS, PATTERN)
    texts = ["one two three four", "four five six", "one seven"] * 3
    got = [np.frombuffer(x, "<u4").tolist() for x in tool.encode_batch(texts)]
    got += [np.frombuffer(next(tool.encode_batch([t])), "<u4").tolist() for t in texts]
    assert got == [truth.encode_ordinary(t) for t in texts * 2]


def test_bpe_report(odd, truth):
    want = Counter()
    for r in odd.collect():
        t = r.text or ""
        ids = truth.encode_ordinary(t)
        packed = np.array(ids, "<u4").tobytes()
        want[(r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in bytebpe.bpe_report(odd, RANKS, PATTERN).collect()) == want


def test_rows_and_round_trip(odd):
    coded = bytebpe.encoded(odd, RANKS, PATTERN, with_offsets=True)
    back = bytebpe.decoded(coded, RANKS, PATTERN)
    pairs = back.select("row.row.text", F.col("text").alias("again")).collect()
    assert all((a or "") == b for a, b in pairs) and len(pairs) == odd.count()
    sizes = coded.select(F.size("starts") == F.col("n_tokens"), F.size("ends") == F.col("n_tokens")).collect()
    assert all(a and b for a, b in sizes)


def test_words_as_the_library(words, monkeypatch):
    texts = strange_texts()
    want = [words.encode(t, add_special_tokens=False).ids for t in texts]
    tool = wavelet.WordBpe(WORDS)
    assert [x.tolist() for x in tool.encode_batch(texts)] == want
    monkeypatch.setattr(wavelet, "CACHE", 5)
    small = wavelet.WordBpe(WORDS)
    assert [x.tolist() for x in small.encode_batch(texts[:200])] == want[:200]


def test_another_vocabulary_encodes_whole_texts(tmp_path):
    """Upper case kept, or white space kept: the words in a row would give other ids."""
    assert wavelet.WordBpe(WORDS).by_word
    with open(WORDS, encoding="utf-8") as f:
        settings = json.load(f)
    plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    for name, change in (("case", {"normalizer": {"type": "NFC"}}), ("blanks", {"pre_tokenizer": plain})):
        where = tmp_path / f"{name}.json"
        where.write_text(json.dumps({**settings, **change}), encoding="utf-8")
        tool, library = wavelet.WordBpe(str(where)), Tokenizer.from_file(str(where))
        texts = ["", "Two Words\n\tand  MORE", "don't. \u00c9t\u00e9 42"]
        assert not tool.by_word
        end = np.array([1], dtype="<u2").tobytes()
        assert [x.tolist() for x in tool.encode_batch(texts, end)] == [
            [*library.encode(x, add_special_tokens=False).ids, 1] for x in texts
        ]
    with pytest.raises(ValueError):
        wavelet.WordBpe(WORDS, "<u1")


@pytest.mark.parametrize("n", [0, 1, 9, 5000])
def test_planes_are_stable_partitions(n):
    """Bit by bit, zeros first; and no array is indexed by a mask, which costs twice as much."""
    ids = np.random.default_rng(n).integers(0, 49_000, n).astype(np.uint16)
    shard = wavelet.WaveletShard(wavelet.WaveletShard.build([3], [ids]))
    now = ids
    for k in range(16):
        ones = (now >> (15 - k) & 1).astype(bool)
        if n:
            assert (np.unpackbits(shard._plane(k)[0], count=n) == ones).all()
        now = np.concatenate([now[~ones], now[ones]])
    assert (shard.tokens() == ids).all()
    assert "[~ones]" not in inspect.getsource(wavelet.WaveletShard.build)


@pytest.mark.parametrize("bits, n", [(16, 20_000), (3, 5000), (20, 9000), (16, 1), (16, 0)])
def test_wavelet_lookup(bits, n):
    rng = np.random.default_rng(bits + n)
    ids = rng.integers(0, 1 << bits, n) % rng.integers(1, 1 << bits) if n else np.empty(0, int)
    docs = [ids[: n // 3], ids[n // 3 : n // 3], ids[n // 3 :]]
    shard = wavelet.WaveletShard(wavelet.WaveletShard.build([3, None, 5], docs, bits))
    assert shard.doc_ids() == [3, None, 5] and shard.starts().tolist() == [0, n // 3, n // 3, n]
    assert shard.tokens().tolist() == ids.tolist()
    for i in rng.integers(0, n, 40) if n else ():
        assert shard.access(int(i)) == ids[i]
        places = np.flatnonzero(ids == ids[i])
        low, high = sorted(rng.integers(0, n + 1, 2).tolist())
        assert shard.count(int(ids[i]), low, high) == int((ids[low:high] == ids[i]).sum())
        j = int(rng.integers(len(places)))
        assert shard.occurrence(int(ids[i]), j) == places[j]
        with pytest.raises(IndexError):
            shard.occurrence(int(ids[i]), len(places))
    assert shard.count(1 << bits) == 0


def expected_rows(rows, words):
    rows = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, (r.text or "").encode()))
    start, want = 0, []
    for r in rows:
        ids = words.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(want, key=lambda x: x[1])


@pytest.mark.parametrize("shard_tokens", [50, wavelet.SHARD_TOKENS])
def test_wavelet_files(odd, words, shard_tokens):
    path = folder(odd.sparkSession, "test-shards")
    wavelet.write_shards(odd, WORDS, 1, path, shard_tokens)
    shards = wavelet.read_shards(odd.sparkSession, path)
    got = sorted((tuple(r) for r in wavelet.documents_of(shards).collect()), key=lambda x: x[1])
    assert got == expected_rows(odd.collect(), words)
    ends = wavelet.token_counts(shards, [1]).agg(F.sum("n")).first()[0]
    ones = sum(words.encode(r.text or "", add_special_tokens=False).ids.count(1) for r in odd.collect())
    assert ends == odd.count() + ones


def test_empty_tables(empty):
    assert bytebpe.bpe_report(empty, RANKS, PATTERN).collect() == []
    assert wavelet.wavelet_report(empty, WORDS).collect() == []
