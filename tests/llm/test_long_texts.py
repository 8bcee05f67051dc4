"""Texts of several million characters: whole results, across every inner boundary."""

import hashlib
import random
import zlib

import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

from tallyfold.llm import registry, suffixes
from tests.llm.conftest import words
from tests.llm.test_operators import measures, secret_spans


def letters(n, seed):
    return bytes(random.Random(seed).choices(b"abcdefghijklmnopqrstuvwxyz", k=n)).decode()


@pytest.fixture(scope="module")
def long_sf(spark, tmp_path_factory):
    """A passage at the start, over the 4 MiB boundary and in a small document; secrets near the end."""
    passage, body = letters(300, 1), letters(suffixes.PART + 600_000, 2)
    at = suffixes.PART - 150
    big = passage + body[300:at] + passage + body[at + 300 :] + " token=abcdef123456 " + "é" * 40
    prose = " ".join(words(random.Random(k), 12) + "." for k in range(30_000))
    rows = [(1, big), (2, "x " + passage + " y"), (3, prose)]
    root = str(tmp_path_factory.mktemp("long"))
    given = [(*r, "source") for r in rows]
    spark.createDataFrame(given, "doc_id long, text string, source string").write.parquet(f"{root}/documents.parquet")
    return root, dict(rows)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_suffix_dedup(spark, long_sf):
    root, texts = long_sf
    got = by_id(registry.QUERIES["op3_suffix_dedup"](spark, root))
    assert (got[1].n_removed, got[1].n_spans) == (300, 1)
    kept = texts[1][: suffixes.PART - 150] + texts[1][suffixes.PART + 150 :]
    assert got[1].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert (got[2].n_removed, got[2].n_spans) == (300, 1)
    assert got[2].kept_sha256 == hashlib.sha256(b"x  y").hexdigest()


def test_secrets_and_quality(spark, long_sf):
    root, texts = long_sf
    got = by_id(registry.QUERIES["op4_secret_ledger"](spark, root))
    for i, t in texts.items():
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex, got[i].base_sha256) == secret_spans(t)
    quality = by_id(registry.QUERIES["op5_quality_rules"](spark, root))
    for i, t in texts.items():
        r = quality[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measures(t)


def test_byte_bpe(spark, long_sf):
    import public_tokenizers

    root, texts = long_sf
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(registry.QUERIES["op6_byte_bpe"](spark, root))
    ids = plain.encode_ordinary(texts[3])
    assert got[3].n_tokens == len(ids)
    assert got[3].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    for i, t in texts.items():
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_packing_and_shards(spark, long_sf):
    root, texts = long_sf
    pieces = registry.QUERIES["op9_best_two_fit"](spark, root).collect()
    for i in texts:
        own = sorted((r.piece, r.start, r.length) for r in pieces if r.doc_id == i)
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert all(n == 4096 and s == 4096 * p for p, s, n in own[:-1])
    shards = by_id(registry.QUERIES["op2_stratified_shards"](spark, root))
    for i, t in texts.items():
        assert (shards[i].size, shards[i].text_crc32) == (len(t.encode()) + 8, zlib.crc32(t.encode()))


def test_sets_chunks_and_scores(spark, long_sf):
    root, texts = long_sf
    sets = by_id(registry.QUERIES["op10_partenum_join"](spark, root))
    for i, t in texts.items():
        w = t.split()
        shingles = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
        assert (sets[i].n_shingles, sets[i].component_id) == (len(shingles), i)
    chunks = by_id(registry.QUERIES["op8_chunk_dedup"](spark, root))
    assert 200 <= chunks[2].n_removed <= 300 and chunks[3].n_removed == 0
    assert chunks[1].n_bytes == len(texts[1].encode())
