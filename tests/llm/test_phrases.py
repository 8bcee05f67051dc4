"""Phrase collocations against a plain reading of the contract."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyfold.llm import phrases, registry
from tests.llm.conftest import SCHEMA


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def read(rows, least, top=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = set()
    for lang, f in counts.items():
        candidates = [g for g, a in f.items() if len(g) > 1 and a >= least]
        covered = set()
        for g in candidates:
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    if 100 * f[g] >= 80 * f[g[i : i + size]]:
                        covered.add(g[i : i + size])
        rows = []
        for g in candidates:
            if g in covered:
                continue
            cuts = [(2000000 * f[g] // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            rows.append((-score, -f[g], " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


def texts(seed=4):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "É".lower(), "x-y", "'s", "漢字", "\x85", " "]
    rows = [(None, None), ("en", ""), ("en", " \t\n.,"), ("", "no lang " * 9), ("und", "a b a b")]
    for k in range(260):
        words = []
        for _ in range(rnd.randrange(1, 60)):
            r = rnd.random()
            if r < 0.15:
                words += ["New", "York"] + (["City", "Hall"] if rnd.random() < 0.7 else [])
            elif r < 0.2:
                words += ["a"] * rnd.randrange(1, 7)  # overlaps
            else:
                words.append(rnd.choice(vocabulary[: rnd.choice([4, 20, 67])]))
        glue = [rnd.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "; ", "\x0b", "\r\n"]) for _ in words]
        rows.append((rnd.choice(["en", "en", "de", None, "und"]), "".join(w + g for w, g in zip(words, glue))))
    return rows + [("en", rows[-1][1])] * 40


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def table(spark, rows):
    given = [(k, t, lang, None, 1, "phrase", "n", "size") for k, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(given, SCHEMA).repartition(4)


def collected(df):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(r) for r in df.select(names).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_query(spark, tmp_path, rows, table):
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = collected(registry.QUERIES["op13_collocations"](spark, str(tmp_path)))
    assert got == read(rows, 30) and len(got) > 30


@pytest.mark.parametrize("head, side, dense", [(1 << 17, 10, 1), (1 << 17, 2, 4), (8, 1, 3), (1, 0, 10**9), (0, 1, 1)])
def test_dense_sparse_and_unnumbered_units(rows, table, head, side, dense):
    """Whatever is numbered and however it is counted, the phrases are the same."""
    got = collected(phrases.collocations(*phrases.phrases(table, 12, head=head, side=side, dense=dense), top=None))
    assert got == read(rows, 12, None)


def test_top(rows, table):
    got = collected(phrases.collocations(*phrases.phrases(table, 10), top=7))
    assert got == read(rows, 10, 7)


def test_long_texts_in_parts(spark, monkeypatch, rows, table):
    monkeypatch.setattr(phrases, "AT_ONCE", 50)
    monkeypatch.setattr(phrases, "WORDS_HELD", 5)
    monkeypatch.setattr(phrases, "PAIRS_HELD", 20)
    for text in ("a b. c d, e\n" * 40, "no end " * 40, "", "." * 300):
        coded = text.encode().translate(phrases._CODES)
        parts = list(phrases._parts(coded))
        assert b"".join(parts) == coded
    big = " ".join(f"go on w{k % 7}{'.' if k % 5 == 0 else ''}" for k in range(600_000))
    long = spark.createDataFrame([("en", big), ("en", big.replace(".", ""))], "lang string, text string")
    got = collected(phrases.collocations(*phrases.phrases(long)))
    assert got == read([("en", big), ("en", big.replace(".", ""))], 30)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9 * 10**15 + 7
    counted = spark.createDataFrame(
        [("x", "p", 1, 3 * big), ("x", "q", 1, big + 1), ("x", "p q", 2, big), ("x", "p q r", 3, big // 2), ("x", "r", 1, big),
         ("x", "q r", 2, big // 2)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("x", 2**62)], "lang string, n long")
    got = {r.phrase: r.score for r in phrases.collocations(counted, totals).collect()}
    assert got["p q"] == 2000000 * big // (4 * big + 1)


def test_ids_and_marks():
    rnd = np.random.default_rng(0)
    first, word = rnd.integers(0, phrases.TAIL, (2, 100_000))
    ids = phrases.phrase_ids(first, word)
    assert len(np.unique(ids)) == len(ids) and (phrases.phrase_ids(word, first) != ids).all()
    assert ids.min() >= 0 and ids.max() < phrases.TAIL
