"""The corpus pipeline against its stages written out by hand."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tallyfold.llm import chunking, packing, quality, secrets
from tests.llm.test_operators import jaccard_components, measures, raw


def owner(i):
    return -(2**63) if i is None else i


def keeps(text):
    n_words, word_chars, n_symbols, n_dup, n_repeat = measures(text)
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    fails = {
        "few_words": n_words < 10,
        "repeated_words": 100 * n_repeat > 20 * n_words,
        "short_words": word_chars < 2 * n_words,
        "long_words": word_chars > 20 * n_words,
        "symbols": 100 * n_symbols > 10 * word_chars,
        "repeated_lines": len(lines) >= 4 and 100 * n_dup > 30 * len(lines),
    }
    return not any(fails[r] for r in quality.POLICIES[max(quality.POLICIES)])


def by_hand(rows):
    rows = [(i, t) for i, t in rows if keeps(t)]
    rows = list(dict.fromkeys(rows))
    named = [(k, t) for k, (_, t) in enumerate(sorted(rows, key=lambda r: owner(r[0])))]
    ids = [i for i, _ in sorted(rows, key=lambda r: owner(r[0]))]
    stay = {k for k, _, c in jaccard_components(named) if k == c}
    rows = [(ids[k], t) for k, t in named if k in stay]
    keeper = {}
    for i, t in rows:
        for d in chunking.digests_of(raw(t))[1]:
            keeper[d] = min(keeper.get(d, owner(i)), owner(i))
    cut = []
    for i, t in rows:
        data = raw(t)
        digests = chunking.digests_of(data)[1]
        runs = chunking.repeated_runs(data, {d for d in digests if keeper[d] < owner(i)})
        edges = [0, *(x for r in runs for x in r), len(data)]
        cut.append((i, b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])).decode()))
    rules = [(k, r, re.compile(r.pattern, r.flags)) for k, r in enumerate(secrets.RULES)]
    clean = [(i, secrets._without(t, secrets.spans_of(t, rules))) for i, t in cut]
    out = Counter()
    chunks = packing.Chunks(packing.default_tokenizer())
    for (i, _), ids_of in zip(clean, chunks.encode([t.encode() for _, t in clean])):
        ids_of += np.array([1], "<u4").tobytes()
        for k, a in enumerate(range(0, len(ids_of), 4 * 4096)):
            part = ids_of[a : a + 4 * 4096]
            out[(i, k, a // 4, len(part) // 4, zlib.crc32(part))] += 1
    return out


def test_pipeline_rows(spark, sf, awkward):
    got = corpus_pipeline.run(spark, sf).collect()
    assert Counter(tuple(r)[:5] for r in got) == by_hand(awkward)
    used = Counter()
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES) - 1))
def test_stages_keep_the_columns(spark, docs, no_docs, sf, k):
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, docs, sf)
    assert out.columns == docs.columns and out.count() > 0
    assert stage(spark, no_docs, sf).collect() == []


def test_clean_documents_pass_whole(spark, docs, sf):
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, sf)
    left = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    for k in (16, 20, 23):
        assert left[k] == (rows[k], len(rows[k]))
    assert 17 not in left and 18 not in left and 19 not in left
