"""Each operator against a brute-force reading, over documents with every awkward case."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import bpe, caches, chunking, components, mih, packing, partenum, quality, registry, secrets, sharding
from tallyfold.llm import suffixes, wordpiece
from tests.compare import compare, connect

#: Those that read other tables as well have files of their own.
OTHER = ("op1_", "op11_", "op12_")
DOCUMENT_QUERIES = sorted(q for q in registry.QUERIES if not q.startswith(OTHER))


def raw(text):
    return (text or "").encode()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_empty_table(spark, empty_sf, name):
    assert registry.QUERIES[name](spark, empty_sf).collect() == []


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql_twins(spark, name):
    for table in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        got, want, extra, missing = compare(registry.QUERIES[name](spark, table), connect(table), registry.ORACLES[name])
        assert (got, extra, missing) == (want, [], [])


# op5


def measures(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality(spark, sf, awkward):
    got = rows(registry.QUERIES["op5_quality_rules"](spark, sf).drop("fail_bits", "kept"))
    want = Counter()
    for i, t in awkward:
        m = measures(t)
        want[(i, *m, m[0] < 10 or 100 * m[4] > 20 * m[0])] += 1
    assert got == want


def test_quality_policies_and_ablation(spark, docs):
    bits = quality.ledger(quality.measure(docs)).cache()  # a filter would repeat the measurements
    one, two = (quality.apply_policy(bits, v).where("kept").count() for v in (1, 2))
    table = {r.rule: r for r in quality.ablate(bits, 2).collect()}
    assert set(table) == {r.name for r in quality.RULES} and two <= one
    for k, rule in enumerate(quality.RULES):
        mask = quality.mask_of([r.name for r in quality.RULES if r != rule])
        without = bits.where(F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0).count()
        failed = bits.where(F.expr(rule.fails)).count()
        assert (table[rule.name].n_failed, table[rule.name].n_kept_without) == (failed, without)
    kept = quality.kept_rows(docs, 2)
    assert kept.columns == docs.columns and kept.count() == two


# op2


def test_shards(spark, docs, sf, awkward, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 7)
    got = sharding.interleave(docs, shards=5).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len(raw(t)) + 8, zlib.crc32(raw(t))) for i, t in awkward
    )
    assert sorted(r.position for r in got) == list(range(len(awkward)))
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    for source in {r.stratum for r in got}:
        per = [sum(r.stratum == source for r in got if r.shard == s) for s in counts]
        assert max(per) - min(per) <= 2
    again = sharding.interleave(docs.repartition(3), shards=5).collect()
    key = lambda r: (r.position, r["size"], r.text_crc32)
    assert sorted(map(key, again)) == sorted(map(key, got))


# op3


def suffix_brute(awkward, length=100):
    unique = {}
    for i, t in awkward:
        unique[(i, raw(t))] = None
    order = sorted(unique, key=lambda d: -(2**63) if d[0] is None else d[0])
    seen, out = set(), {}
    for i, data in order:
        gone = bytearray(len(data))
        for a in range(len(data) - length + 1):
            if data[a : a + length] in seen:
                gone[a : a + length] = b"\1" * length
            seen.add(data[a : a + length])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[(i, data)] = (i, len(data), len(data) - len(kept), spans, sha(kept))
    return Counter(out[(i, raw(t))] for i, t in awkward)


@pytest.mark.parametrize("block, batch", [(10_000, 10_000), (2, 7), (1, 3)])
def test_suffix_dedup(spark, sf, awkward, monkeypatch, block, batch):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    monkeypatch.setattr(suffixes, "AT_ONCE", 1 if block < 100 else 1 << 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = rows(registry.QUERIES["op3_suffix_dedup"](spark, sf))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == suffix_brute(awkward)


def test_suffix_array():
    rnd = np.random.default_rng(4)
    for k in range(200):
        codes = np.append(rnd.integers(1, 3 + k % 3, rnd.integers(0, 80)), 0).astype(np.int64)
        depth = int(rnd.integers(1, 30))
        order = suffixes.suffix_array(codes, depth).tolist()
        prefixes = [tuple(codes[i : i + depth]) for i in order]
        assert sorted(order) == list(range(len(codes))) and prefixes == sorted(prefixes)


# op4


def secret_spans(text):
    text = text or ""
    a = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    b = [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    c = [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    spans = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(a + b + c))
    return len(a), len(b), len(c), sha(spans.encode())


def test_secrets(spark, sf, awkward):
    got = rows(registry.QUERIES["op4_secret_ledger"](spark, sf).drop("spans"))
    want = Counter((i, *secret_spans(t)) for i, t in awkward)
    assert got == want and sum(k[1] for k in want) >= 3


def test_secret_ledger_is_incremental(spark, docs):
    paths = secrets.addressed(docs)
    first = secrets.scan_unseen(paths, rules=secrets.RULES[:1]).cache()
    assert first.count() == paths.select("blob_id").distinct().count()
    assert secrets.scan_unseen(paths, first, secrets.RULES[:1]).count() == 0
    rest = secrets.scan_unseen(paths, first)
    assert {tuple(r.rules) for r in rest.select("rules").distinct().collect()} == {
        tuple(r.name for r in secrets.RULES[1:])
    }
    both = secrets.findings(paths, first.unionByName(rest))
    whole = secrets.findings(paths, secrets.scan_unseen(paths))
    text = secrets.joined(F.col("spans"))
    assert rows(both.select("doc_id", text)) == rows(whole.select("doc_id", text))


def test_a_new_rule_version_replaces_old_findings(spark, docs, awkward):
    """What an older version found is not given any more; kinds are numbered by the rules asked for."""
    paths = secrets.addressed(docs)
    old = secrets.scan_unseen(paths).cache()
    none = secrets.Rule("access", 2, "nothing like it")
    hex_first = (secrets.RULES[2], secrets.RULES[0], none)
    ledger = old.unionByName(secrets.scan_unseen(paths, old, hex_first))
    assert ledger.count() == 2 * old.count()  # only the new version was due
    got = rows(secrets.findings(paths, ledger, hex_first).select("doc_id", secrets.joined(F.col("spans"))))
    want = Counter()
    for i, t in awkward:
        a = [(m.start(), 1, m.end()) for m in re.finditer(secrets.ASSIGN, t or "", re.I | re.A) if len(m[2]) >= 6]
        c = [(m.start(), 0, m.end()) for m in re.finditer("[0-9a-f]+", t or "") if len(m[0]) >= 24]
        want[(i, ",".join(f"{('hex', 'assign')[k]}:{s}:{e}" for s, k, e in sorted(a + c)))] += 1
    assert got == want
    text = secrets.joined(F.col("spans"))
    again, before = (secrets.findings(paths, x).select("doc_id", text) for x in (ledger, old))
    assert rows(again) != got and rows(again) == rows(before)


def test_added_kinds(spark):
    """Planted secrets of the added kinds, by hand."""
    key = "-----BEGIN RSA PRIVATE KEY-----"
    jwt = "eyJ" + "a" * 10 + "." + "b-" * 5 + "." + "C_" * 5
    texts = {1: f"x ghp_{'A1' * 18} y", 2: f"{key}\nabc", 3: f"see {jwt}!", 4: "ghp_short eyJx.y.z BEGIN PRIVATE KEY", 5: f"gho_{'Z' * 40}{key}"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    paths = secrets.addressed(docs)
    got = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.spans] for r in secrets.findings(paths, secrets.scan_unseen(paths)).collect()}
    assert got == {1: [("github", 2, 42)], 2: [("pem", 0, len(key))], 3: [("jwt", 4, 4 + len(jwt))], 4: [], 5: [("github", 0, 44), ("pem", 44, 44 + len(key))]}


def test_redaction(spark, docs):
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns
    text = {r.doc_id: r.text for r in clean.collect()}
    assert text[0] == "" and "hunter22" not in text[13] and "<assign>" in text[13]
    assert secrets.scan_unseen(secrets.addressed(clean)).where("size(spans) > 0").count() == 0


# op6, op7


def test_byte_bpe(spark, sf, docs, awkward):
    import public_tokenizers
    import tiktoken

    merges = bpe.merges_for(bpe.default_ranks())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges.ranks, special_tokens={})
    want = Counter()
    for i, t in awkward:
        ids = library.encode_ordinary(t or "")
        want[(i, len(ids), sha(",".join(map(str, ids)).encode()), sha(raw(t)))] += 1
    assert rows(registry.QUERIES["op6_byte_bpe"](spark, sf)) == want
    encoded = bpe.encode(docs)
    assert Counter((r.doc_id, bytes(r.text)) for r in bpe.decode(encoded).collect()) == Counter((i, raw(t)) for i, t in awkward)
    for r in encoded.collect():
        assert len(r.ids) == len(r.ends) and sorted(r.ends) == r.ends


def test_long_merges_equal_short_ones():
    merges = bpe.merges_for(bpe.default_ranks())
    rnd = np.random.default_rng(1)
    for _ in range(40):
        data = bytes(rnd.choice(list(b"aetn \xc3\xa9"), rnd.integers(2, 300)).astype(np.uint8))
        assert merges.merge_long(data) == merges.merge(data)


def greedy(word, pieces, most):
    n = at = 0
    while at < len(word):
        end = next((e for e in range(min(len(word), at + most), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 1
        n, at = n + 1, end
    return n


def test_wordpiece_counts(spark, sf, awkward):
    pieces = set(wordpiece.pieces_of(wordpiece.default_model()))
    most = max(map(len, pieces))
    want = Counter()
    for i, t in awkward:
        ws = [w.decode() for w in raw(t).split()]
        want[(i, len(ws), sum(greedy("▁" + w, pieces, most) for w in ws))] += 1
    assert rows(registry.QUERIES["op7_wordpiece_counts"](spark, sf)) == want


def test_automaton_on_small_vocabularies():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        word = lambda n: "".join(rnd.choice(list("abc"), n))
        pieces = {word(int(rnd.integers(1, 5))) for _ in range(8)}
        automaton = wordpiece.Automaton(pieces)
        for _ in range(20):
            w = word(int(rnd.integers(1, 12)))
            assert automaton.count(w) == greedy(w, pieces, 5)


# op8


def test_chunk_dedup(spark, sf, docs, awkward):
    owner = lambda i: -(2**63) if i is None else i
    keeper = {}
    for i, t in awkward:
        for d in chunking.digests_of(raw(t))[1]:
            keeper[d] = min(keeper.get(d, owner(i)), owner(i))
    want = Counter()
    for i, t in awkward:
        data = raw(t)
        cuts, digests = chunking.digests_of(data)
        assert b"".join(data[a:b] for a, b in zip(cuts, cuts[1:])) == data
        assert all(b - a <= chunking.MOST for a, b in zip(cuts, cuts[1:]))
        runs = chunking.repeated_runs(data, {d for d in digests if keeper[d] < owner(i)})
        kept = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in runs)], [*(s for s, _ in runs), len(data)]))
        kept.decode()
        want[(i, len(data), len(data) - len(kept), len(runs), sha(kept))] += 1
    got = registry.QUERIES["op8_chunk_dedup"](spark, sf)
    assert rows(got) == want
    removed = {r.doc_id: r.n_removed for r in got.collect()}
    assert removed[21] > 200 and removed[22] > 400 and removed[16] == 0 and removed[17] > 700
    assert chunking.dedup(docs).columns == docs.columns


def test_chunks_resist_insertions():
    rnd = np.random.default_rng(3)
    data = bytes(rnd.integers(97, 123, 5000).astype(np.uint8))
    shifted = data[:1000] + b"some inserted text" + data[1000:]
    a, b = (chunking.digests_of(x)[1] for x in (data, shifted))
    assert len(set(a) - set(b)) <= 4


# op9


def test_packing(spark, sf, docs, awkward, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "GROUP_PIECES", 40)
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for i, t in awkward:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), 4096)):
            want[(i, k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes()))] += 1
    got = registry.QUERIES["op9_best_two_fit"](spark, sf).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096


def test_chunks_keep_the_tokenizers_ids():
    from tokenizers import Tokenizer

    tokenizer, chunks = Tokenizer.from_file(packing.default_tokenizer()), packing.Chunks(packing.default_tokenizer())
    rnd = np.random.default_rng(5)
    marks = list("ab J T Hṯ̈'s'LL.,;1 2\n\t é!ß　x\x1c\x85̌̈Σς<|K") + ["<|endoftext|>", "<|STARTOFTEXT|>", "don't, "]
    texts = ["".join(rnd.choice(marks, rnd.integers(0, 40))) for _ in range(3000)]
    for t, b in zip(texts, chunks.encode([t.encode() for t in texts])):
        assert np.frombuffer(b, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_best_two_fit_fills_well():
    rnd = np.random.default_rng(6)
    sizes = rnd.integers(1, 1500, 4000).tolist()
    bins = packing.best_two_fit(sizes)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 4096 for b in bins)
    assert len(bins) <= -(-sum(sizes) // 4096) + 1
    assert packing.best_two_fit([]) == [] and len(packing.best_two_fit([4096, 4096, 1])) == 3


def test_sequences_hold_the_ids(spark, docs):
    from tallyfold.session import stage

    packed = packing.pack(stage(packing.tokenized(docs, with_ids=True), "pieces"))
    for r in packing.sequences(packed).collect():
        assert len(r.ids) == 4 * r.n_tokens <= 4 * 4096


# op10


def jaccard_components(awkward):
    sets = []
    for i, t in awkward:
        w = raw(t).lower().split()
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.append((i, s))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return Counter((i, len(s), least.get(find(x))) for x, (i, s) in enumerate(sets))


@pytest.mark.parametrize("batch", [10_000, 5])
def test_jaccard_join(spark, sf, awkward, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        assert rows(registry.QUERIES["op10_partenum_join"](spark, sf)) == jaccard_components(awkward)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_jaccard_join_of_all_given_documents(spark):
    root = "/root/testdata/sf0.01"
    given = [tuple(r) for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(registry.QUERIES["op10_partenum_join"](spark, root)) == jaccard_components(given)


def test_word_hashes(awkward):
    seen = {}
    more = ["a", " a ", "a" * 9000 + " b\t", "\n x\ty  z", "AbC aBc", "  lead", "trail  ", "ab ba aab aba"]
    for text in [t for _, t in awkward] + more:
        words = raw(text).lower().split()
        found = partenum.word_hashes(raw(text)).tolist()
        assert len(found) == len(words)
        for word, h in zip(words, found):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_caches_of_other_operators_are_dropped():
    chunks = packing.chunks_for(packing.default_tokenizer())
    list(chunks.encode([b"some words"]))
    caches.keep_only(packing.__name__)
    assert packing.chunks_for(packing.default_tokenizer()) is chunks
    caches.keep_only(partenum.__name__)
    assert packing.chunks_for(packing.default_tokenizer()) is not chunks


def test_signatures_share_one_for_every_linked_pair():
    rnd = np.random.default_rng(7)
    for _ in range(1500):
        size = int(rnd.integers(1, 200))
        common = rnd.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2)
        own = [rnd.integers(0, 2**63, int(rnd.integers(0, size // 4 + 2)), dtype=np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([common, x])) for x in own)
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        assert partenum.least_differences(
            *(np.frombuffer(partenum.sketch_of(x), np.uint8)[None] for x in (a, b))
        )[0] <= len(a) + len(b) - 2 * both
        bits = np.bitwise_xor(*(partenum.parity_of(x) for x in (a, b)))
        assert np.bitwise_count(bits.view(np.uint64)).sum() <= len(a) + len(b) - 2 * both
        prefix = [np.concatenate([np.sort(s)[:need] for _, need, s in partenum.signatures(x)]) for x in (a, b)]
        assert len(np.intersect1d(*prefix))


def test_components(spark):
    chain = [(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (7, 7), (50, 50)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {90: 90, 95: 90, 100: 90}


# op1


def vectors():
    rnd = np.random.default_rng(8)
    table = [(k, rnd.normal(size=16).tolist()) for k in range(600)]
    table += [(600 + k, list(table[200][1])) for k in range(12)]  # ties
    bad = [None, [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0] * 3, []]
    return table, [(700 + k, v) for k, v in enumerate(bad)] + [(None, [1.0] * 16)]


@pytest.mark.parametrize("block", [8192, 5])
def test_nearest(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(mih, "BLOCK", block)
    good, bad = vectors()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in good + bad], "vec_id long, embedding array<double>, part int, code string")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = defaultdict(list)
    for r in registry.QUERIES["op1_multi_index_hashing"](spark, str(tmp_path)).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ids, v = np.array([i for i, _ in good]), np.array([v for _, v in good])
    assert sorted(got) == [i for i in ids if i % 100 == 0]
    found = total = 0
    for q in got:
        apart = np.sqrt(((v - v[ids == q][0]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, apart)) if ids[k] != q][:10]
        ranked = sorted(got[q])
        assert [r for r, _, _ in ranked] == list(range(1, 11))
        assert [(s, i) for _, i, s in ranked] == sorted((s, i) for _, i, s in ranked)
        assert all(abs(s - apart[ids == i][0]) < 1e-12 for _, i, s in ranked)
        found += len({i for _, i, _ in ranked} & set(ids[order].tolist()))
        total += 10
    assert found / total >= 0.9


@pytest.mark.parametrize("block", [8192, 7])
def test_nearest_with_repeated_rows_and_several_dimensions(spark, monkeypatch, block):
    """Rows that share an id count as one; each dimension is searched on its own, however rare."""
    monkeypatch.setattr(mih, "BLOCK", block)
    rnd = np.random.default_rng(4)
    given = [(k, rnd.normal(size=8).tolist()) for k in range(60)] + [(k, rnd.normal(size=3).tolist()) for k in range(100, 130)]
    given += [(100, given[0][1])] + [given[0]] * 30 + [given[5]] * 40 + [(7, rnd.normal(size=8).tolist())] * 3
    table = spark.createDataFrame(given, "vec_id long, embedding array<double>").repartition(3)
    got = defaultdict(list)
    for r in mih.nearest_neighbours(table, F.col("vec_id") % 50 == 0).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = defaultdict(dict)
    for q, x in given:
        for i, y in given:
            if q % 50 == 0 and i != q and len(x) == len(y):
                apart = float(np.sqrt(((np.array(x) - y) ** 2).sum()))
                want[q][i] = min(apart, want[q].get(i, apart))
    assert set(got) == {0, 50, 100}
    for q, near in got.items():
        near.sort()
        best = sorted((d, i) for i, d in want[q].items())[:10]
        assert [r for r, _, _ in near] == list(range(1, 11)) and len({i for _, i, _ in near}) == 10
        assert len({i for _, i, _ in near} & {i for _, i in best}) >= 9
        assert all(abs(s - want[q][i]) < 1e-9 for _, i, s in near)


def test_nearest_of_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (100, [2.0, 1.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    got = mih.nearest_neighbours(few, F.col("vec_id") % 100 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 100), (100, 1, 0)]
    assert mih.nearest_neighbours(few.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_recall_on_the_given_vectors(spark):
    import pyarrow.parquet as pq

    path = "/root/testdata/sf0.01"
    table = pq.read_table(f"{path}/embeddings.parquet")
    ids, v = table["vec_id"].to_numpy(), np.array(table["embedding"].to_pylist(), np.float64)
    got = defaultdict(set)
    for r in registry.QUERIES["op1_multi_index_hashing"](spark, path).collect():
        got[r.query_id].add(r.vec_id)
    found = 0
    for q in got:
        apart = ((v - v[ids == q][0]) ** 2).sum(axis=1)
        found += len(got[q] & {int(ids[k]) for k in np.lexsort((ids, apart)) if ids[k] != q} & set(
            [int(ids[k]) for k in np.lexsort((ids, apart)) if ids[k] != q][:10]
        ))
    assert found / (10 * len(got)) >= 0.9


def test_shared_signatures_are_read_once_whatever_the_batches(spark):
    rng = random.Random(5)
    data = [(s, rng.randrange(6)) for s in (rng.randrange(40) for _ in range(300))] + [(99, 1)] * 9 + [(77, k) for k in range(30)]
    signed = spark.createDataFrame(data, "sign long, set_id long").repartition(3)
    want = []
    for sign in {s for s, _ in data}:
        sets = [o for s, o in data if s == sign]
        want += [(sign, o, len(sets)) for o in set(sets) if len(set(sets)) > 1]
    for size in ("1", "7", "10000"):
        before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = partenum._members(signed)
            assert sorted(map(tuple, got.collect())) == sorted(want)
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def clustered(clusters, alone, size=60):
    """(doc_id, text): clusters of near copies, and texts that share most words without a link."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("aeioutnsr") for _ in range(9))
    out, common = [], [word() for _ in range(3 * size // 4)]
    for _ in range(clusters):
        base = [word() for _ in range(2 * size)]
        out += [" ".join(base[:k] + [word()] + base[k + 1 :]) for k in (0, 30, 60, 90, 2 * size - 1)]
    out += [" ".join(common + [word() for _ in range(size // 4 - 1)]) for _ in range(alone)]
    return list(enumerate(out))


def test_rounds_end_when_no_pairs_go_and_take_open_groups_only(spark, monkeypatch):
    given = clustered(8, 40)
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    rounds, groups, linked, mixed = [], [], partenum._linked, partenum._mixed
    monkeypatch.setattr(partenum, "_linked", lambda pairs, sets: rounds.append(1) or linked(pairs, sets))
    monkeypatch.setattr(partenum, "_mixed", lambda labelled, turn: groups.append(labelled.count()) or mixed(labelled, turn))
    # Whole signature groups, as of texts that share much and have little that is rare.
    monkeypatch.setattr(partenum, "FEW_PAIRS", 0)
    assert rows(partenum.near_duplicates(docs)) == jaccard_components(given)
    assert len(rounds) < partenum.ROUNDS and len(groups) == len(rounds)
    assert groups == sorted(groups, reverse=True) and groups[-1] < groups[1]


def test_pairs_left_are_counted_without_forming_them(spark):
    rng = random.Random(6)
    data = sorted({(rng.randrange(9), rng.randrange(50)) for _ in range(200)})
    labelled = spark.createDataFrame([(s, i, i % 4) for s, i in data], "sign long, set_id long, label long")
    got = partenum._mixed(labelled, 1)
    member = [(r.sign, r.set_id, r.label) for r in got.collect()]
    want = sum(x[0] == y[0] and x[1] < y[1] and x[2] != y[2] for x in member for y in member)
    assert partenum._left(got) == (len(member), want)
    assert got.where("pivot").count() == len({s for s, _, _ in member})
    assert partenum._left(got.limit(0)) == (0, 0)


def groups_of_sets(rng):
    """sign -> sets: passages that several sets share give many signatures, some single ones besides."""
    passages = [rng.sample(range(40), rng.randrange(2, 12)) for _ in range(25)]
    signs = rng.sample(range(2**48), 25 * 30 + 60)
    out = {s: passages[k % 25] for k, s in enumerate(signs[:-60])}
    # Most passages are not shared whole.
    out = {s: [x for x in sets if rng.random() < 0.9] for s, sets in out.items()}
    return out | {s: rng.sample(range(40), rng.randrange(1, 4)) for s in signs[-60:]}


def test_sets_that_share_many_signatures_are_paired_in_few_groups(spark):
    groups = {s: sets for s, sets in groups_of_sets(random.Random(12)).items() if len(sets) > 1}
    data = [(s, x, x % 7) for s, sets in groups.items() for x in sets]
    mixed = spark.createDataFrame(data, "sign long, set_id long, label long").repartition(3)
    parities = [F.lit(0).cast("long").alias(p) for p in partenum.PARITIES]
    known = spark.range(40).select(F.col("id").alias("set_id"), F.lit(90).cast("long").alias("n_shingles"), *parities)
    got = Counter((r.a, r.b) for r in partenum._rest(mixed, known).collect())
    met = Counter((x, y) for sets in groups.values() for x in sets for y in sets if x < y and x % 7 != y % 7)
    assert set(got) == set(met)
    assert all(got[p] in (1, met[p]) for p in met)
    assert sum(got.values()) < 0.2 * sum(met.values())


def test_signatures_that_the_same_sets_share_make_one_group(spark):
    groups = groups_of_sets(random.Random(13))
    data = [(s, x) for s, sets in groups.items() for x in sets]
    got = partenum._unlike(spark.createDataFrame(data, "sign long, set_id long").repartition(3)).collect()
    kept = {}
    for r in got:
        kept.setdefault(r.sign, set()).add(r.set_id)
    want = {frozenset(sets) for sets in groups.values() if len(sets) > 1}
    assert len(kept) == len(want) and {frozenset(x) for x in kept.values()} == want
    assert all(kept[s] == set(groups[s]) for s in kept) and len(got) == sum(map(len, kept.values()))


def test_rounds_take_one_of_the_groups_of_the_same_sets(spark, monkeypatch):
    given = clustered(6, 0)
    docs = spark.createDataFrame(given + [(1000 + i, t) for i, t in given], "doc_id long, text string").repartition(3)
    taken, mixed = [], partenum._mixed

    def noted(labelled, turn):
        sets = {}
        for r in labelled.collect():
            sets.setdefault(r.sign, set()).add(r.set_id)
        taken.append([frozenset(x) for x in sets.values()])
        return mixed(labelled, turn)

    monkeypatch.setattr(partenum, "_mixed", noted)
    assert rows(partenum.near_duplicates(docs)) == jaccard_components(given + [(1000 + i, t) for i, t in given])
    assert taken[0] and all(len(x) == len(set(x)) for x in taken)
