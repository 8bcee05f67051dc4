"""Phrase collocations per language by direct-address tiling of adjacent pairs.

Units are counted level by level: words, pairs, then a frequent pair with the word after it,
then a frequent triple with the word after it. The most frequent units of a level are numbered
by falling frequency; a pair of two such numbers has its place in a tile, a square of 2**10 by
2**10 numbers. Tiles that hold many pairs of a task's buffer are counted by a dense ``bincount``,
all others as sorted coordinates with run lengths. Spark adds up what the tasks count. Phrases
that reach ``least`` are numbered anew by their frequency and are the next level's first halves;
a phrase is only counted where both phrases one word shorter are frequent, which loses none.

What tasks are sent is bounded whatever the vocabulary: the numbers of at most ``head`` units of
a level and a bitmap of ``2**BITMAP`` bits that marks all frequent units. Units beyond ``head``
are known by 62-bit hashes and counted as sorted coordinates; a false mark costs time only, for
totals below ``least`` go.

Defined cases: null and empty texts hold no words; a null lang is ``und``, an empty one its own;
repeated rows count each; an empty table gives an empty result; ids and other columns are not
read. Texts of any length are read whole, in parts of about 1 MiB cut where pieces end.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.session import stage

LEAST, LONGEST, COVER, TOP = 30, 4, 80, 2000
#: Units numbered by frequency, log2 of a tile's side, pairs that make a tile dense.
HEAD, SIDE, DENSE = 1 << 17, 10, 1 << 14
#: log2 of the bits that mark frequent units.
BITMAP = 26
#: Bytes split at once, words counted and pairs held before they are emitted.
AT_ONCE, WORDS_HELD, PAIRS_HELD = 1 << 20, 100_000, 1 << 20
#: Codes from here on are hashes of units without a number.
TAIL = 1 << 62

BREAK = b"\xff"  # a byte that UTF-8 never holds
_CODES = bytearray(range(256))
_CODES[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _CODES[_c] = BREAK[0]
_CODES = bytes(_CODES)


def _parts(text: bytes) -> Iterator[bytes]:
    """A translated text in parts of about AT_ONCE bytes, cut at breaks."""
    low = 0
    while len(text) - low > AT_ONCE:
        cut = text.find(BREAK, low + AT_ONCE)
        if cut < 0:
            break
        yield text[low:cut]
        low = cut
    yield text[low:]


def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Words by language in bounded lists, BREAK between pieces and between texts."""
    held: dict[str, list[bytes]] = defaultdict(list)
    sizes: Counter = Counter()

    def taken(lang: str) -> tuple[str, list[bytes]]:
        del sizes[lang]
        return lang, BREAK.join(held.pop(lang)).replace(BREAK, b" \xff ").split()

    for batch in batches:
        for lang, text in zip(batch.column(0), pc.cast(batch.column(1), pa.binary())):
            lang = lang.as_py()
            for part in _parts(text.as_py().translate(_CODES)):
                held[lang].append(part)
                sizes[lang] += len(part)
                if sizes[lang] >= AT_ONCE:
                    yield taken(lang)
        while sizes.total() >= 4 * AT_ONCE:  # of many languages
            yield taken(max(sizes, key=sizes.get))
    for lang in list(held):
        yield taken(lang)


def _read(docs: DataFrame, text: str, lang: str) -> DataFrame:
    kept = F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")
    return docs.where(F.col(text).isNotNull()).select(kept, F.col(text).alias("text"))


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word, n; each language's rows of null word hold its word occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, own in counts.items():
                own.pop(BREAK, None)
                words = pa.array(list(own), pa.binary()).cast(pa.string())
                words = pa.concat_arrays([words, pa.array([None], pa.string())])
                n = pa.array([*own.values(), sum(own.values())], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), words, n], ["lang", "word", "n"])
            counts.clear()

        for lang, words in words_of(batches):
            counts[lang].update(words)
            if sum(map(len, counts.values())) >= WORDS_HELD:
                yield from flush()
        yield from flush()

    parts = docs.mapInArrow(run, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def word_id(lang: bytes, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang + BREAK + word) & (TAIL - 1)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def phrase_ids(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """62-bit ids of phrases from the ids of all but the last word and of the last."""
    mixed = _scrambled(first.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) + word.astype(np.uint64)
    return (_scrambled(mixed) & np.uint64(TAIL - 1)).astype(np.int64)


class Units:
    """The frequent units of one level: numbers of the commonest, marks of all."""

    def __init__(self, by_rank: np.ndarray, bits: np.ndarray):
        self.by_rank, self.bits = by_rank, bits
        self.order = np.argsort(by_rank)
        self.sorted = by_rank[self.order]

    def marked(self, ids: np.ndarray) -> np.ndarray:
        at = ids & ((1 << BITMAP) - 1)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of the commonest units, TAIL + id of others that are marked, else -1."""
        out = np.full(len(ids), -1, np.int64)
        at = np.flatnonzero(self.marked(ids))
        some = ids[at]
        place = np.minimum(np.searchsorted(self.sorted, some), max(len(self.sorted) - 1, 0))
        known = self.sorted[place] == some if len(self.sorted) else np.zeros(len(some), bool)
        out[at] = np.where(known, self.order[place] if len(self.order) else -1, some + TAIL)
        return out

    def ids(self, codes: np.ndarray) -> np.ndarray:
        out = codes - TAIL
        near = codes < TAIL
        out[near] = self.by_rank[codes[near]]
        return out


def units_of(frequent: DataFrame, head: int) -> Units:
    """Numbers and marks of a staged table with id and n; both are bounded."""
    top = frequent.select("id", "n").orderBy(F.col("n").desc(), "id").limit(head)
    by_rank = np.array([r.id for r in top.collect()], np.int64)
    place = F.col("id").bitwiseAND(F.lit((1 << BITMAP) - 1))
    word = F.shiftright(place, 5)
    mark = F.expr("shiftleft(1L, CAST(id & 31 AS INT))")
    rows = frequent.groupBy(word.alias("word")).agg(F.bit_or(mark).alias("marks")).toPandas()
    bits = np.zeros(1 << (BITMAP - 5), "<u4")
    bits[rows["word"].to_numpy(np.int64)] = rows["marks"].to_numpy(np.int64)
    return Units(by_rank, bits.view(np.uint8))


class WordCodes(dict):
    """Codes of one language's numbered words; others are hashed and looked up."""

    def __init__(self, lang: str, units: Units, words: bytes = b"", numbers: Sequence[int] = ()):
        super().__init__(zip(words.split(), map(int, numbers)))
        self.lang, self.units = lang.encode(), units
        self[BREAK] = -1

    def __missing__(self, word: bytes) -> int:
        one = word_id(self.lang, word)
        at = one & ((1 << BITMAP) - 1)
        return one + TAIL if self.units.bits[at >> 3] >> (at & 7) & 1 else -1


def tiled(u: np.ndarray, w: np.ndarray, head: int, side: int, dense: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Counts of equal pairs of codes as (u, w, n), no pair twice."""
    near = (u < head) & (w < head)
    a, b = u[near], w[near]
    across = (head >> side) + 1
    tile = (a >> side) * across + (b >> side)
    heavy = np.bincount(tile, minlength=1) >= dense
    here = heavy[tile]
    if here.any():
        x, y, own = a[here], b[here], tile[here]
        order = np.argsort(own, kind="stable")
        x, y, own = x[order], y[order], own[order]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        low = (1 << side) - 1
        for start, end in zip(starts, np.r_[starts[1:], len(own)]):
            n = np.bincount((x[start:end] & low) << side | y[start:end] & low)
            cells = np.flatnonzero(n)
            yield (x[start] >> side << side) + (cells >> side), (y[start] >> side << side) + (cells & low), n[cells]
    a, b = a[~here], b[~here]
    cells, n = np.unique(a * head + b, return_counts=True)
    yield cells // head, cells % head, n
    a, b = u[~near], w[~near]
    if len(a):
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        yield a[starts], b[starts], np.diff(np.r_[starts, len(a)])


def count_phrases(docs: DataFrame, words: Broadcast, levels: list[Broadcast], head: int, side: int, dense: int) -> DataFrame:
    """u, w, n: phrases of one word more than ``levels`` by the ids of their first part and last word.

    ``words`` has the numbered words of each language and their numbers, ``levels`` the units
    of 1, 2, .. words.
    """
    size = len(levels) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = [x.value for x in levels]
        tables: dict[str, WordCodes] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                u, w = (np.concatenate(x) for x in zip(*held))
                for a, b, n in tiled(u, w, head, side, dense):
                    columns = units[-1].ids(a), units[0].ids(b), n
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["u", "w", "n"])
                held.clear()

        for lang, some in words_of(batches):
            if lang not in tables:
                tables[lang] = WordCodes(lang, units[0], *words.value.get(lang, (b"", [])))
            w = np.fromiter(map(tables[lang].__getitem__, some), np.int64, len(some))
            u = w
            for k in range(1, size - 1):  # u: phrases of k words, then of k + 1
                at = np.flatnonzero((u[:-1] >= 0) & (u[1:] >= 0))
                longer = np.full(max(len(u) - 1, 0), -1, np.int64)
                longer[at] = units[k].codes(phrase_ids(units[k - 1].ids(u[at]), units[0].ids(w[at + k])))
                u = longer
            at = np.flatnonzero((u[:-1] >= 0) & (u[1:] >= 0))
            held.append((u[at], w[at + size - 1]))
            n_held += len(at)
            if n_held >= PAIRS_HELD:
                yield from flush()
                n_held = 0
        yield from flush()

    pairs = docs.mapInArrow(run, "u long, w long, n long")
    return pairs.groupBy("u", "w").agg(F.sum("n").alias("n"))


def _with_ids(frequent: DataFrame, of_words: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if of_words:
                rows = zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist())
                ids = pa.array([word_id(x.encode(), y.encode()) for x, y in rows], pa.int64())
            else:
                ids = pa.array(phrase_ids(batch.column("u").to_numpy(), batch.column("w").to_numpy()))
            yield pa.RecordBatch.from_arrays([ids, *batch.columns], ["id", *batch.schema.names])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frequent.schema)
    return frequent.mapInArrow(run, f"id long, {fields}")


def phrases(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    text: str = "text",
    lang: str = "lang",
    head: int = HEAD,
    side: int = SIDE,
    dense: int = DENSE,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of at least ``least`` occurrences; (lang, n)."""
    read = _read(docs, text, lang)
    counted = stage(count_words(read).where((F.col("n") >= least) | F.col("word").isNull()), "words")
    words = stage(_with_ids(counted.where("word IS NOT NULL"), True), "units")
    send = docs.sparkSession.sparkContext.broadcast
    numbered: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
    for k, r in enumerate(words.orderBy(F.col("n").desc(), "id").limit(head).select("lang", "word").collect()):
        numbered[r.lang][0].append(r.word.encode())
        numbered[r.lang][1].append(k)
    spellings = send({x: (b" ".join(own), np.array(at, np.int32)) for x, (own, at) in numbered.items()})
    levels = [send(units_of(words, head))]
    word = words.select(F.col("id").alias("w"), F.col("word").alias("last"))
    named = words.select("id", "lang", F.col("word").alias("phrase"), "n")
    out = named.select("lang", "phrase", F.lit(1).alias("size"), F.col("n").alias("f"))
    for size in range(2, longest + 1):
        some = count_phrases(read, spellings, levels, head, side, dense).where(F.col("n") >= least)
        frequent = stage(_with_ids(some, False), f"phrases{size}")
        first = named.select(F.col("id").alias("u"), "lang", "phrase")
        named = frequent.join(first, "u").join(word, "w")
        named = named.select("id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "n")
        named = stage(named, f"named{size}")
        out = out.unionByName(named.select("lang", "phrase", F.lit(size).alias("size"), F.col("n").alias("f")))
        if size < longest:
            levels.append(send(units_of(frequent, head)))
    for x in (spellings, *levels):
        x.unpersist()
    return out, counted.where("word IS NULL").select("lang", "n")


def _joined(words: str, low: str, n: str):
    return F.expr(f"array_join(slice({words}, {low}, {n}), ' ')")


def collocations(
    counted: DataFrame, totals: DataFrame, cover: int = COVER, top: int | None = TOP
) -> DataFrame:
    """Scored phrases of two words and more, without those that a longer one covers.

    A phrase's cut of least score counts, ties to the shorter first part. ``top`` keeps
    each language's best; None keeps all.
    """
    parts = F.split("phrase", " ")
    longer = counted.where("size > 1").withColumn("words", parts)
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k",
        _joined("words", "1", "k").alias("first"), _joined("words", "k + 1", "size - k").alias("rest"),
    )
    l = counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    r = counted.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(l, ["lang", "first"]).join(r, ["lang", "rest"])
    score = F.expr("(CAST(a AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + r)")
    best = both.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r", "a")).alias("cut"))
    inside = longer.where("size > 2").select("lang", "f", "words", "size")
    inside = inside.withColumn("m", F.explode(F.expr("sequence(2, size - 1)")))
    inside = inside.withColumn("i", F.explode(F.expr("sequence(1, size - m + 1)")))
    inside = inside.groupBy("lang", _joined("words", "i", "m").alias("phrase")).agg(F.max("f").alias("outer_f"))
    kept = best.select("lang", "phrase", "cut.*").join(inside, ["lang", "phrase"], "left")
    covered = F.expr(f"CAST(outer_f AS DECIMAL(20,0)) * 100 >= CAST(a AS DECIMAL(20,0)) * {cover}")
    kept = kept.where(F.col("outer_f").isNull() | ~covered)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op13_collocations(spark, sf: str) -> DataFrame:
    return collocations(*phrases(spark.read.parquet(f"{sf}/documents.parquet")))


OP13_SQL = r"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM piece
), gram AS (
    SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM worded CROSS JOIN (VALUES (1), (2), (3), (4)) AS s (size) WHERE len(words) >= size)
    GROUP BY ALL
), total AS (
    SELECT lang, sum(f)::BIGINT AS n FROM gram WHERE size = 1 GROUP BY lang
), candidate AS (
    SELECT *, string_split(phrase, ' ') AS words FROM gram WHERE size > 1 AND f >= 30
), cut AS (
    SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
           ((2000000::HUGEINT * c.f) // (l.f + r.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate) AS c
    JOIN gram AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ')
    JOIN gram AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ')
), best AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrase AS (
    SELECT lang, f, array_to_string(words[i:i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, size - m + 2)) AS i
          FROM (SELECT *, unnest(range(2, size)) AS m FROM candidate WHERE size > 2))
), covering AS (
    SELECT lang, phrase, max(f) AS f FROM inner_phrase GROUP BY ALL
), kept AS (
    SELECT b.* FROM best AS b LEFT JOIN covering AS o ON o.lang = b.lang AND o.phrase = b.phrase
    WHERE o.f IS NULL OR 100::HUGEINT * o.f < 80::HUGEINT * b.a
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT k.*, t.n, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
      FROM kept AS k JOIN total AS t USING (lang))
WHERE rank <= 2000
"""
