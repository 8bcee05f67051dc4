"""Nearest neighbours by multi-index hashing of learned binary codes.

Fit, on a bounded sample: the mean and principal axes, a rotation that makes the signs of the
rotated axes lose least (iterative quantisation), and the Hamming radius within which the
sample's own true neighbours lie. A vector's code is those signs.

Index: each code is cut into substrings, and every row stands in one bucket per substring.
Two codes within the radius agree, in at least one substring, up to the radius divided by the
number of substrings; so probing the buckets that close to the query's substrings retrieves
every code within the radius. A pair is taken up in the first substring that finds it, its
Hamming distance checked, and its vectors compared in double precision.

Buckets are cut into blocks of bounded size on both sides, by counts over all rows, so a
bucket that many rows share spreads over many tasks, and each block gives at most the wanted
number of neighbours per query. Queries that found too few are compared with every row.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows without an id; vectors of each dimension are searched among themselves; rows with
the query's own id are no candidates; rows that share an id, repeated or not, count as one, at
the least distance between any of theirs and any of the query's; equal distances go to smaller
ids; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.session import stage

#: Rows the codes and the radius are fitted on, and of these, queries for the radius.
SAMPLE, SAMPLE_QUERIES = 20_000, 400
BITS, SUBSTRING = 64, 8
#: Share of the sample's true neighbours that the radius must hold.
WITHIN = 0.98
NEAREST = 10
#: Rows of a bucket, and queries that probe it, that meet in one group.
BLOCK = 8_192


@dataclass(frozen=True)
class Codes:
    """A fitted code: sign((vector - mean) @ axes), and the radius to search."""

    mean: np.ndarray
    axes: np.ndarray
    radius: int

    @property
    def bits(self) -> int:
        return self.axes.shape[1]

    @property
    def widths(self) -> list[int]:
        n = max(1, -(-self.bits // SUBSTRING))
        return [self.bits // n + (k < self.bits % n) for k in range(n)]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        signs = (vectors - self.mean) @ self.axes > 0
        return signs.astype(np.uint64) @ (np.uint64(1) << np.arange(self.bits, dtype=np.uint64))

    def substrings(self, codes: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for w in self.widths:
            out.append((codes >> np.uint64(at)) & np.uint64((1 << w) - 1))
            at += w
        return out

    def reach(self, radius: int) -> list[int]:
        """Per substring, how far its probes go; -1: none. Sum of (reach + 1) is over radius."""
        n = len(self.widths)
        if radius >= self.bits:
            return [self.widths[0]] + [-1] * (n - 1)
        return [radius // n - (k > radius % n) for k in range(n)]


def fit(sample: np.ndarray, seed: int = 11) -> Codes:
    """Codes from sample vectors, one per row."""
    if not len(sample):
        return Codes(np.zeros(1), np.eye(1), 1)
    mean = sample.mean(axis=0)
    centred = sample - mean
    bits = min(BITS, sample.shape[1])
    _, vectors = np.linalg.eigh(centred.T @ centred)
    axes = vectors[:, ::-1][:, :bits]
    flat = centred @ axes
    rotation = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).normal(size=(bits, bits)))[0]
    for _ in range(40):
        u, _, vt = np.linalg.svd(np.where(flat @ rotation > 0, 1.0, -1.0).T @ flat)
        rotation = (u @ vt).T
    codes = Codes(mean, axes @ rotation, bits)
    own = codes.of(sample)
    far = []
    for k in range(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES)):
        apart = np.einsum("ij,ij->i", sample - sample[k], sample - sample[k])
        apart[k] = np.inf
        near = np.argsort(apart, kind="stable")[: min(NEAREST, len(sample) - 1)]
        far += np.bitwise_count(own[near] ^ own[k]).tolist()
    radius = int(np.ceil(np.quantile(far, WITHIN))) if far else bits
    return Codes(mean, codes.axes, min(bits, radius))


def sound(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and vector of the rows that take part, of any dimension."""
    whole = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(embedding)
    return table.where(F.col(vec_id).isNotNull() & F.forall(v, whole) & F.exists(v, lambda x: x != 0)).select(
        F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector")
    )


def fitted(rows: DataFrame) -> Codes:
    """Codes from a sample by hashed id: bounded, and the same on every run."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE).toArrow().column("vector").to_pylist()
    return fit(np.array(sample, np.float64).reshape(len(sample), -1) if sample else np.empty((0, 1)))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def coded(rows: DataFrame, codes: Codes) -> DataFrame:
    """vec_id, vector and code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                own = codes.of(_matrix(batch.column(1))).view(np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=["vec_id", "vector", "code"])

    kind = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, vector {kind}, code long")


def _cut(code: str, codes: Codes):
    """Array of (substring number, its value)."""
    at, parts = 0, []
    for k, w in enumerate(codes.widths):
        value = F.shiftrightunsigned(F.col(code), at).bitwiseAND(F.lit((1 << w) - 1)).cast("int")
        parts.append(F.struct(F.lit(k).alias("part"), value.alias("value")))
        at += w
    return parts


def search_within(queries: DataFrame, index: DataFrame, codes: Codes, radius: int, nearest: int) -> DataFrame:
    """(query_id, vec_id, score): of every block that a query probes, the nearest within radius."""
    reach = codes.reach(radius)
    used = [k for k, r in enumerate(reach) if r >= 0]
    parts = _cut("code", codes)
    flips = F.create_map(
        *[
            x
            for k in used
            for x in (
                F.lit(k),
                F.array(*[F.lit(sum(1 << b for b in c)) for n in range(reach[k] + 1) for c in combinations(range(codes.widths[k]), n)]),
            )
        ]
    )
    own = index.select("vec_id", "vector", "code", F.inline(F.array(*[parts[k] for k in used])))
    asked = queries.select("vec_id", "vector", "code", F.inline(F.array(*[parts[k] for k in used]))).select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("wanted"), F.col("code").alias("query_code"), "part", F.col("value").alias("exact"), F.explode(flips[F.col("part")]).alias("flip")
    )
    asked = asked.withColumn("value", F.col("exact").bitwiseXOR(F.col("flip"))).drop("exact", "flip")
    # At most 2 ** SUBSTRING buckets per substring: a table of bounded size.
    many = lambda df, name: df.groupBy("part", "value").agg((F.floor((F.count("*") - 1) / BLOCK) + 1).cast("int").alias(name))
    blocks = stage(many(own, "own_blocks").join(many(asked, "asked_blocks"), ["part", "value"]), "buckets")
    blocks = F.broadcast(blocks)
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = own.join(blocks, ["part", "value"]).select(
        "*", F.pmod(F.xxhash64("vec_id"), "own_blocks").cast("int").alias("own_block"), spread("asked_blocks").alias("asked_block")
    )
    asked = asked.join(blocks, ["part", "value"]).select(
        "*", F.pmod(F.xxhash64("query_id"), "asked_blocks").cast("int").alias("asked_block"), spread("own_blocks").alias("own_block")
    )
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not (len(left) and len(right)):
            return out.empty_table()
        part = key[0].as_py()
        ids, vectors = left["vec_id"].to_numpy(), _matrix(left["vector"])
        repeated = len(np.unique(ids)) < len(ids)
        there = left["code"].to_numpy().view(np.uint64)
        found: list[list[np.ndarray]] = [[], [], []]
        query_ids, wanted = right["query_id"].to_numpy(), _matrix(right["wanted"])
        for one, vector, code in zip(query_ids, wanted, right["query_code"].to_numpy().view(np.uint64)):
            apart = there ^ code
            take = (np.bitwise_count(apart) <= radius) & (ids != one)
            for k, piece in enumerate(codes.substrings(apart)[:part]):
                if reach[k] >= 0:  # found there already
                    take &= np.bitwise_count(piece) > reach[k]
            at = np.flatnonzero(take)
            if len(at):
                score = np.sqrt(((vectors[at] - vector) ** 2).sum(axis=1))
                best = np.lexsort((ids[at], score))
                if repeated:  # of rows that share an id, the nearest counts
                    best = best[np.sort(np.unique(ids[at][best], return_index=True)[1])]
                best = best[:nearest]
                for to, x in zip(found, (np.full(len(best), one), ids[at][best], score[best])):
                    to.append(x)
        columns = [np.concatenate(x) if x else np.empty(0) for x in found]
        return pa.Table.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, out)], schema=out)

    keys = ["part", "value", "own_block", "asked_block"]
    own = own.select(*keys, "vec_id", "vector", "code").groupBy(*keys)
    asked = asked.select(*keys, "query_id", "wanted", "query_code").groupBy(*keys)
    return own.cogroup(asked).applyInArrow(meet, "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, nearest: int) -> DataFrame:
    """The nearest of each query id; rows that share an id count as one, at their least distance."""
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)


def nearest_neighbours(
    table: DataFrame, is_query, nearest: int = NEAREST, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found for each row where ``is_query`` holds.

    ``is_query`` is a condition on ``vec_id``. Fits on a sample at the driver, writes the
    coded rows and the first results to the shared folder.
    """
    rows = sound(table, vec_id, embedding)
    sizes = [r["size"] for r in rows.where(is_query).select(F.size("vector").alias("size")).distinct().collect()]
    found = [_nearest(rows.where(F.size("vector") == n), is_query, nearest) for n in sorted(sizes) or [0]]
    if len(found) == 1:
        return found[0]
    every = reduce(DataFrame.unionByName, found).drop("rank")
    return _ranked(every, nearest).select("query_id", "rank", "vec_id", "score")


def _nearest(rows: DataFrame, is_query, nearest: int) -> DataFrame:
    """The search among vectors of one dimension."""
    codes = fitted(rows)
    index = stage(coded(rows, codes), "codes")
    queries = index.where(is_query)
    first = stage(_ranked(search_within(queries, index, codes, codes.radius, nearest), nearest), "nearest")
    done = first.where(F.col("rank") == nearest).select(F.col("query_id").alias("vec_id"))
    short = stage(queries.join(done, "vec_id", "left_anti"), "short")
    rest = _ranked(search_within(short, index, codes, codes.bits, nearest), nearest)
    found = first.join(done.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi")
    return found.unionByName(rest).select("query_id", "rank", "vec_id", "score")


def op1_multi_index_hashing(spark, sf: str) -> DataFrame:
    return nearest_neighbours(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
