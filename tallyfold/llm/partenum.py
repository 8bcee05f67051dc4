"""N-gram Jaccard join by PartEnum signatures, and the components of its links.

A document's set holds the 64-bit hashes of its distinct five-word shingles. Sets with the same
elements become one. Two sets of sizes s and t link when their Jaccard similarity is 3/4 or
more; then they differ in at most (s + t) / 7 elements, and their sizes by a third at most.

Signatures. Sets are put in bands of sizes; a set that can link into the next band takes part
in that band too. Per band, the domain of shingles is cut into first-level parts, each into two
second-level parts, and of every two the subsets of one are enumerated: a signature is the band,
the part and the elements of the set that lie there. Each element in which two sets differ
spoils one part at most, so a set with more parts in use than it may have differences, say
k, shares a signature with every set it links to. Sets with k or fewer parts in use also give
every element as a signature of its own, which always suffices.

Prefix. In any order common to all sets, the first k + 1 signatures of a set are enough, by the
prefix principle. The order is by how many sets share a signature, counted over all of them, so
passages that many documents hold come last and do not bring their documents together.

Links. Signatures that the same sets share make one group. In a group of sets that share a
signature, all are compared with one pivot; after some rounds with other pivots, only sets still
in different components are paired. Each round takes the groups that the last one left in several
components; rounds end when hardly a pair fewer is left, as further pivots would only cost
shuffles. Copies and near copies cost a few comparisons each, never all pairs. Of the groups that
two sets share, they meet in one: each set has the least of its signatures in sixteen orders, and
the first that two sets have in common is where they are paired. Where two sets meet, their sizes
and the parities of 1,024 buckets bound the differences from below, within the join; then sketches
of fixed size do, and at last the sets are intersected. No link is lost.

What stays: sets that are not linked but share between about 2/3 and 6/7 of their shingles with
many others still have their parities compared in pairs. Nothing is dropped for that. Sets that
have none of their least signatures in common, as is likely only where they share few of many,
are paired in every group they share.

Defined cases: null and empty texts have empty sets and link with nothing; with fewer than five
words the whole sequence is the one shingle; rows that repeat an id and text link as copies;
null ids stay null and never are a component's id unless all its ids are null; very long texts
are one large set, hashed whole; an empty table gives an empty result. Only the named columns
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.llm import caches
from tallyfold.llm.components import components
from tallyfold.session import stage

WORDS = 5
#: Link when OF * intersection >= AT_LEAST * union.
AT_LEAST, OF = 75, 100
#: Bands of sizes are powers of this. Parts per element of a band's largest set.
BAND, PARTS = 3, 0.36
#: Buckets of a sketch; each takes a byte for a count and a byte for a sum.
BUCKETS = 128
#: Rounds of pivots at most, and the pairs per member row at which they end before.
ROUNDS, FEW_PAIRS = 6, 1
#: Rounds also end after one that leaves more than this part of the pairs.
STALLED = 0.9
#: Stands for a null id where rows are told apart by id.
FIRST_ID = -(2**63)
#: Bits of a parity sketch.
PARITY = 1024
#: Signatures have 48 bits, the lowest six of them for the band; fewer only cost comparisons.
BAND_BITS = 6
#: Orders of signatures, of which each set gives its least: by the bits after a change of some.
ORDERS = 16

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

_ODDS = [np.uint64(int(_M1) * (2 * k + 3) % 2**64 | 1) for k in range(WORDS)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


#: For each byte of a word, letters in either case alike, a random number; white space has none.
_BYTES = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _M1) | np.uint64(1)
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_BYTES[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = 0


def _weights(n: int) -> np.ndarray:
    """For each place in a word a random odd number."""
    return _mix((np.arange(n, dtype=np.uint64) + np.uint64(1000)) * _M2) | np.uint64(1)


_PLACES = _weights(1 << 12)


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, A-Z as a-z: sums of byte times place."""
    numbers = _BYTES[np.frombuffer(raw, np.uint8)]
    inside = np.zeros(len(raw) + 2, bool)
    np.not_equal(numbers, 0, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    longest = int(sizes.max())
    weights = _PLACES if longest < len(_PLACES) else _weights(longest + 1)
    # Places count from the word's start; white space behind it adds nothing, wherever it is.
    place = np.ones(len(raw), np.int64)
    place[0] = -int(starts[0])
    place[starts[1:]] = 1 - np.diff(starts)
    np.cumsum(place, out=place)
    place[0 : int(starts[0])] = 0
    np.minimum(place, longest, out=place)
    return _mix(np.add.reduceat(numbers * weights[place], starts) + sizes.astype(np.uint64) * _M1)


def shingle_set(raw: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a UTF-8 text."""
    h = word_hashes(raw)
    if not len(h):
        return h
    size = min(WORDS, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out += h[k : len(h) - size + 1 + k] * _ODDS[k]
    out = np.sort(_mix(out))
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def set_id_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def bands_of(size: int) -> list[tuple[int, int]]:
    """(number, upper bound of sizes) of the bands that a set of this size takes part in."""
    k, top = 0, BAND
    while top <= size:
        k, top = k + 1, top * BAND
    return [(k, top), (k + 1, top * BAND)] if OF * size // AT_LEAST >= top else [(k, top)]


def differences(size: int, most: int) -> int:
    """The most elements that differ between sets of this size and of at most ``most`` that link."""
    return (OF - AT_LEAST) * (size + most) // (OF + AT_LEAST)


def _places(shingles: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each element, and where parts in use start: elements are sorted, so parts are
    runs. First-level parts have two second-level parts each."""
    parts = 2 * max(1, int(top * PARTS / 2))
    place = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return place, np.flatnonzero(np.diff(place, prepend=np.uint64(2**63)))


def prefixes(shingles: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(band, bound of its sizes, prefix needed, signatures there are) of a set; single elements,
    where it needs them, under a band of their own."""
    size = len(shingles)
    for number, top in bands_of(size):
        k = differences(size, min(OF * size // AT_LEAST, top - 1))
        there = len(_places(shingles, top)[1])
        yield 2 * number, top, k + 1, there
        if there <= k:
            yield 2 * number + 1, top, k + 1, size


def signatures(shingles: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(band, prefix needed, signatures) as `prefixes` has them."""
    for band, top, need, _ in prefixes(shingles):
        if band % 2:
            own = _mix(shingles ^ np.uint64(2 * top + 1))
        else:
            place, starts = _places(shingles, top)
            content = np.add.reduceat(_mix(shingles * _M1), starts)
            own = _mix((content + place[starts] * _M2) ^ np.uint64(top))
        yield band, need, _short(own, band)


def _short(signs: np.ndarray, band: int) -> np.ndarray:
    low = np.uint64((1 << BAND_BITS) - 1)
    return ((signs >> np.uint64(16)) & ~low) | np.uint64(band)


def sketch_of(shingles: np.ndarray) -> bytes:
    """Per bucket of the domain, the number of elements, up to 255, and their sum, as bytes."""
    bucket = (shingles >> np.uint64(40)).astype(np.int64) % BUCKETS
    count = np.bincount(bucket, minlength=BUCKETS)
    total = np.bincount(bucket, weights=(shingles & np.uint64(255)).astype(np.float64), minlength=BUCKETS)
    return np.minimum(count, 255).astype(np.uint8).tobytes() + (total.astype(np.int64) % 256).astype(np.uint8).tobytes()


def parity_of(shingles: np.ndarray) -> np.ndarray:
    """For each bucket of the domain, whether its number of elements is odd, as bits of bigints.

    Sets differ in at least as many elements as their sketches in bits.
    """
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % PARITY, minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


PARITIES = [f"parity{k}" for k in range(PARITY // 64)]
LEAST = [f"least{k}" for k in range(ORDERS)]
#: The bits that each order changes; the first four differ, the others are random.
_CHANGED = [k * 2**48 // ORDERS + int(x) % (2**48 // ORDERS) for k, x in enumerate(_weights(ORDERS))]


def _may_link() -> Column:
    """Whether sets a and b can link by their sizes and parities, within a join."""
    n_a, n_b = F.col("n_shingles_a"), F.col("n_shingles_b")
    near = OF * F.least(n_a, n_b) >= AT_LEAST * F.greatest(n_a, n_b)
    apart = sum(F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in PARITIES)
    return near & ((OF + AT_LEAST) * apart <= (OF - AT_LEAST) * (n_a + n_b))


def _meet_here() -> Column:
    """Whether sets a and b are to be paired at this signature, within a join.

    The first least signature that both have in common is one that they share, so they meet there
    and need no other. Without any, they meet wherever they can.
    """
    here = F.lit(True)
    for name, changed in reversed([*zip(LEAST, _CHANGED)]):
        a, b = F.col(f"{name}_a"), F.col(f"{name}_b")
        here = F.when(a == b, F.col("sign").bitwiseXOR(F.lit(changed)) == a).otherwise(here)
    return here


def least_differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differences that sets must have at least, row by row of their sketches."""
    count_a, count_b = a[:, :BUCKETS].astype(np.int64), b[:, :BUCKETS].astype(np.int64)
    apart = np.abs(count_a - count_b)
    other = (a[:, BUCKETS:] != b[:, BUCKETS:]) & (apart == 0) & (count_a < 255)
    return apart.sum(axis=1) + 2 * other.sum(axis=1)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_key (a hash of the text) and the text's bytes."""
    whole = F.coalesce(text, F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(whole).alias("text_key"), whole.cast("binary").alias("raw")
    )


def _row_key() -> Column:
    """The id, or the text's hash where that is null, so that rows without id spread."""
    return F.coalesce("doc_id", "text_key").alias("row_key")


def sets_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, n_shingles, set_id (null for the empty set), and per band the signatures
    beyond the prefix that it needs."""
    names = ["doc_id", "text_key", "n_shingles", "set_id", "spares"]
    spare = pa.list_(pa.struct([("band", pa.int64()), ("spare", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.keep_only(__name__)
        for batch in batches:
            rows = []
            for raw in batch.column(2):
                s = shingle_set(raw.as_py())
                spares = [{"band": b, "spare": n - need} for b, _, need, n in prefixes(s)] if len(s) else []
                rows.append((len(s), set_id_of(s), spares) if len(s) else (0, None, None))
            columns = zip(list(zip(*rows)) or [[]] * 3, (pa.int64(), pa.int64(), spare))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(c, t) for c, t in columns)], names=names)

    return _rows(docs, doc_id, text).mapInArrow(
        run,
        "doc_id long, text_key long, n_shingles long, set_id long, spares array<struct<band:long,spare:long>>",
    )


def _signed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(sign, set_id): all signatures of each set, once per batch of documents."""
    schema = pa.schema([pa.field(n, pa.int64(), False) for n in ("sign", "set_id")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.keep_only(__name__)
        for batch in batches:
            found: dict[int, np.ndarray] = {}
            size, done = 0, set()

            def rows() -> pa.RecordBatch:
                signs = np.concatenate([*found.values()]) if found else np.empty(0, np.uint64)
                owners = np.repeat(np.array([*found], np.int64), [len(s) for s in found.values()])
                return pa.RecordBatch.from_arrays([pa.array(signs.view(np.int64)), pa.array(owners)], schema=schema)

            for raw in batch.column(2):
                s = shingle_set(raw.as_py())
                if len(s) and (one := set_id_of(s)) not in done:
                    done.add(one)
                    found[one] = np.concatenate([own for _, _, own in signatures(s)])
                    size += len(found[one])
                if size > 300_000:
                    yield rows()
                    found, size = {}, 0
            yield rows()

    return _rows(docs, doc_id, text).mapInArrow(run, "sign long not null, set_id long not null")


def _starts(signs: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers start, and the end."""
    return np.concatenate([[0], np.flatnonzero(signs[1:] != signs[:-1]) + 1, [len(signs)]])


def _sharing(signs: np.ndarray, owners: np.ndarray) -> list[np.ndarray]:
    """sign, set_id and the sign's rows, for whole runs of rows in order of their sign: once for
    each set of the signatures that several sets share."""
    sizes = np.diff(_starts(signs))
    n = np.repeat(sizes, sizes)
    rows = np.flatnonzero(n > 1)
    rows = rows[np.lexsort((owners[rows], signs[rows]))]
    signs, owners, n = signs[rows], owners[rows], n[rows]
    first = np.ones(len(rows), bool)
    first[1:] = (signs[1:] != signs[:-1]) | (owners[1:] != owners[:-1])
    signs, owners, n = signs[first], owners[first], n[first]
    sets = np.diff(_starts(signs)) if len(signs) else np.empty(0, np.int64)
    several = np.repeat(sets, sets) > 1
    return [signs[several], owners[several], n[several]]


def _members(signed: DataFrame) -> DataFrame:
    """(sign, set_id, n): the sets of each signature that several share, and its rows.

    One shuffle and one sort by signature, read once as a stream of runs; a task holds a batch
    and the run that is open, 16 bytes a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches.keep_only(__name__)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def closed() -> pa.RecordBatch:
            found = _sharing(*(np.concatenate(c) for c in zip(*held)))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["sign", "set_id", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            signs, owners = (batch.column(k).to_numpy() for k in (0, 1))
            cut = int(np.searchsorted(signs, signs[-1]))
            held.append((signs[:cut], owners[:cut]))
            if cut:
                yield closed()
                held = []
            held.append((signs[cut:], owners[cut:]))
        if held:
            yield closed()

    by_sign = signed.repartition("sign").sortWithinPartitions("sign")
    return by_sign.mapInArrow(run, "sign long, set_id long, n long")


def _paired(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b) of set ids with columns of both sets."""
    side = lambda n: sets.select(F.col("set_id").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in columns])
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", *[f"{c}_{n}" for c in columns for n in "ab"])


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids whose sets link: by sketches, then elements."""
    sketched = _paired(pairs, sets, ["n_shingles", "sketch"])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            a, b = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, 2 * BUCKETS) for k in (4, 5)
            )
            keep = (OF + AT_LEAST) * least_differences(a, b) <= (OF - AT_LEAST) * sizes
            yield batch.select([0, 1]).filter(pa.array(keep))

    met = _paired(sketched.mapInArrow(close, "a long, b long"), sets, ["shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(OF * both >= AT_LEAST * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(run, "a long, b long")


def link_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with their set, components of sets).

    The first has doc_id, text_key, n_shingles, set_id; the second node (a set_id) and label,
    for sets that link with another. Writes both, and what they need, to the shared folder.
    """
    owners = stage(sets_of(docs, doc_id, text), "owners")
    worded = owners.where("set_id is not null")
    members = _members(_signed(docs, doc_id, text))

    # The rarest signatures of each set and band, as many as its prefix needs.
    band = F.col("sign").bitwiseAND(F.lit((1 << BAND_BITS) - 1)).alias("band")
    spares = worded.select("set_id", F.inline("spares")).dropDuplicates(["set_id", "band"])
    last = Window.partitionBy("set_id", "band").orderBy(F.desc("n"), F.desc("sign"))
    rare = (
        members.select("sign", "set_id", "n", band)
        .join(spares, ["set_id", "band"])
        .withColumn("from_last", F.row_number().over(last))
        .where("from_last > spare")
        .select("sign", "set_id")
    )
    rare = _unlike(stage(rare, "rare"))
    groups = stage(_mixed(rare.withColumn("label", F.col("set_id")), 0).drop("label"), "groups")

    # What is known of their sets, the elements from the text of one document of each.
    first = worded.groupBy("set_id").agg(F.min(_row_key()).alias("row_key"))
    chosen = groups.select("set_id").distinct().join(first, "set_id")
    sets = stage(_elements(docs, chosen, doc_id, text), "sets")

    known = sets.select("set_id", "n_shingles", *PARITIES)

    nodes = groups.select(F.col("set_id").alias("node")).distinct()
    labels = stage(nodes.withColumn("label", F.col("node")), "labels")
    mixed, before = stage(groups.withColumn("label", F.col("set_id")).join(known, "set_id"), "mixed"), None
    for turn in range(ROUNDS):
        rows, pairs = _left(mixed)
        if not rows or (turn and (pairs <= FEW_PAIRS * rows or pairs > STALLED * before)):
            break
        star = _side(mixed.where("pivot"), "a").join(_side(mixed, "b"), "sign")
        star = star.where((F.col("label_a") != F.col("label_b")) & _may_link()).select("a", "b").distinct()
        labels, before = _merged(labels, _linked(star, sets)), pairs
        # A group of one label stays so; only the others go on.
        labelled = mixed.select("sign", "set_id").join(labels.withColumnRenamed("node", "set_id"), "set_id")
        mixed = stage(_mixed(labelled, turn + 1).join(known, "set_id"), "mixed")
    return owners, _merged(labels, _linked(_rest(mixed, known).distinct(), sets))


def _unlike(rare: DataFrame) -> DataFrame:
    """(sign, set_id) of signatures that several sets share; of those that the same sets share, one.

    Which sets share a signature is known by their number and two sums of 64 bits.
    """
    same = ["n", "x", "y"]
    sums = [F.count("*").alias("n"), F.bit_xor("set_id").alias("x"), F.bit_xor(F.xxhash64("set_id")).alias("y")]
    found = rare.groupBy("sign").agg(*sums).where("n > 1")
    return rare.join(found.groupBy(*same).agg(F.min("sign").alias("sign")).select("sign"), "sign").select("sign", "set_id")


def _rest(mixed: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b) of sets of different labels in a group that may link: once where they have a least
    signature in common, else once per group."""
    least = [F.min(F.col("sign").bitwiseXOR(F.lit(c))).alias(name) for name, c in zip(LEAST, _CHANGED)]
    known = known.join(mixed.groupBy("set_id").agg(*least), "set_id")
    members = mixed.select("sign", "set_id", "label").join(known, "set_id")
    pairs = _side(members, "a", LEAST).join(_side(members, "b", LEAST), "sign")
    apart = (F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b"))
    return pairs.where(apart & _meet_here() & _may_link()).select("a", "b")


def _mixed(labelled: DataFrame, turn: int) -> DataFrame:
    """The members of groups with several labels, their number and which one is this turn's pivot."""
    found = labelled.groupBy("sign").agg(
        F.count("*").alias("n"), F.min("label").alias("l"), F.max("label").alias("h"), F.min(_turned(turn)).alias("key")
    )
    met = labelled.join(found.where("l < h").drop("l", "h"), "sign")
    return met.withColumn("pivot", _turned(turn) == F.col("key")).drop("key")


def _left(mixed: DataFrame) -> tuple[int, int]:
    """Rows of the groups, and their pairs of sets of different labels, counted without forming them."""
    alike = mixed.groupBy("sign", "label").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    rows, pairs = alike.agg(F.sum("c"), F.sum(F.col("c") * (F.col("n") - F.col("c")))).first()
    return rows or 0, (pairs or 0) // 2


def _side(mixed: DataFrame, n: str, more: Sequence[str] = ()) -> DataFrame:
    """Members of groups as the side a or b of a pair.

    None of the columns holds nulls; said so, the join's condition needs no checks for them.
    """
    columns = [F.coalesce(c, F.lit(0)).alias(f"{c}_{n}") for c in ("label", "n_shingles", *PARITIES, *more)]
    return mixed.select("sign", F.col("set_id").alias(n), *columns)


def _turned(turn: int) -> Column:
    """An order of sets that differs from round to round, without ties."""
    return F.struct(F.xxhash64(F.lit(turn), "set_id"), "set_id")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links between nodes."""
    links = stage(links, "links")
    end = lambda n: labels.select(F.col("node").alias(n), F.col("label").alias(f"l{n}"))
    joined = links.join(end("a"), "a").join(end("b"), "b").select("la", "lb")
    moved = components(joined, "la", "lb").select(F.col("node").alias("label"), F.col("label").alias("to"))
    merged = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return stage(merged, "labels")


def _elements(docs: DataFrame, chosen: DataFrame, doc_id: str, text: str) -> DataFrame:
    """set_id, n_shingles, sketch and the elements as bytes, of the chosen documents."""
    met = _rows(docs, doc_id, text).select(_row_key(), "raw").join(chosen.hint("shuffle_hash"), "row_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(raw.as_py()) for raw in batch.column(1)]
            right = [len(s) > 0 and set_id_of(s) == one for s, one in zip(found, batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array([sketch_of(s) for s in found], pa.binary()),
                    pa.array([s.tobytes() for s in found], pa.binary()),
                    *(pa.array(p) for p in np.array([parity_of(s) for s in found], np.int64).reshape(-1, len(PARITIES)).T),
                ],
                names=["set_id", "n_shingles", "sketch", "shingles", *PARITIES],
            ).filter(pa.array(right, pa.bool_()))

    ddl = ", ".join(["set_id long, n_shingles long, sketch binary, shingles binary", *[f"{p} long" for p in PARITIES]])
    return met.select("set_id", "raw").mapInArrow(run, ddl).dropDuplicates(["set_id"])


def _labelled(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """owners with the label of their component; null for documents without words."""
    owners, labels = link_classes(docs, doc_id, text)
    met = owners.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    return stage(met.withColumn("label", F.coalesce("label", "set_id")).drop("set_id", "spares"), "labelled")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
    labelled = _labelled(docs, doc_id, text)
    least = labelled.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return labelled.join(least, "label", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def superseded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """owner (the id, null as the smallest) and text_key of documents that give way to another
    of their component: all but the one of smallest owner, then smallest text_key."""
    own = F.coalesce("doc_id", F.lit(FIRST_ID)).alias("owner")
    labelled = _labelled(docs, doc_id, text).where("label is not null").select("label", own, "text_key")
    least = labelled.groupBy("label").agg(F.min("owner").alias("least"))
    ranked = labelled.join(least, "label").withColumn("own", F.col("owner") == F.col("least"))
    first = ranked.where("own").groupBy("label").agg(F.min("text_key").alias("first"))
    gone = ranked.join(first, "label").where("not own or text_key <> first")
    return gone.select("owner", "text_key").distinct()


def op10_partenum_join(spark, sf: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))
