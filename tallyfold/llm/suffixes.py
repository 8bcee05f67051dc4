"""Exact substring dedup by suffix arrays built with two-stage sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document
with a smaller id, or earlier in the same text. Matches never cross documents.

Which strings can repeat. Every window of LENGTH bytes names one of its SEED-byte substrings,
the one of least hash, leftmost. Equal windows name equal seeds, so only windows whose seed
occurs twice in the corpus go on; each is carried once, in the stretch of text whose windows
name the same seed occurrence. Equal stretches of a seed, known by a hash, are folded to the
first, the others are covered; only seeds that keep several different stretches go on, and
only their stretches are cut out of the texts. They come together in blocks by seed.

Sorting a block. Its stretches are joined, and the suffixes that are smaller than their
successors are sorted directly, by 8-byte keys and only as deep as ties last, to LENGTH bytes.
All others are induced by a scan over the buckets of first bytes. Neighbours in the order
whose common prefix reaches LENGTH are one class; its first member stays, the others are
covered. Seeds with more stretches than ``BLOCK`` are split over blocks, each of which gives the
first of every class; those meet by digest.

Defined cases: null texts are empty; texts under LENGTH bytes lose nothing; equal rows (id and
text) are one document, and each gets its result; rows that share an id but not the text are
ordered by a hash of the text; null ids come first; an empty table gives an empty result; very
long texts are read in parts of 4 MiB that overlap by a window, so none is missed. Only the
named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.session import stage

LENGTH, SEED = 100, 32
#: Stretches of one seed that a block holds on average, and bytes sorted at once at least.
BLOCK, AT_ONCE = 10_000, 1 << 20
#: Bytes of a text that are hashed at once; positions take the low bits of a sort key.
PART, LOW = 1 << 22, 24
FIRST_ID = -(2**63)
MARK = -(2**63)

_ODD, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BYTES = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _seed_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes from each position on."""
    h, power, span = _BYTES[codes], np.array([_ODD]), 1
    while span < SEED:
        h = h[:-span] * power + h[span:]
        power, span = power * power, span * 2
    return _mix(h)


def _stretches(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seed hash, first window, number of windows) of each seed occurrence that windows name."""
    hashes = _seed_hashes(codes)
    low = np.uint64((1 << LOW) - 1)
    key = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width = LENGTH - SEED + 1
    least, span = key, 1
    while span * 2 <= width:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    least = np.minimum(least[: len(key) - width + 1], least[width - span :])
    at = (least & low).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return hashes[at[first]], first, np.diff(first, append=len(at))


def stretches_of(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(raw, np.uint8)
    found = [
        (h, first + a, n)
        for a in range(0, max(0, len(raw) - LENGTH + 1), PART)
        for h, first, n in [_stretches(codes[a : a + PART + LENGTH - 1])]
    ]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def suffix_array(codes: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes in order of their first ``depth`` codes at least, by two-stage sorting.

    Codes are from 0 to 256; a code past the end counts as least.
    """
    n = len(codes)
    after = np.append(codes[1:], 0)
    # A suffix is smaller than its successor if its next different code is larger.
    differs = np.flatnonzero(codes != after)
    at = np.searchsorted(differs, np.arange(n))
    rises = np.append(after[differs] > codes[differs], False)
    small = rises[at]

    padded = np.concatenate([codes.astype(np.uint64), np.zeros(depth + 16, np.uint64)])
    # Seven codes of nine bits to a key.
    key = np.zeros(len(padded) - 6, np.uint64)
    for k in range(7):
        key = (key << np.uint64(9)) | padded[k : len(key) + k]
    order = np.flatnonzero(small)
    order = order[np.argsort(key[order], kind="stable")]
    group = np.cumsum(np.diff(key[order], prepend=key[order[:1]]) != 0)
    for deep in range(7, depth, 7):
        size = np.bincount(group) if len(group) else group
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        own, mark = order[tied], group[tied]
        deeper = key[np.minimum(own + deep, len(key) - 1)]
        put = np.lexsort((deeper, mark))
        order[tied] = own[put]
        mark, deeper = mark[put], deeper[put]
        new = (np.diff(mark, prepend=mark[:1]) != 0) | (np.diff(deeper, prepend=deeper[:1]) != 0)
        split = np.zeros(len(group), np.int64)
        split[tied] = new
        starts = np.diff(group, prepend=group[:1]) != 0
        group = np.cumsum(starts | (split > 0))

    # Bucket scan: the larger suffixes of a bucket come first, in the order of their successors.
    bounds = np.searchsorted(codes[order], np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    if n and not small[n - 1]:
        waiting[int(codes[n - 1])].append(np.array([n - 1]))  # before it there is only the end
    done = []
    for code in range(257):
        level = np.concatenate(waiting[code]) if waiting[code] else np.empty(0, np.int64)
        whole = []
        while len(level):
            whole.append(level)
            before = level[level > 0] - 1
            level = before[(codes[before] == code) & ~small[before]]
        whole.append(order[bounds[code] : bounds[code + 1]])
        bucket = np.concatenate(whole)
        done.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[codes[before] > code]
        first = codes[before]
        put = np.argsort(first, kind="stable")
        cut = np.flatnonzero(np.diff(first[put], prepend=-1))
        for a, b in zip(cut, [*cut[1:], len(put)]):
            waiting[int(first[put[a]])].append(before[put[a:b]])
    return np.concatenate(done) if done else np.empty(0, np.int64)


def repeated_windows(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, class) of every window of ``length`` bytes, in class order.

    Windows of one class are equal, and classes are in one run each.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    codes = np.zeros(int(sizes.sum()), np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    whole = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    codes[:] = whole
    codes += 1
    codes[ends - 1] = 0
    text = np.repeat(np.arange(len(texts)), sizes)
    order = suffix_array(codes, length)
    order = order[order + length < ends[text[order]]]  # windows that end within their text
    # Common prefixes of neighbours, as far as length.
    same = np.ones(max(0, len(order) - 1), bool)
    words = np.lib.stride_tricks.sliding_window_view(whole, 8) if len(whole) >= 8 else None
    if words is not None:
        packed = np.ascontiguousarray(words).view(np.uint64)[:, 0]
        for k in [*range(0, length - 7, 8), length - 8]:
            at = np.flatnonzero(same)
            same[at] = packed[order[at] + k] == packed[order[at + 1] + k]
    classes = np.cumsum(np.concatenate([[0], ~same])) if len(order) else order
    return text[order], order - begins[text[order]], classes


def covered(records: list[tuple], split: bool) -> tuple[list[tuple], list[tuple]]:
    """Of (owner, text_key, start, stretch) records of whole seeds: spans that are covered,
    and, if ``split``, the first window of every class: (digest halves, owner, text_key, start)."""
    records = sorted(records)
    first: dict[tuple, tuple] = {}
    spans, firsts = [], []
    kinds: dict[int, int] = {}
    for owner, key, start, seed, stretch in records:
        held = first.setdefault((seed, stretch), (owner, key, start))
        if held != (owner, key, start):
            spans.append((owner, key, start, start + len(stretch)))
        elif (seed, stretch, "n") not in first:
            first[(seed, stretch, "n")] = held
            kinds[seed] = kinds.get(seed, 0) + 1
    own = [(*v, k[1]) for k, v in first.items() if len(k) == 2 and (split or kinds[k[0]] > 1)]
    own.sort()
    if own:
        number, at, classes = repeated_windows([x[3] for x in own])
        # Records are in order, so the least (number, start) of a class is its first place.
        put = np.lexsort((at, number, classes))
        number, at, classes = number[put], at[put], classes[put]
        lead = np.diff(classes, prepend=-1) != 0
        later = np.flatnonzero(~lead)
        later = later[np.lexsort((at[later], number[later]))]
        n, a = number[later], at[later]
        new = np.flatnonzero((np.diff(n, prepend=-1) != 0) | (np.diff(a, prepend=-2) != 1))
        for b, e in zip(new, [*new[1:], len(n)]):
            owner, key, start, _ = own[n[b]]
            spans.append((owner, key, start + int(a[b]), start + int(a[e - 1]) + LENGTH))
        if split:
            for k, s in zip(number[lead].tolist(), at[lead].tolist()):
                owner, key, start, stretch = own[k]
                d = xxhash.xxh3_128_digest(stretch[s : s + LENGTH])
                high, low = (int.from_bytes(d[x : x + 8], "little", signed=True) for x in (0, 8))
                firsts.append((high, low, owner, key, start + s))
    return spans, firsts


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(text, F.lit(""))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST_ID)).alias("owner"),
        F.xxhash64(whole).alias("text_key"),
        whole.cast("binary").alias("raw"),
    )


def _seeds(rows: DataFrame) -> DataFrame:
    """seed, print, owner, text_key and place: first window * 128 + number of windows.

    ``print`` is a hash of the stretch. Of equal texts in a batch only the first is read; the
    others are copies of it. Of equal stretches of a seed in a batch the first stands for all;
    the others are covered, and get a made-up seed, so that they spread, and ``-1 - place``.
    """
    schema = pa.schema([pa.field(n, pa.int64(), False) for n in ("seed", "print", "owner", "text_key", "place")])
    print_of = xxhash.xxh3_64_intdigest

    def folded(parts: list[tuple]) -> pa.RecordBatch:
        seed, mark, owner, key, place = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((place, key, owner, mark, seed))
        seed, mark, owner, key, place = (c[order] for c in (seed, mark, owner, key, place))
        again = np.append(False, (seed[1:] == seed[:-1]) & (mark[1:] == mark[:-1]))
        spread = _mix((owner ^ key ^ place).view(np.uint64) * _ODD).view(np.int64)
        seed, place = np.where(again, spread, seed), np.where(again, -1 - place, place)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (seed, mark, owner, key, place)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first: dict[bytes, tuple] = {}
            ids = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for k, (one, raw) in enumerate(zip(ids, batch.column(2))):
                raw = raw.as_py()
                mark = hashlib.blake2b(raw, digest_size=16).digest()
                if len(raw) >= LENGTH and (mark not in first or one < first[mark][0]):
                    first[mark] = (one, k)
            out: list[tuple] = []
            size = 0
            for (owner, key), k in first.values():
                raw = batch.column(2)[k].as_py()
                seeds, begin, n = stretches_of(raw)
                stops = (begin + n + LENGTH - 1).tolist()
                prints = np.array([print_of(raw[a:b]) for a, b in zip(begin.tolist(), stops)], np.uint64)
                same = (np.full(len(n), x) for x in (owner, key))
                out.append((seeds.view(np.int64), prints.view(np.int64), *same, begin * 128 + n))
                size += len(n)
                if size > 500_000:
                    yield folded(out)
                    out, size = [], 0
            if out:
                yield folded(out)

    ddl = ", ".join(f"{n} long not null" for n in schema.names)
    return rows.select("owner", "text_key", "raw").mapInArrow(run, ddl)


def _folded(seeds: DataFrame) -> DataFrame:
    """owner, text_key, place, seed, block of places that matter, from seeds in order.

    ``block`` is -1 where an equal stretch comes earlier; else the block that the stretch is
    compared in, of a seed with several different stretches. Reads sorted rows as they come,
    and keeps one row of what came before.
    """
    names = ["owner", "text_key", "place", "seed", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ordinal, alone = np.full(5, MARK), 0, None
        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns])
            known = rows[4] < 0
            if known.any():
                gone = rows[:, known]
                parts = (gone[2], gone[3], -1 - gone[4], gone[0], np.full(gone.shape[1], -1))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in parts], names=names)
                rows = rows[:, ~known]
            if not rows.shape[1]:
                continue
            steps = np.diff(rows, axis=1, prepend=last[:, None]) != 0
            new_seed, again = steps[0].copy(), ~steps.any(axis=0)
            if last[4] == MARK:  # a place is never negative
                new_seed[0], again[0] = True, False
            new_print = new_seed | steps[1]
            count = np.cumsum(new_print)
            start = np.maximum.accumulate(np.where(new_seed, np.arange(len(count)), -1))
            number = np.where(start < 0, ordinal + count, count - count[start])
            group = np.cumsum(new_seed)
            several = np.zeros(group[-1] + 1, bool)
            several[group[new_print & (number > 0)]] = True
            several[0] |= ordinal > 0
            keep = new_print & several[group]
            if alone is not None and several[0] and ordinal == 0:
                held = np.append(alone, 0)
            else:
                held = None
            copies = ~new_print & ~again
            block = np.where(copies, -1, number // BLOCK)
            take = keep | copies
            out = np.concatenate([rows[2:, take], rows[:1, take], block[None, take]])
            if held is not None:
                out = np.concatenate([held[:, None], out], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in out], names=names)
            ordinal = int(number[-1])
            firsts = np.flatnonzero(new_seed)
            if len(firsts):
                alone = rows[[2, 3, 4, 0], firsts[-1]]
            last = rows[:, -1]

    return seeds.mapInArrow(run, ", ".join(f"{n} long" for n in names))


STRETCH = "seed long, block long, split boolean, owner long, text_key long, start long, stretch binary"


def _cut_out(met: DataFrame) -> DataFrame:
    """The stretches at the places given with each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = [x.split()[0] for x in STRETCH.split(", ")]

        def rows(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        for batch in batches:
            out: list[tuple] = []
            for owner, key, raw, places in zip(*(batch.column(k) for k in range(1, 5))):
                owner, key, raw = owner.as_py(), key.as_py(), raw.as_py()
                for seed, block, split, place in zip(*(places.values.field(k).to_pylist() for k in range(4))):
                    start, n = divmod(place, 128)
                    out.append((seed, block, split, owner, key, start, raw[start : start + n + LENGTH - 1]))
                if len(out) > 50_000:
                    yield rows(out)
                    out = []
            yield rows(out)

    return met.select("doc_id", "owner", "text_key", "raw", "places").mapInArrow(run, STRETCH)


def _compared(stretches: DataFrame) -> DataFrame:
    """Covered spans, and of split seeds the first window of every class in each block.

    ``high`` and ``low`` are the window's digest; for spans, where they are not needed,
    owner and text_key, so that one window function can deal with both.
    """
    names = ["first", "high", "low", "owner", "text_key", "start", "stop"]

    def solved(rows: dict[bool, list]) -> pa.RecordBatch:
        out: list[tuple] = []
        for split, records in rows.items():
            spans, firsts = covered(records, split)
            out += [(False, *s[:2], *s) for s in spans]
            out += [(True, high, low, o, k, s, s + LENGTH) for high, low, o, k, s in firsts]
        columns = list(zip(*out)) if out else [[]] * 7
        kinds = [pa.bool_(), *[pa.int64()] * 6]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[bool, list] = {False: [], True: []}
        size, last = 0, None
        for batch in batches:
            for seed, block, split, owner, key, start, stretch in zip(*(c.to_pylist() for c in batch.columns)):
                if (seed, block) != last and size > AT_ONCE:
                    yield solved(rows)
                    rows, size = {False: [], True: []}, 0
                last = (seed, block)
                rows[split].append((owner, key, start, seed, stretch))
                size += len(stretch)
        yield solved(rows)

    ddl = "first boolean, high long, low long, owner long, text_key long, start long, stop long"
    return stretches.mapInArrow(run, ddl)


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, raw (the text's bytes), kept (what remains) and spans removed, per row.

    Writes the folded places (no texts) to the shared folder. After that, the texts are
    shuffled once for the two joins that need them.
    """
    rows = _keyed(docs, doc_id, text)
    order = ["seed", "print", "owner", "text_key", "place"]
    folded = stage(_folded(_seeds(rows).repartition("seed").sortWithinPartitions(*order)), "places")
    kept = folded.where("block >= 0")
    split = kept.groupBy("seed").agg((F.max("block") > 0).alias("split")).where("split")
    places = (
        kept.join(split, "seed", "left")
        .groupBy("owner", "text_key")
        .agg(F.collect_list(F.struct("seed", "block", F.coalesce("split", F.lit(False)).alias("split"), "place")).alias("places"))
    )
    cut = _cut_out(rows.join(places.hint("shuffle_hash"), ["owner", "text_key"]))
    found = _compared(cut.repartition("seed", "block").sortWithinPartitions("seed", "block"))
    start = F.shiftright("place", 7)
    folds = folded.where("block < 0").select(
        "owner", "text_key", start.alias("start"), (start + F.col("place") % 128 + LENGTH - 1).alias("stop")
    )
    # A class that several blocks hold: all but its first place are covered.
    place = F.row_number().over(Window.partitionBy("first", "high", "low").orderBy("owner", "text_key", "start"))
    parts = found.withColumn("place", place).where("not first or place > 1")

    # Whole copies: an equal text under a smaller id.
    texts = rows.select("owner", "text_key", F.xxhash64(F.lit(1), "raw").alias("other"), F.octet_length("raw").cast("long").alias("n"))
    texts = texts.where(F.col("n") >= LENGTH)
    keepers = texts.groupBy("text_key", "other").agg(F.min("owner").alias("keeper"), F.max("owner").alias("last"))
    keepers = keepers.where("keeper < last").drop("last")
    copies = texts.join(keepers, ["text_key", "other"]).where("owner > keeper")

    spans = (
        parts.select("owner", "text_key", "start", "stop")
        .unionByName(folds)
        .unionByName(copies.select("owner", "text_key", F.lit(0).cast("long").alias("start"), F.col("n").alias("stop")))
        .groupBy("owner", "text_key")
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    )
    met = rows.join(spans.hint("shuffle_hash"), ["owner", "text_key"], "left").select("doc_id", "owner", "text_key", "raw", "spans")
    ends = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, gone = [], []
            for raw, found in zip(batch.column(3), batch.column(4)):
                raw = raw.as_py()
                runs = _union([(x["start"], x["stop"]) for x in found.as_py() or ()])
                edges = [0, *(x for r in runs for x in r), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                gone.append([{"start": a, "stop": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(kept, pa.binary()), pa.array(gone, ends)],
                names=["doc_id", "raw", "kept", "spans"],
            )

    return met.mapInArrow(run, "doc_id long, raw binary, kept binary, spans array<struct<start:long,stop:long>>")


def _union(spans: list[tuple[int, int]]) -> list[list[int]]:
    runs: list[list[int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(b, runs[-1][1])
        else:
            runs.append([a, b])
    return runs


def op3_suffix_dedup(spark, sf: str) -> DataFrame:
    cut = removals(spark.read.parquet(f"{sf}/documents.parquet"))
    n, left = (F.octet_length(c).cast("long") for c in ("raw", "kept"))
    return cut.select(
        "doc_id",
        n.alias("n_bytes"),
        (n - left).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
