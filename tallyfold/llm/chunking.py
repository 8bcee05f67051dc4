"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of each text; where its top bits are zero, a chunk ends. The
hash sees the last sixteen bytes only, so cuts depend on nearby content, and a chunk found in
one text is found in another whatever was inserted before it. Chunks are compared by 128-bit
digest over the whole corpus; the smallest doc_id that holds a chunk keeps its first copy.
Runs of repeated chunks of ``MIN_RUN`` bytes or more are removed; shorter ones are chance.

Only digests and ids are shuffled to find repeats: one row per distinct chunk of a document,
reduced to the smallest and largest owner before and after the shuffle. So a chunk that a
third of all documents share is one row per task. Texts move once, to meet their verdicts.

Defined cases: null and empty texts have no chunks and stay as they are (null becomes empty);
rows that share a doc_id are one document, and each is cut by its own text; null ids count as
one document before all others; an empty table gives an empty result. Only the named columns
are read for the verdicts, and ``dedup`` keeps all other columns as they are. Very long texts
are cut whole, one at a time; their chunks spread like all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Window of the hash, bits that must be zero, least distance of a cut from another candidate,
#: and the longest chunk. Chunks average about 45 bytes.
WINDOW, ZERO_BITS, LEAST, MOST = 16, 4, 16, 1024
#: Bytes that a run of repeated chunks must have to go.
MIN_RUN = 100
FIRST_ID = -(2**63)

_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 16, 256, dtype=np.uint16)


def cuts_of(raw: bytes) -> list[int]:
    """Where chunks start, and the length of the text at the end. Never inside a code point."""
    n = len(raw)
    codes = np.frombuffer(raw, np.uint8)
    rolled = _GEAR[codes]
    step = 1
    while step < WINDOW:
        wider = rolled.copy()
        wider[step:] += rolled[:-step] << step
        rolled, step = wider, step * 2
    at = np.flatnonzero(rolled < (1 << (16 - ZERO_BITS)))
    at = at[np.diff(at, prepend=-1) > LEAST] + 1
    at = at[at < n]
    for _ in range(3):
        at = at + (codes[np.minimum(at, n - 1)] & 0xC0 == 0x80)
    cuts = [0]
    for cut in at.tolist():
        while cut - cuts[-1] > MOST:
            cuts.append(_char_start(raw, cuts[-1] + MOST))
        if cuts[-1] < cut < n:
            cuts.append(cut)
    while n - cuts[-1] > MOST:
        cuts.append(_char_start(raw, cuts[-1] + MOST))
    return [*cuts, n]


def _char_start(raw: bytes, at: int) -> int:
    while raw[at] & 0xC0 == 0x80:
        at -= 1
    return at


def digests_of(raw: bytes) -> tuple[list[int], list[bytes]]:
    if not raw:
        return [0], []
    cuts, whole = cuts_of(raw), memoryview(raw)
    return cuts, [xxhash.xxh3_128_digest(whole[a:b]) for a, b in zip(cuts, cuts[1:])]


def repeated_runs(raw: bytes, elsewhere: set[bytes], least: int = MIN_RUN) -> list[tuple[int, int]]:
    """Spans to remove: runs of chunks kept by another document or earlier in this text."""
    cuts, digests = digests_of(raw)
    runs, seen, start = [], set(), None
    for k, d in enumerate([*digests, None]):
        if d is not None and (d in elsewhere or d in seen):
            start = cuts[k] if start is None else start
        elif start is not None:
            if cuts[k] - start >= least:
                runs.append((start, cuts[k]))
            start = None
        seen.add(d)
    return runs


def _owner(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST_ID))


def chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """owner and the two halves of the digest, once per distinct chunk of a row."""
    names = ["owner", "high", "low"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(dict.fromkeys(digests_of(x.as_py())[1])) for x in batch.column(1)]
            counts = np.array([len(f) for f in found])
            halves = np.frombuffer(b"".join(d for f in found for d in f), "<i8").reshape(-1, 2)
            owners = np.repeat(batch.column(0).to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (owners, halves[:, 0].copy(), halves[:, 1].copy())], names=names)

    rows = docs.select(
        _owner(doc_id).alias("owner"),
        F.coalesce(text, F.lit("")).cast("binary").alias("raw"),
    )
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def kept_elsewhere(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """owner and the digests of its chunks that a smaller doc_id holds."""
    own = chunks(docs, doc_id, text)
    spread = own.groupBy("high", "low").agg(F.min("owner").alias("keeper"), F.max("owner").alias("last"))
    repeated = spread.where(F.col("keeper") < F.col("last")).drop("last")
    lost = own.join(repeated, ["high", "low"]).where(F.col("owner") > F.col("keeper"))
    return lost.groupBy("owner").agg(F.collect_set(F.struct("high", "low")).alias("lost"))


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_RUN) -> DataFrame:
    """Per row: all its columns, with ``kept`` (text as bytes), ``spans`` removed and n_bytes.

    The three added columns replace columns of those names; use ``dedup`` to keep a schema.
    """
    lost = kept_elsewhere(docs, doc_id, text)
    rows = docs.select(F.struct("*").alias("row"), _owner(doc_id).alias("owner"))
    met = rows.join(lost, "owner", "left").select(
        "row", F.coalesce(F.col("row")[text], F.lit("")).cast("binary").alias("raw"), "lost"
    )
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for raw, lost in zip(batch.column(1), batch.column(2)):
                raw = raw.as_py()
                there = {
                    h.to_bytes(8, "little", signed=True) + l.to_bytes(8, "little", signed=True)
                    for h, l in ((x["high"], x["low"]) for x in lost.as_py() or ())
                }
                runs = repeated_runs(raw, there, least)
                edges = [0, *(x for run in runs for x in run), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append([{"start": a, "stop": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(spans, span)], names=["row", "kept", "spans"]
            )

    ends = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    schema = met.select("row").schema.add("kept", T.BinaryType()).add("spans", T.ArrayType(ends))
    return met.mapInArrow(run, schema)


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_RUN) -> DataFrame:
    """The documents, every column kept, their texts without the removed runs."""
    cut = removals(docs, doc_id, text, least)
    quoted = lambda c: "row.`" + c.replace("`", "``") + "`"
    kept = F.decode("kept", "UTF-8").alias(text)
    return cut.select([kept if c == text else F.col(quoted(c)) for c in docs.columns])


def op8_chunk_dedup(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    cut = removals(docs)
    n = F.octet_length(F.coalesce("row.text", F.lit(""))).cast("long")
    left = F.octet_length("kept").cast("long")
    return cut.select(
        F.col("row.doc_id").alias("doc_id"),
        n.alias("n_bytes"),
        (n - left).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
