"""Best-two-fit packing of tokenised documents into sequences of bounded length.

A sequence is filled greedily, each time with the longest piece that still fits. Then its
smallest piece gives way to two unpacked pieces that fill the widened gap more tightly, as
long as that helps. Pieces are dealt to groups of many thousands, each packed on its own,
so one task holds a bounded number of lengths and no text; a group's last, part-filled
sequences are the only loss, under one in a thousand.

Tokens come from a tokenizer file. It drops white space, and no token spans any, so each
chunk between ASCII white space is encoded on its own, once while the cache has room.

Defined cases: null and empty texts are the closing id alone; repeated rows are packed each;
null ids stay null; very long texts become many pieces; an empty table gives an empty result.
Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import caches
from tallyfold.session import stage

LENGTH = 4096
CLOSING = 1
#: Pieces that one task packs, on average.
GROUP_PIECES = 50_000
#: Chunks a worker's cache holds, and bytes of text tokenised at once.
CACHED, AT_ONCE = 1_200_000, 1 << 20
#: A point or comma after an ASCII letter or digit is always a token of its own.
_POINT = re.compile(rb"([A-Za-z0-9])([.,])(?=[ \n])")


def chunks_of(raw: bytes) -> list[bytes]:
    """Parts of a text that the tokenizer would treat on their own, in few spellings.

    The tokenizer lowers case itself. Doing so first changes nothing, unless the text may
    hold special tokens or combining marks, which could then be found or composed.
    """
    raw = _POINT.sub(rb"\1 \2", raw)
    if not (b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw):
        raw = raw.lower()
    return raw.split()


class Chunks:
    """Ids of chunks as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(path), {}

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        words = [chunks_of(x) for x in texts]
        new = list(set(chain.from_iterable(words)).difference(self.cache))
        encoded = self.tokenizer.encode_batch([w.decode() for w in new], add_special_tokens=False)
        fresh = {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(new, encoded)}
        known = self.cache
        if len(known) + len(fresh) <= CACHED:
            known.update(fresh)
        else:
            known = {w: known[w] for w in set(chain.from_iterable(words)) if w in known} | fresh
        for x in words:
            yield b"".join(map(known.__getitem__, x))


@lru_cache(maxsize=2)
def chunks_for(path: str) -> Chunks:
    return Chunks(path)


caches.hold(__name__, chunks_for.cache_clear)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenized(
    docs: DataFrame,
    tokenizer: str | None = None,
    length: int = LENGTH,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``length`` tokens: doc_id, piece, start, length, ids_crc32.

    ``with_ids`` adds ``ids``, binary, little-endian unsigned 32-bit.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    closing = np.array([CLOSING], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunks_for(tokenizer or default_tokenizer())
        for batch in batches:
            ids, texts = batch.column(0), pc.cast(batch.column(1), pa.binary())
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            low = 0
            upto = np.cumsum(sizes)
            while low < len(texts):
                base = upto[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(upto, base + AT_ONCE, "right")))
                rows: list[tuple] = []
                some = [x.as_py() or b"" for x in texts[low:high]]
                for one, raw in zip(ids[low:high].to_pylist(), chunks.encode(some)):
                    raw += closing
                    for k, at in enumerate(range(0, len(raw), 4 * length)):
                        part = raw[at : at + 4 * length]
                        rows.append((one, k, at // 4, len(part) // 4, zlib.crc32(part), part)[: len(names)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names
                )
                low = high

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, ddl)


def best_two_fit(lengths: list[int], room: int = LENGTH) -> list[list[int]]:
    """Bins of indices into ``lengths``. Lengths are from 1 to ``room``."""
    stacks: list[list[int]] = [[] for _ in range(room + 1)]
    for i, n in enumerate(lengths):
        stacks[n].append(i)
    free = sum(1 << n for n in range(1, room + 1) if stacks[n])  # bit n: a piece of n is unpacked

    def largest(most: int) -> int:
        return (free & ((2 << most) - 1)).bit_length() - 1

    def take(n: int) -> int:
        nonlocal free
        i = stacks[n].pop()
        if not stacks[n]:
            free ^= 1 << n
        return i

    def give_back(n: int, i: int) -> None:
        nonlocal free
        stacks[n].append(i)
        free |= 1 << n

    def pair(gap: int, over: int) -> tuple[int, int] | None:
        """The two unpacked lengths of the largest sum in (over, gap]."""
        best, most = None, over
        a = largest(gap // 2)
        while a > 0 and most < gap:
            b = largest(gap - a)
            if b == a and len(stacks[a]) < 2:
                b = 0
            if b >= a and a + b > most:
                best, most = (a, b), a + b
            a = largest(a - 1)
        return best

    bins = []
    while free:
        own, gap = [], room
        while gap and (n := largest(gap)) > 0:
            own.append((n, take(n)))
            gap -= n
        while gap and len(own) > 1:
            n, i = own[-1]
            found = pair(gap + n, n)
            if not found:
                break
            own.pop()
            a, b = found
            own += [(b, take(b)), (a, take(a))]
            give_back(n, i)
            gap += n - a - b
            own.sort(reverse=True)
        bins.append([i for _, i in own])
    return bins


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Staged pieces with ``sequence_id`` and ``offset``. A piece of full length is a sequence.

    ``pieces`` must be a written table, so that its rows number alike on every reading.
    """
    numbered = pieces.withColumn("row_no", F.monotonically_increasing_id())
    full = numbered.where(F.col("length") >= length).select(
        *pieces.columns, (-1 - F.col("row_no")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = numbered.where(F.col("length") < length)
    groups = max(1, short.count() // GROUP_PIECES)
    short = short.withColumn("pack_group", F.pmod(F.xxhash64("row_no"), F.lit(groups))).drop("row_no")

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows["length"].tolist()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for k, own in enumerate(best_two_fit(sizes, length)):
            at = 0
            for i in own:
                sequence[i], offset[i] = (int(key[0]) << 32) + k, at
                at += sizes[i]
        return rows.drop(columns="pack_group").assign(sequence_id=sequence, offset=offset)

    packed = short.groupBy("pack_group").applyInPandas(one, full.schema)
    return full.unionByName(packed)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from packed pieces with ids: sequence_id, n_tokens, ids binary."""
    part = F.struct("offset", "ids")
    parts = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(part)).alias("parts")
    )
    ids = F.aggregate("parts", F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    return parts.select("sequence_id", "n_tokens", ids.alias("ids"))


def op9_best_two_fit(spark, sf: str) -> DataFrame:
    return pack(stage(tokenized(spark.read.parquet(f"{sf}/documents.parquet")), "pieces"))
