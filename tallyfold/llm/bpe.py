"""Byte-level BPE: pre-tokens by array scans, merges by a cache, offsets kept for decoding.

Pre-tokenisation runs over whole batches of texts. Every code point gets a class from a
table, and its neighbours turn the class into one of sixteen symbols. A symbol is a function
on the eight states of a small automaton. Functions compose associatively, so their products
over a batch are found by a blocked scan: within all blocks at once, then across blocks. The
state before a code point and its symbol say whether a pre-token starts there. There is no
regular expression.

The slices between starts are encoded by merging the pair of lowest rank until none is left,
each distinct slice once while the cache has room.

Defined cases: a null text is empty and has no tokens; repeated rows are encoded alike; null
ids stay null; an empty table gives an empty result. Only the named columns are read. Code
points are classed by Python's Unicode tables. Very long texts are scanned in parts of a million
code points, whose states join up, so no boundary is lost.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slices a worker's cache holds; further ones are merged anew.
CACHED = 300_000
#: Code points scanned at once, and the length of a scan's blocks.
SCAN, BLOCK = 1 << 20, 256

LETTER, NUMBER, OTHER, SPACE = range(4)
#: White space as Unicode's White_Space property has it (fixed values).
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]

# Symbols. QUOTE1 and QUOTE2 are apostrophes before an ending of one or two letters. INNER is
# white space before white space or the text's end; BLANK is a plain space and BREAK any other
# white space, before anything else. Eight more are the same at the start of a text.
S_LETTER, S_NUMBER, S_OTHER, QUOTE1, QUOTE2, INNER, BLANK, BREAK = range(8)
# States: what the pre-token that holds the last code point can go on with. ENDED: nothing.
# PREFIX: a space that any run may follow. LAST1, LAST2: that many letters of an ending.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, PREFIX, LAST1, LAST2, ENDED = range(8)
AFTER = {
    S_LETTER: (IN_LETTERS, {IN_LETTERS: IN_LETTERS, PREFIX: IN_LETTERS, LAST2: LAST1, LAST1: ENDED}),
    S_NUMBER: (IN_NUMBERS, {IN_NUMBERS: IN_NUMBERS, PREFIX: IN_NUMBERS}),
    S_OTHER: (IN_OTHERS, {IN_OTHERS: IN_OTHERS, PREFIX: IN_OTHERS}),
    QUOTE1: (LAST1, {IN_OTHERS: IN_OTHERS, PREFIX: IN_OTHERS}),
    QUOTE2: (LAST2, {IN_OTHERS: IN_OTHERS, PREFIX: IN_OTHERS}),
    INNER: (IN_SPACE, {IN_SPACE: IN_SPACE}),
    BLANK: (PREFIX, {}),
    BREAK: (ENDED, {}),
}


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    of = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE
    return table


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, symbol -> function, products of functions, function and state -> state).

    ``starts[state, symbol]``: a pre-token starts at the symbol. Functions are numbered;
    all products of the sixteen symbols' functions, and the identity as number 0.
    """
    starts = np.ones((8, 16), bool)
    moves = []
    for symbol in range(16):
        new, goes_on = AFTER[symbol % 8]
        moves.append(tuple(new if symbol >= 8 else goes_on.get(state, new) for state in range(8)))
        for state in goes_on if symbol < 8 else ():
            starts[state, symbol] = False
    known = {tuple(range(8)): 0}
    todo = [tuple(range(8))]
    for f in todo:
        for g in moves:
            product = tuple(g[x] for x in f)
            if product not in known:
                known[product] = len(known)
                todo.append(product)
    n = len(known)
    products = np.zeros((n, n), np.uint16)
    for f, i in known.items():
        for g, k in known.items():
            products[i, k] = known[tuple(g[x] for x in f)]
    return starts, np.array([known[m] for m in moves], np.uint16), products, np.array(list(known), np.uint8)


def symbols_of(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``first`` marks where texts start."""
    classes = class_table()[codes]
    follows = np.append(~first[1:], False)
    nxt = np.append(classes[1:], SPACE)
    white = classes == SPACE
    inner = white & (~follows | (nxt == SPACE))
    symbols = classes.copy()
    symbols[white] = np.where(codes[white] == 32, BLANK, BREAK)
    symbols[inner] = INNER
    at = np.flatnonzero((codes == 39) & follows)
    if len(at):
        one = np.append(codes[1:], 0)[at]
        two = np.where(np.append(follows[1:], False)[at], np.append(codes[2:], [0, 0])[at], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(at), bool)
        for ending in ("re", "ve", "ll"):
            long |= (one == ord(ending[0])) & (two == ord(ending[1]))
        symbols[at[short]] = QUOTE1
        symbols[at[long]] = QUOTE2
    symbols[first] += 8
    return symbols


def token_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, by a blocked scan of transition functions."""
    starts, function_of, products, states = automaton()
    symbols = symbols_of(codes, first)
    n = len(codes)
    rows = -(-n // BLOCK)
    functions = np.zeros(rows * BLOCK, np.uint16)
    functions[:n] = function_of[symbols]
    steps = np.ascontiguousarray(functions.reshape(rows, BLOCK).T)
    before = np.empty_like(steps)  # of each code point: the product of its block so far
    product = np.zeros(rows, np.uint16)
    for k in range(BLOCK):
        before[k] = product
        product = products[product, steps[k]]
    state, entry = ENDED, np.empty(rows, np.uint8)
    table = states.tolist()
    for r, f in enumerate(product.tolist()):
        entry[r] = state
        state = table[f][state]
    at = states[before, entry[None, :]].T.reshape(-1)[:n]
    return starts[at, symbols]


def pretokens(texts: list[str]) -> Iterator[list[str]]:
    """The pre-tokens of each text, in order."""
    group, size = [], 0
    for text in chain(texts, [None]):
        if group and (text is None or size + len(text) > SCAN):
            joined = "".join(group)
            codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            ends = np.cumsum([len(t) for t in group])
            first = np.zeros(len(codes), bool)
            first[np.array([0, *ends[:-1]])[np.diff(ends, prepend=0) > 0]] = True
            cuts = np.flatnonzero(token_starts(codes, first)) if len(codes) else np.empty(0, int)
            upto = np.searchsorted(cuts, ends).tolist()
            cuts = [*cuts.tolist(), len(codes)]
            low = 0
            for high in upto:
                yield [joined[a:b] for a, b in zip(cuts[low:high], cuts[low + 1 : high + 1])]
                low = high
            group, size = [], 0
        if text is not None:
            group.append(text)
            size += len(text)


class Merges(dict):
    """Ids of slices by pair merging, each slice once while the cache has room."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pieces = {i: b for b, i in ranks.items()}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.merge(piece.encode())
        if len(self) < CACHED:
            self[piece] = ids
        return ids

    def merge(self, raw: bytes) -> tuple[int, ...]:
        ranks = self.ranks
        if raw in ranks:
            return (ranks[raw],)
        if len(raw) > 400:
            return self.merge_long(raw)
        cuts = list(range(len(raw) + 1))
        far = len(ranks)
        rank = [ranks.get(raw[a : a + 2], far) for a in range(len(raw) - 1)]
        while rank:
            low = min(rank)
            if low == far:
                break
            k = rank.index(low)
            del cuts[k + 1], rank[k]
            if k < len(rank):
                rank[k] = ranks.get(raw[cuts[k] : cuts[k + 2]], far)
            if k:
                rank[k - 1] = ranks.get(raw[cuts[k - 1] : cuts[k + 1]], far)
        return tuple(ranks[raw[a:b]] for a, b in zip(cuts, cuts[1:]))

    def merge_long(self, raw: bytes) -> tuple[int, ...]:
        """The same for long slices, with a heap over linked parts: n log n steps."""
        from heapq import heapify, heappop, heappush

        ranks, n = self.ranks, len(raw)
        after, prior, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(ranks[p], a, a + 1, a + 2) for a in range(n - 1) if (p := raw[a : a + 2]) in ranks]
        heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, a, b, stop = heappop(heap)
            if not (alive[a] and b < n and alive[b] and after[a] == b and end[b] == stop and end[a] == b):
                continue
            end[a], after[a], alive[b] = stop, after[b], 0
            if after[a] < n:
                prior[after[a]] = a
                c = after[a]
                if (r := ranks.get(raw[a : end[c]])) is not None:
                    heappush(heap, (r, a, c, end[c]))
            if (p := prior[a]) >= 0 and (r := ranks.get(raw[p:stop])) is not None:
                heappush(heap, (r, p, a, stop))
        return tuple(ranks[raw[a : end[a]]] for a in range(n) if alive[a])

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@lru_cache(maxsize=2)
def merges_for(path: str) -> Merges:
    with open(path, "rb") as file:
        return Merges({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encode(docs: DataFrame, ranks: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids array and ends array: the byte offset in the text at which each token ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merges_for(ranks or default_ranks())
        for batch in batches:
            ids = [list(chain.from_iterable(map(merges.__getitem__, p))) for p in pretokens(_texts(batch))]
            ends = [np.cumsum([len(merges.pieces[i]) for i in x], dtype=np.int64).tolist() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int64()))],
                names=["doc_id", "ids", "ends"],
            )

    return _rows(docs, doc_id, text).mapInArrow(run, "doc_id long, ids array<int>, ends array<long>")


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id and the text that the ids stand for, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merges_for(ranks or default_ranks())
        for batch in batches:
            texts = [merges.decode(x.as_py() or ()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text binary")


def digests(docs: DataFrame, ranks: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token count, and SHA-256 of the ids and of the text decoded from them, per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merges_for(ranks or default_ranks())
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for pieces in pretokens(_texts(batch)):
                ids = list(chain.from_iterable(map(merges.__getitem__, pieces)))
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(merges.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _rows(docs, doc_id, text).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return batch.column(1).to_pylist()


def op6_byte_bpe(spark, sf: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf}/documents.parquet"))
