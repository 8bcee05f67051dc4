"""Token counts by a linear longest-match automaton over a piece vocabulary.

Greedy word-piece encoding takes the longest vocabulary piece, again and again. The automaton
is the trie of all pieces. Each node has a failure link, to the node of what remains once the
pieces that are then certain are popped, and the number of those pieces. A word is read once,
character by character, adding popped counts on failure; no piece is ever cut out.

Words are runs of anything but the six ASCII white-space characters, each led by the
vocabulary's word-start mark. A word that can't be covered is one unknown token.

Defined cases: null and empty texts have no words; repeated rows are counted alike; null ids
stay null; an empty table gives an empty result; very long texts are walked whole, one at a
time. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "▁"
#: Entries a worker's cache of word counts holds; further words are counted anew.
CACHED = 400_000


class Automaton:
    """Trie with failure links. Node 0 is the root; a link of -1 means there is none."""

    def __init__(self, pieces: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        ends = set()
        for piece in pieces:
            node = 0
            for char in piece:
                if char not in self.next[node]:
                    self.next[node][char] = len(self.next)
                    self.next.append({})
                node = self.next[node][char]
            if piece:
                ends.add(node)
        self.link, self.popped = [-1] * len(self.next), [0] * len(self.next)
        level = [(0, char, child) for char, child in self.next[0].items()]
        while level:
            for parent, char, node in level:
                if node in ends:
                    self.link[node], self.popped[node] = 0, 1
                    continue
                at, count = self.link[parent], self.popped[parent]
                while at >= 0 and char not in self.next[at]:
                    count += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[node], self.popped[node] = self.next[at][char], count
            level = [(node, char, child) for _, _, node in level for char, child in self.next[node].items()]

    def count(self, word: str) -> int:
        """Pieces of the greedy longest-match cover; 1, the unknown token, if there is none."""
        nodes, link, popped = self.next, self.link, self.popped
        node = total = 0
        for char in word:
            while char not in nodes[node]:
                if link[node] < 0:
                    return 1
                total += popped[node]
                node = link[node]
            node = nodes[node][char]
        while node:
            if link[node] < 0:
                return 1
            total += popped[node]
            node = link[node]
        return total


class WordCounts(dict):
    """Piece counts of words, as UTF-8 bytes, each counted once while the cache has room."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(START + word.decode())
        if len(self) < CACHED:
            self[word] = n
        return n


def pieces_of(model: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model file."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_file=model)
    special = lambda i: p.IsControl(i) or p.IsUnknown(i) or p.IsByte(i) or p.IsUnused(i)
    return [p.IdToPiece(i) for i in range(p.GetPieceSize()) if not special(i)]


@lru_cache(maxsize=2)
def counts_for(model: str) -> WordCounts:
    return WordCounts(Automaton(pieces_of(model)))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_counts(docs: DataFrame, model: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Words and greedy pieces per document. ``model`` names a file every executor has."""
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = counts_for(model or default_model()).__getitem__
        for batch in batches:
            texts = pc.cast(batch.column(1), pa.binary())
            words = [(x.as_py() or b"").split() for x in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([sum(map(get, w)) for w in words], pa.int64()),
                ],
                schema=out,
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_words long, n_tokens long")


def op7_wordpiece_counts(spark, sf: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf}/documents.parquet"))
