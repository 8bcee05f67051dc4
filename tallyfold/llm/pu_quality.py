"""Quality scores by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are documents labelled 1; the unlabelled side is the whole corpus. The loss is
squared, so every term of the risk is a quadratic form of a side's first two moments: one pass
over all documents gives the risk exactly for any weights, and the fit itself is a descent on
matrices of a fixed size. Measures are kept as 12-bit integers, so moments are whole numbers
that come out alike in whatever order tasks finish, exact up to 2**39 documents.

The class prior is estimated from the corpus as well: positives and corpus are told apart by
least squares, and the least ratio of their shares above a threshold, with bounds for the
thinner shares, is the prior. A score is the class probability the fitted function stands for,
with tails bent so that order is kept between 0 and 1.

Measures come from the bytes, words and lines of the whole text alone, in blocks for long ones.

Defined cases: null and empty texts have all measures zero and get a score like any other; null
ids are held out; a document labelled both ways is no positive; repeated rows count and are
scored each; without documents the result is empty, without positives every score is one half;
lang, source, ids and further columns are not measured, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.session import stage

THRESHOLD = 0.3
#: Whole numbers that stand for one; bins of the prior's histograms and the deviations they span.
UNIT, BINS, SPAN = 4096, 2048, 8.0
#: Weight decay and steps of the descent; confidence of the prior's bounds.
DECAY, STEPS, CONFIDENCE = 1e-3, 3000, 0.1
BLOCK = 4 << 20

MARKS = list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
#: Each measure is bent as x / (x + s) at its scale s and at eight times that.
SCALES = np.array(
    [0.002] * len(MARKS)
    + [0.01, 0.03, 0.2, 0.1, 0.01, 0.05, 0.01]  # digits, upper, lower, blank, line end, beyond ASCII, control
    + [0.5, 0.4, 0.3, 0.1, 0.5]  # words: number, length, short, long, distinct
    + [0.5, 0.5, 0.3]  # lines: distinct, number, words in each
    + [0.05, 0.05, 0.1, 0.3]  # words ending in a comma, in a point; commonest word, repeated words
)
BENT = np.concatenate([SCALES, 8 * SCALES])
WIDTH = len(BENT)


def _blocks(raw: bytes) -> Iterator[bytes]:
    low = 0
    while len(raw) - low > BLOCK:
        high = max(raw.rfind(b" ", low, low + BLOCK), raw.rfind(b"\n", low, low + BLOCK))
        high = high if high > low else low + BLOCK
        yield raw[low:high]
        low = high
    yield raw[low:]


def rates(raw: bytes) -> list[float]:
    if not raw:
        return [0.0] * len(SCALES)
    n = len(raw)
    held = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    beyond = held[0xC0:].sum()
    control = held[:32].sum() - held[9:14].sum()
    out = [held[c] / n for c in MARKS]
    out += [x / n for x in (held[48:58].sum(), held[65:91].sum(), held[97:123].sum(), held[32], held[10], beyond, control)]
    words: Counter = Counter()
    for block in _blocks(raw):
        words.update(block.split())
    times = np.fromiter(words.values(), np.int64, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = max(int(times.sum()), 1)
    out += [
        np.log1p(total) / 10,
        float(times @ sizes) / total / 20,
        times[sizes <= 3].sum() / total,
        times[sizes >= 12].sum() / total,
        len(words) / total,
    ]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_lines = max(len(lines), 1)
    out += [len(set(lines)) / n_lines, np.log1p(len(lines)) / 10, total / n_lines / 200]
    ends = [w[-1:] for w in words]
    out += [sum(t for t, e in zip(words.values(), ends) if e == mark) / total for mark in (b",", b".")]
    return out + [times.max(initial=0) / total, times[times > 1].sum() / total]


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and its measures, binary: WIDTH little-endian 16-bit numbers from 0 to UNIT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(batch.column(1), pa.binary())
            x = np.array([rates(t.as_py() or b"") for t in texts]).reshape(len(texts), len(SCALES))
            x = np.tile(x, 2)
            packed = np.rint(UNIT * x / (x + BENT)).astype("<i2")
            rows = pa.array([r.tobytes() for r in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), rows], ["doc_id", "measures"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, measures binary")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of measures with a leading UNIT, which stands for the constant."""
    x = np.frombuffer(b"".join(column.to_pylist()), "<i2").reshape(len(column), WIDTH)
    return np.hstack([np.full((len(x), 1), UNIT), x]).astype(np.float64)


class Moments(NamedTuple):
    """Rows, means and mean products of the constant and the measures."""

    n: int
    mean: np.ndarray
    product: np.ndarray


def moments(rows: DataFrame) -> Moments:
    """Moments of a table of measures; the driver gets one number per pair of measures."""
    size = WIDTH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0))
            total += (x.T @ x).astype(np.int64)  # whole numbers below 2**53
        place = pa.array(np.arange(size * size), pa.int32())
        yield pa.RecordBatch.from_arrays([place, pa.array(total.ravel())], ["place", "total"])

    parts = rows.select("measures").mapInArrow(run, "place int, total long")
    got = parts.groupBy("place").agg(F.sum("total").alias("total")).toPandas()
    whole = np.zeros(size * size)
    whole[got["place"].to_numpy()] = got["total"].to_numpy() / UNIT**2
    whole = whole.reshape(size, size)
    n = int(round(whole[0, 0]))
    return Moments(n, whole[0] / max(n, 1), whole / max(n, 1))


class Model(NamedTuple):
    """Weights of the constant and the measures; the prior; the last negative-class risk."""

    weights: np.ndarray
    prior: float
    negative_risk: float


def _counts(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Rows by bin of their weighted sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            at = np.floor((_matrix(batch.column(0)) @ weights / SPAN + 1) * BINS / 2)
            total += np.bincount(np.clip(at, 0, BINS - 1).astype(np.int64), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS), pa.int32()), pa.array(total)], ["bin", "n"])

    parts = rows.select("measures").mapInArrow(run, "bin int, n long")
    got = parts.groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BINS)
    out[got["bin"].to_numpy()] = got["n"].to_numpy()
    return out


def class_prior(positives: DataFrame, corpus: DataFrame, u: Moments) -> float:
    """The share of positives in the corpus, seldom above the truth.

    Half of the positives, by a hash of the id, teach what tells them from the corpus; the
    other half are counted, so that what the first half fits by chance does not count.

    Where positives are dense the corpus is nearly pure, so the ratio of the corpus's share to
    the positives' share above a threshold falls to the prior. The threshold is the one of the
    least ratio after a bound for chance is added to the corpus's share.
    """
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    p, counted = moments(positives.where(half)), positives.where(~half)
    if not p.n or counted.isEmpty():
        p, counted = moments(positives), positives
    ridge = DECAY * np.diag(np.r_[1.0, np.maximum(np.diag(u.product)[1:] - u.mean[1:] ** 2, 1e-9)])
    w = np.linalg.solve(p.product + u.product + ridge, p.mean - u.mean)
    centre = w @ u.mean
    spread = np.sqrt(max(w @ u.product @ w - centre**2, 1e-12))
    w[0] -= centre
    own, all_ = (_counts(x, w / spread / UNIT) for x in (counted, corpus))
    share_p, share_u = (np.cumsum(x[::-1])[::-1] / x.sum() for x in (own, all_))
    chance = sum(np.sqrt(np.log(4 / CONFIDENCE) / 2 / x.sum()) for x in (own, all_))
    some = share_p > 0
    at = np.argmin((share_u[some] + chance) / share_p[some])
    return float(np.clip(share_u[some][at] / share_p[some][at], 0.01, 0.99))


def fit_weights(p: Moments, u: Moments, prior: float) -> tuple[np.ndarray, float]:
    """Weights of least non-negative risk, over centred and scaled measures.

    The risk is prior * E_p[(g - 1)^2] + max(0, E_u[(g + 1)^2] - prior * E_p[(g + 1)^2]), over
    four. Where the second part falls below zero, which only over-fitting can bring about, the
    step undoes that instead.
    """
    spread = np.sqrt(np.maximum(np.diag(u.product) - u.mean**2, 1e-6))
    turn = np.diag(1 / spread)
    turn[:, 0] = -u.mean / spread
    turn[0] = 0.0
    turn[0, 0] = 1.0
    (a_p, m_p), (a_u, m_u) = ((turn @ x.product @ turn.T, turn @ x.mean) for x in (p, u))
    rate = 1 / np.linalg.eigvalsh(a_u + a_p)[-1]
    w, risk = np.zeros(len(m_u)), 0.0
    for _ in range(STEPS):
        risk = (w @ a_u @ w + 2 * m_u @ w + 1 - prior * (w @ a_p @ w + 2 * m_p @ w + 1)) / 4
        negative = (a_u @ w + m_u - prior * (a_p @ w + m_p)) / 2
        step = prior * (a_p @ w - m_p) / 2 + negative if risk >= 0 else -negative
        w = w - rate * (step + DECAY * w)
    return turn.T @ w, float(risk)


def fit(positives: DataFrame, corpus: DataFrame) -> Model:
    """From staged measures of the trusted positives and of the whole corpus."""
    p, u = moments(positives), moments(corpus)
    if not p.n:
        return Model(np.zeros(WIDTH + 1), 0.5, 0.0)
    prior = class_prior(positives, corpus, u)
    weights, risk = fit_weights(p, u, prior)
    return Model(weights, prior, risk)


def bent(chance: np.ndarray, edge: float = 0.05) -> np.ndarray:
    """Into (0, 1) in the same order; numbers between edge and 1 - edge stay as they are."""
    low = edge * np.exp((np.minimum(chance, edge) - edge) / edge)
    high = 1 - edge * np.exp((1 - edge - np.maximum(chance, 1 - edge)) / edge)
    return np.where(chance < edge, low, np.where(chance > 1 - edge, high, chance))


def scored(rows: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of a table of measures."""
    weights = model.weights / UNIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = bent((_matrix(batch.column(1)) @ weights + 1) / 2)
            predicted = pa.array((score >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), predicted], ["doc_id", "score", "predicted"]
            )

    return rows.select("doc_id", "measures").mapInArrow(run, "doc_id long, score double, predicted int")


def held_out(doc_id: str = "doc_id"):
    """Whether labels of the id are kept for the test: crc32 of its text divides by five."""
    text = F.col(doc_id).cast("string").cast("binary")
    return F.coalesce(F.pmod(F.crc32(text), F.lit(5)) == 0, F.lit(True))


def op12_nnpu_quality(spark, sf: str) -> DataFrame:
    corpus = stage(measured(spark.read.parquet(f"{sf}/documents.parquet")), "measures")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    trusted = labels.where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("least")).where("least = 1")
    positives = stage(corpus.join(trusted.select("doc_id"), "doc_id", "left_semi"), "positives")
    model = fit(positives, corpus)
    return scored(corpus, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
