"""Positive-unlabelled quality scores: moments and prior by hand, held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import pu_quality, registry


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def area(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


@pytest.mark.parametrize("table, least", [("sf0.01", 0.95), ("sf0.1", 0.98)])
def test_held_out_accuracy(spark, table, least):
    root = f"/root/testdata/{table}"
    got = registry.QUERIES["op12_nnpu_quality"](spark, root)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    labelled = got.join(spark.read.parquet(f"{root}/labels.parquet"), "doc_id").where("held_out").toPandas()
    score, label = labelled["score"].to_numpy(), labelled["quality"].to_numpy()
    assert area(score, label) >= least
    assert (labelled["predicted"] == label).mean() >= 0.95
    assert (labelled["predicted"][label == 1]).mean() >= 0.95


def test_rows_and_labels(spark, tmp_path, docs, awkward):
    """Every row is scored; held-out labels and other columns change nothing."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = sorted({i for i, _ in awkward if i is not None})
    given = [(i, 1) for i in ids if i % 2] + [(i, 0) for i in ids if not i % 2] + [(None, 1)]
    op = registry.QUERIES["op12_nnpu_quality"]
    seen = []
    for k, labels in enumerate([given, [(i, 1 - q if held(i) else q) for i, q in given]]):
        root = f"{tmp_path}/{k}"
        docs.withColumn("source", F.lit(f"s{k}")).withColumn("lang", F.lit(k)).write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{root}/labels.parquet")
        seen.append(sorted((str(r.doc_id), r.held_out, r.score, r.predicted) for r in op(spark, root).collect()))
    assert seen[0] == seen[1] and len(seen[0]) == len(awkward)
    for doc_id, out, score, predicted in seen[0]:
        assert out == held(None if doc_id == "None" else int(doc_id))
        assert 0 < score < 1 and predicted == (score >= 0.3)
    assert len({r[2] for r in seen[0]}) > 10


def test_no_positives_and_no_rows(spark, tmp_path, docs, no_docs):
    op = registry.QUERIES["op12_nnpu_quality"]
    for k, (rows, n) in enumerate([(docs, docs.count()), (no_docs, 0)]):
        root = f"{tmp_path}/{k}"
        rows.write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame([(3, 0), (4, 1), (4, 0)], "doc_id long, quality int").write.parquet(f"{root}/labels.parquet")
        assert [r.score for r in op(spark, root).collect()] == [0.5] * n


def test_measures():
    assert pu_quality.rates(b"") == [0.0] * len(pu_quality.SCALES)
    text = b"One two, one.\n\nOne two, one.\nABC 12 | \xc3\xa9\x01"
    got = dict(zip(["comma", "point", "commonest", "repeated"], pu_quality.rates(text)[-4:]))
    assert got == {"comma": 2 / 10, "point": 2 / 10, "commonest": 2 / 10, "repeated": 6 / 10}
    assert pu_quality.rates(text)[pu_quality.MARKS.index(ord("|"))] == 1 / len(text)
    long = b"word and other words. " * 400_000  # several blocks
    assert np.allclose(pu_quality.rates(long)[:39], pu_quality.rates(long[: 22 * 1000])[:39], atol=1e-9)


def test_moments_are_whole_sums(spark, docs):
    table = pu_quality.measured(docs).cache()
    x = np.array([np.frombuffer(bytes(r.measures), "<i2") for r in table.collect()], np.int64)
    x = np.hstack([np.full((len(x), 1), pu_quality.UNIT), x])
    for parts in (1, 7):
        got = pu_quality.moments(table.repartition(parts))
        assert got.n == len(x)
        assert np.array_equal(np.rint(got.product * len(x) * pu_quality.UNIT**2), x.T @ x)
    table.unpersist()


def test_prior_and_risk(spark):
    """A planted share of positives among made rows is found and the risk does not go below zero."""
    rnd = np.random.default_rng(2)
    for share in (0.6, 0.85):
        good = rnd.random(8000) < share
        rows = rnd.integers(0, 400, (8000, pu_quality.WIDTH))
        rows[~good, :6] += 2500
        given = [(int(k), bytearray(r.astype("<i2").tobytes())) for k, r in enumerate(rows)]
        corpus = spark.createDataFrame(given, "doc_id long, measures binary").cache()
        trusted = [int(k) for k in np.flatnonzero(good)[::3]]
        positives = corpus.where(F.col("doc_id").isin(trusted)).cache()
        model = pu_quality.fit(positives, corpus)
        assert abs(model.prior - share) < 0.06
        assert model.negative_risk > -0.02
        got = pu_quality.scored(corpus, model).toPandas().sort_values("doc_id")
        assert ((got["predicted"].to_numpy() == 1) == good).mean() > 0.99


def test_bent_keeps_order():
    x = np.linspace(-3, 4, 500)
    y = pu_quality.bent(x)
    assert (np.diff(y) >= 0).all() and 0 <= y.min() and y.max() <= 1
    middle = (x > 0.05) & (x < 0.95)
    assert np.allclose(y[middle], x[middle])
