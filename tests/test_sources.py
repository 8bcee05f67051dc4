import os

import pytest
from pyspark.sql import functions as F

from tallyfold import session
from tallyfold.plans.reports import read_curated
from tallyfold.sources import curated, delimited, jdbc


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_read_delimited_keeps_quotes_and_reads_folders(spark, tmp_path):
    write(f"{tmp_path}/T/a.csv", 'K^N\n 0001 ^"x\n')
    write(f"{tmp_path}/T/sub/b.csv", "K^N\n0^y, z\n")
    df = delimited.read_delimited(spark, f"{tmp_path}/T", "^")
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert rows(delimited.clean_extract(df, ["K"])) == [("", "y, z"), ("1", '"x')]


def test_read_delimited_over_lines(spark, tmp_path):
    write(f"{tmp_path}/T/a.csv", 'K,N\n1,"two\nlines"\n')
    df = delimited.read_delimited(spark, f"{tmp_path}/T", ",", multi_line=True)
    assert rows(df) == [("1", "two\nlines")]


def test_headers_that_differ_are_refused(spark, tmp_path):
    write(f"{tmp_path}/T/a.csv", "K^N\nx^1\n")
    write(f"{tmp_path}/T/b.csv", "N^K\n2^y\n")
    with pytest.raises(Exception):
        delimited.read_delimited(spark, f"{tmp_path}/T", "^").collect()
    write(f"{tmp_path}/U/a.csv", "K^N\nx^1^9\n")
    with pytest.raises(Exception):
        delimited.read_delimited(spark, f"{tmp_path}/U", "^").collect()


def test_ingest_options_and_stale_tables(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/curated"
    write(f"{raw}/KNA1/a.csv", 'K,N\n1,"two\nlines"\n')
    status = curated.ingest_all(
        spark, raw, root, {"KNA1": ",", "VBRK": "^"}, options={"KNA1": {"multi_line": True, "partition_by": ["K"]}}
    )
    assert rows(curated.read_table(spark, root, "KNA1").select("N")) == [("two\nlines",)]
    with pytest.raises(ValueError, match="VBRK"):
        read_curated(spark, root, status)


def test_ingest_all_goes_on_after_a_failure(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/curated"
    write(f"{raw}/A/a.csv", "K^V\n007^ 008 \n")
    write(f"{raw}/C/c.csv", "K,V\n007,008\n")
    report = curated.ingest_all(
        spark, raw, root, {"A": "^", "missing": "^", "C": ","}, zero_cols={"A": "all", "C": ["K"]}
    )
    assert [(s.table, s.ok) for s in report] == [("A", True), ("missing", False), ("C", True)]
    assert report[1].error
    assert rows(curated.read_table(spark, root, "A")) == [("7", "8")]
    assert rows(curated.read_table(spark, root, "C")) == [("7", "008")]


def test_write_table_overwrites_all_or_touched_partitions(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    curated.write_table(first, root, "t", partition_by=["p"])
    curated.write_table(first.filter("p = 'a'").withColumn("v", F.lit(9)), root, "t",
                        partition_by=["p"], touched_only=True)
    assert rows(curated.read_table(spark, root, "t")) == [(2, "b"), (9, "a")]
    curated.write_table(first.filter("p = 'a'"), root, "t", partition_by=["p"])
    assert rows(curated.read_table(spark, root, "t")) == [(1, "a")]


def test_partition_filter_prunes_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    curated.write_table(df, str(tmp_path), "t", partition_by=["p"])
    kept = curated.read_table(spark, str(tmp_path), "t").filter("p = 'a'")
    assert "PartitionFilters: [isnotnull(p" in kept._jdf.queryExecution().executedPlan().toString()


class Writer:
    """Records what is asked of a DataFrameWriter."""

    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **given):
        self.calls.update(given)
        return self

    def option(self, name, value):
        self.calls[name] = value
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def save(self):
        self.calls["saved"] = True


def test_write_jdbc_passes_the_callers_settings(spark, monkeypatch):
    writer = Writer()
    df = spark.createDataFrame([(1,)], "a int")
    monkeypatch.setattr(type(df), "write", property(lambda self: writer))
    jdbc.write_jdbc(df, "jdbc:any:x", "t", {"driver": "some.Driver", "user": "u"}, connections=4)
    assert writer.calls == {
        "format": "jdbc", "driver": "some.Driver", "user": "u", "url": "jdbc:any:x", "dbtable": "t",
        "numPartitions": 4, "batchsize": 10_000, "mode": "overwrite", "saved": True,
    }


def test_arrays_become_text(spark):
    df = spark.sql("SELECT 1 AS a, array(date'2024-04-01', date'2024-05-01') AS b")
    assert jdbc.without_arrays(df).first().b == "2024-04-01,2024-05-01"


def test_session_options_and_cache(spark):
    session.set_options(spark)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    df = spark.range(3)
    with session.cached(df) as kept:
        assert kept.is_cached and kept.count() == 3
    assert not df.is_cached
    df.persist()
    session.release_all(spark)
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_stage_reads_back_the_same(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a/b` int, `c d` string")
    staged = session.stage(df, "t")
    assert rows(staged) == rows(df) and staged.columns == df.columns
    assert session.scratch_root(spark) in staged.inputFiles()[0]


@pytest.mark.parametrize("name", ["stage", "checkpointed"])
def test_no_local_folder_on_a_cluster(spark, monkeypatch, name):
    class Context:
        master = "k8s://x"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        session.scratch_root(Session())
