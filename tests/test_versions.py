"""Versioned tables, what derives from them, and sinks that never show half a table."""

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from tallyfold import session
from tallyfold.plans import reports
from tallyfold.sources import curated, jdbc, versions
from workload.inputs import AS_OF, FLOOR, extracts
from workload.queries import shown

SCHEMA = "id long, day date, v string"


def table(spark, rows):
    return spark.createDataFrame([(i, dt.date.fromisoformat(d) if d else None, v) for i, d, v in rows], SCHEMA)


def month_of():
    return F.date_format("day", "yyyy-MM")

ROWS = [(1, "2024-01-05", "a"), (2, "2024-01-05", "a"), (2, "2024-01-05", "a"), (3, "2024-02-01", None),
        (4, None, "d"), (5, "2024-03-31", "e")]


def read(spark, root, **more):
    return sorted(map(str, versions.read_version(spark, root, "t", **more).collect()))


def want(spark, rows):
    return sorted(map(str, table(spark, rows).collect()))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_only_parts_that_changed_are_written(spark, root):
    first = versions.publish(table(spark, ROWS).repartition(4), root, "t", month_of())
    assert set(first.parts) == {"2024-01", "2024-02", "2024-03", versions.NO_PART}
    assert first.parts["2024-01"].rows == 3 and read(spark, root) == want(spark, ROWS)
    again = versions.publish(table(spark, ROWS[::-1]).coalesce(1), root, "t", month_of())
    assert again.number == 1  # neither order nor partitions matter
    changed = [r for r in ROWS if r[0] != 5] + [(2, "2024-01-05", "a"), (6, "2024-04-01", "f")]
    second = versions.publish(table(spark, changed), root, "t", month_of())
    moved = {p for p, x in second.parts.items() if x.folder != (first.parts[p].folder if p in first.parts else None)}
    assert moved == {"2024-01", "2024-04"} and "2024-03" not in second.parts  # one row more; a new month; one gone
    assert read(spark, root) == want(spark, changed)
    assert read(spark, root, version=first) == want(spark, ROWS)
    assert read(spark, root, version=versions.current(spark, root, "t", 1)) == want(spark, ROWS)
    only = versions.read_version(spark, root, "t", parts=["2024-02", "2031-01"])
    assert [r.id for r in only.collect()] == [3] and len(only.inputFiles()) == 1


def test_a_write_that_dies_changes_nothing(spark, root, monkeypatch):
    versions.publish(table(spark, ROWS), root, "t", month_of())
    bad = table(spark, [(9, "2024-02-01", "x"), (10, "2024-05-01", "y")]).repartition(2)
    dies = bad.withColumn("v", F.when(F.rand() < 2, F.when(F.col("id") == 10, F.raise_error(F.lit("dead"))).otherwise(F.col("v"))))
    with pytest.raises(Exception, match="dead"):
        versions._write(dies, root, "t", "data/00000002-dead", month_of())
    assert read(spark, root) == want(spark, ROWS)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_name_version", killed)
        with pytest.raises(KeyboardInterrupt):
            versions.publish(bad, root, "t", month_of())
    assert read(spark, root) == want(spark, ROWS) and versions.current(spark, root, "t").number == 1
    versions.publish(bad, root, "t", month_of())
    assert [r.id for r in versions.read_version(spark, root, "t").orderBy("id").collect()] == [9, 10]
    gone = versions.sweep(spark, root, "t", keep=1)
    assert len(gone) >= 2 and [r.id for r in versions.read_version(spark, root, "t").orderBy("id").collect()] == [9, 10]


def test_sweep_keeps_what_newer_versions_use(spark, root):
    for k in range(4):
        rows = [(i, d, f"{v}{k}" if d == "2024-02-01" else v) for i, d, v in ROWS]
        versions.publish(table(spark, rows), root, "t", month_of())
    assert len(versions.sweep(spark, root, "t", keep=2)) == 1  # of version 2; version 1 holds the other months
    assert read(spark, root) == want(spark, rows)
    assert len(read(spark, root, version=versions.current(spark, root, "t", 3))) == len(ROWS)
    assert versions.sweep(spark, root, "nothing") == []


def test_the_second_of_two_writers_is_told(spark, root, monkeypatch):
    versions.publish(table(spark, ROWS[:1]), root, "t", month_of())
    names = iter(["a" * 32, "b" * 32])
    monkeypatch.setattr(versions.uuid, "uuid4", lambda: type("U", (), {"hex": next(names)}))
    old = versions.current(spark, root, "t")
    one, folder = versions._next(old, old.schema)
    winner = versions.publish(table(spark, ROWS[3:4]), root, "t", month_of())
    with pytest.raises(versions.Conflict):
        versions._name_version(spark, root, "t", one)
    assert versions.current(spark, root, "t").writer == winner.writer
    assert read(spark, root) == want(spark, ROWS[3:4])


def test_empty_tables_and_other_columns(spark, root):
    assert versions.current(spark, root, "t") is None
    with pytest.raises(ValueError):
        versions.read_version(spark, root, "t")
    versions.publish(table(spark, []), root, "t", month_of())
    assert read(spark, root) == []
    versions.publish(table(spark, ROWS), root, "t", month_of())
    wider = table(spark, ROWS).withColumn("a/b", F.lit(1))
    second = versions.publish(wider, root, "t", month_of())
    assert second.number == 3 and versions.read_version(spark, root, "t").columns == [*wider.columns]
    with pytest.raises(ValueError, match="plain"):
        versions.publish(table(spark, [(1, None, "a/b")]), root, "t", "v")


def counted(df):
    return df.groupBy("day", month_of().alias("month")).agg(F.count("*").alias("n"))


def test_a_derived_table_reads_changed_months_only(spark, root):
    versions.publish(table(spark, ROWS), root, "t", month_of())
    seen = []

    def build(df):
        if df.inputFiles():
            seen.append(sorted({f.split(f"{versions.PART}=")[1].split("/")[0] for f in df.inputFiles()}))
        return counted(df).where("month IS NULL OR month <> '2024-03'")

    month = F.col("month")
    first = versions.refresh(spark, root, "t", "sums", build, month)
    assert first.made == ("2024-01", "2024-02", "2024-03", versions.NO_PART) and first.kept == ()
    assert first.version.parts["2024-03"].folder is None  # no rows of it stay
    assert versions.refresh(spark, root, "t", "sums", build, month).made == ()
    rows = [(i, d, "new" if d == "2024-02-01" else v) for i, d, v in ROWS] + [(7, "2024-06-01", "g")]
    versions.publish(table(spark, [r for r in rows if r[0] != 4]), root, "t", month_of())
    second = versions.refresh(spark, root, "t", "sums", build, month)
    assert second.made == ("2024-02", "2024-06") and set(second.kept) == {"2024-01", "2024-03"}
    assert seen == [["2024-01", "2024-02", "2024-03", versions.NO_PART], ["2024-02", "2024-06"]]
    got = {(str(r.day), r.n) for r in versions.read_version(spark, root, "sums").collect()}
    assert got == {("2024-01-05", 3), ("2024-02-01", 1), ("2024-06-01", 1)}
    with pytest.raises(ValueError, match="another part"):
        versions.refresh(spark, root, "t", "odd", lambda df: counted(df).withColumn("month", F.lit("2020-01")), month)


def test_reports_from_a_store(spark, root):
    """A second run sums again only the month that changed; the reports are those of a fresh run."""
    given = extracts(spark, "/root/testdata/sf0.001")
    options = reports.ReportOptions(as_of=AS_OF, floor=FLOOR)
    late = given["VBRP"].where("NOT (VBELN = '7' AND POSNR = '1')")
    before = reports.Reports(spark, given | {"VBRP": late}, options, root)
    assert before.daily.count() and len(before.refreshed.made) > 50
    after = reports.Reports(spark, given, options, root)
    after.daily
    day = given["VBRK"].where("VBELN = '7'").first()["FKDAT"]
    assert after.refreshed.made == (f"{day[:4]}-{day[4:6]}",)
    with reports.Reports(spark, given, options) as fresh:
        assert after.daily.exceptAll(fresh.daily).count() == fresh.daily.exceptAll(after.daily).count() == 0
        names = ["sales_register", "customer_budget"]
        for name in names:
            a, b = shown(after[name]), shown(fresh[name])
            assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
        paths = list(fresh.staged.paths)
        assert paths and all(spark.read.parquet(p).columns for p in paths)
    for path in paths:
        with pytest.raises(Exception):
            spark.read.parquet(path)


def test_remove_path(spark, root):
    for name in "abc":
        spark.range(1).write.parquet(f"{root}/x/{name}")
    assert len(session.remove_path(spark, f"{root}/x", keep=["b"])) == 2
    assert spark.read.parquet(f"{root}/x/b").count() == 1
    assert len(session.remove_path(spark, f"{root}/x")) == 1 and session.remove_path(spark, f"{root}/x") == []


# The database, played by a dictionary of tables


class Database:
    def __init__(self):
        self.tables, self.swaps, self.lose = {"sales": [1, 2]}, [], 0

    def write(self, df, url, table, options, **how):
        self.tables[table] = [r[0] for r in df.collect()][self.lose :]

    def count(self, spark, url, table, options):
        return len(self.tables[table])

    def swap(self, new, old):
        self.swaps.append((new, old))
        self.tables[old] = self.tables.pop(new)


@pytest.fixture
def database(monkeypatch):
    db = Database()
    monkeypatch.setattr(jdbc, "write_jdbc", db.write)
    monkeypatch.setattr(jdbc, "jdbc_count", db.count)
    return db


def test_publishing_in_two_steps(spark, database):
    assert jdbc.publish_jdbc(spark.range(5), "jdbc:any:x", "sales", {}, database.swap) == 5
    assert database.tables == {"sales": [0, 1, 2, 3, 4]} and database.swaps == [("sales__next", "sales")]


def test_a_failing_write_leaves_the_old_table(spark, database):
    database.lose = 1
    with pytest.raises(RuntimeError, match="left as it was"):
        jdbc.publish_jdbc(spark.range(5), "jdbc:any:x", "sales", {}, database.swap)
    dead = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("dead"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="dead"):
        jdbc.publish_jdbc(dead, "jdbc:any:x", "sales", {}, database.swap)
    assert database.tables["sales"] == [1, 2] and database.swaps == []


def test_reports_are_published_with_the_callers_settings(spark, monkeypatch):
    class Few(reports.Reports):
        NAMES = ("one", "two")

        def __getitem__(self, name):
            return self.spark.range({"one": 1, "two": 2}[name])

    calls = []
    monkeypatch.setattr(reports, "write_jdbc", lambda df, url, table, options, **how: calls.append((df.count(), table, how)))
    monkeypatch.setattr(
        reports, "publish_jdbc", lambda df, url, table, options, swap, **how: calls.append((df.count(), table, how, swap(1, 2)))
    )
    few = Few(spark, {}, reports.ReportOptions(as_of=AS_OF))
    reports.write_reports(few, "jdbc:any:x", {}, {"two": "zwei"}, connections=3)
    reports.write_reports(few, "jdbc:any:x", {}, swap=lambda new, old: new + old)
    assert calls == [(1, "one", {"connections": 3}), (2, "zwei", {"connections": 3}), (1, "one", {}, 3), (2, "two", {}, 3)]


def test_tables_are_ingested_side_by_side(spark, tmp_path, monkeypatch):
    """Two slow tables overlap; the failing one between them stops neither, and the order of the status stays."""
    raw = f"{tmp_path}/raw"
    for name in ("A", "C"):
        (tmp_path / "raw" / name).mkdir(parents=True)
        (tmp_path / "raw" / name / "x.csv").write_text("K^V\n1^2\n")
    together, plain, pools = threading.Barrier(2, timeout=60), curated.ingest, []

    def slow(session_, raw_root, root, name, sep, **more):
        pools.append(session_.sparkContext.getLocalProperty("spark.scheduler.pool"))
        if name != "missing":
            together.wait()  # passes only if both are on their way
        return plain(session_, raw_root, root, name, sep, **more)

    monkeypatch.setattr(curated, "ingest", slow)
    start = time.time()
    status = curated.ingest_all(spark, raw, f"{tmp_path}/curated", {"A": "^", "missing": "^", "C": "^"}, at_once=3)
    assert [(s.table, s.ok) for s in status] == [("A", True), ("missing", False), ("C", True)], status
    assert time.time() - start < 60 and sorted(pools) == ["ingest-A", "ingest-C", "ingest-missing"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert curated.read_table(spark, f"{tmp_path}/curated", "C").first().V == "2"
