"""Plans that have to hold when the data grows or leans on one key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import facts, groups, joins, running
from tests.compare import compare, connect
from workload.inputs import AS_OF, FLOOR, bills, headers
from workload.oracles import ORACLES
from workload.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_thresholds(spark):
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=300_000):
    """A third of the rows under key 0, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    return spark.range(n, numPartitions=8).select(key.alias("k"), F.col("id").alias("v"))


def test_a_hot_document_is_split(spark, small_thresholds):
    header = spark.range(6000).select(F.col("id").alias("k"))
    fact = facts.headers_with_items(header, hot(spark), "k")
    rows = fact.agg(F.count("*"), F.count("v")).first()
    assert tuple(rows) == (301_000, 300_000)
    joined = fact.select("k", "v")
    joined.collect()
    assert "skew=true" in plan(joined)


def test_a_hot_group_is_split_in_the_join_back(spark, small_thresholds):
    full = groups.with_group_totals(hot(spark), ["k"], {"total": F.sum("v")})
    assert len(full.collect()) == 300_000
    assert "skew=true" in plan(full)


def test_hot_keys_are_found_by_a_sample(spark):
    assert groups.hot_keys(hot(spark), ["k"]) == [(0,)]
    spread = spark.range(100_000).select((F.col("id") % 5000).alias("k"), F.lit(None).cast("string").alias("n"))
    assert groups.hot_keys(spread, ["k"]) == [] and groups.hot_keys(spread, ["n"]) == [(None,)]
    assert groups.hot_keys(spread.limit(0), ["k"]) == []


def test_even_groups_are_totalled_in_one_scan(spark):
    """Without a hot key the totals come from a window; the query reads orders twice, once for the months."""
    text = plan(REGISTRY["group_totals"](spark, SF))
    assert text.count("orders.parquet") == 2 and "Window" in text


def test_stored_buckets_join_without_an_exchange(spark, small_thresholds):
    df = REGISTRY["bucketed_fact"](spark, SF)
    text = plan(df)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert text.count("FileScan") == 2 and text.count("SelectedBucketsCount: 16 out of 16") == 2
    assert df.count() == REGISTRY["billing_fact"](spark, SF).count()


def test_even_documents_are_read_once(spark, small_thresholds):
    text = plan(REGISTRY["billing_fact"](spark, SF))
    assert text.count("FileScan") == 2 and text.count("Join") == 1


def test_a_hot_lookup_key_is_split(spark, small_thresholds):
    dim = spark.range(6000).select(F.col("id").alias("k"), F.lit("x").alias("n"))
    full = joins.left_lookup(hot(spark), dim, "k")
    assert len(full.collect()) == 300_000
    assert "skew=true" in plan(full)


def test_date_filters_reach_the_scan(spark):
    text = plan(headers(spark, SF, FLOOR, AS_OF))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_scans_read_only_needed_columns(spark):
    text = plan(bills(spark, SF).groupBy("product_brand").agg(F.sum("billed_quantity")))
    assert "l_extendedprice" not in text and "o_totalprice" not in text


def test_a_hot_group_is_sliced(spark):
    """A group with a third of the rows is spread over many slices of about equal size."""
    by = [running.Order("v", True, False)]
    cut = running.sliced(hot(spark), ["k"], by, "v", 24)
    sizes = [r["count"] for r in cut.rows.where("k = 0").groupBy("__slice").count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 300_000 / 24 * 2
    assert cut.total == sum(range(300_000))


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr(running, "SLICE_ROWS", 300)


@pytest.mark.parametrize("name", ["pareto_line", "running_sum_rows"])
def test_running_sums_read_the_lines_once(spark, small_slices, name):
    """The rows are read and sorted once; nothing is checkpointed or written beside them."""
    df = REGISTRY[name](spark, SF)
    text = plan(df)
    assert text.count("lineitem.parquet") == 1 and "ExistingRDD" not in text
    assert text.count("Window [") == 1


SUMS = ["pareto_line", "running_sum_rows", "pareto_brand_fy", "pareto_customer_fy", "cumulative_by_year"]


@pytest.mark.parametrize("name", SUMS)
def test_no_window_sorts_a_whole_group(spark, small_slices, name):
    """Groups beyond a slice are spread, and the sums stay the same."""
    if "brand" in name:
        running.SLICE_ROWS = 20
    df = REGISTRY[name](spark, SF)
    window = next(x for x in plan(df).splitlines() if "Window [" in x)
    assert "__slice" in window.split("], [")[1]
    got, want, extra, missing = compare(df, connect(SF), ORACLES[name])
    assert (got, extra, missing) == (want, [], [])


@pytest.mark.parametrize("name", ["customer_recency", "unbilled_months", "unbilled_months_all", "group_totals"])
def test_months_travel_as_bits(spark, name):
    text = plan(REGISTRY[name](spark, SF))
    assert "collect_set" not in text and "bit_or" in text
