"""Period measures against a brute-force reading of their definitions."""

import calendar
import datetime as dt
import itertools
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.periods import PERIODS, growth, per_day, period_measures, window_sums
from workload.queries import REGISTRY

AS_OF = dt.date(2024, 5, 20)
CENT = Decimal("0.01")


def last_day(d):
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


def add_months(d, n):
    month = d.year * 12 + d.month - 1 + n
    year, month = divmod(month, 12)
    return dt.date(year, month + 1, min(d.day, calendar.monthrange(year, month + 1)[1]))


def shift(d, n, eom):
    moved = add_months(d, n)
    return last_day(moved) if eom == "snap" and d == last_day(d) else moved


def fiscal_start(d):
    return dt.date(d.year if d.month >= 4 else d.year - 1, 4, 1)


def expected(bills, as_of, end_rule, ly_rule, eom, running):
    """{(key, month, period): value} by summing bills over each window."""
    months = {(k, d.replace(day=1)) for k, d, _ in bills}

    def total(key, first, last):
        return sum((v for k, d, v in bills if k == key and first <= d <= last), Decimal(0))

    out = {}
    for key, m in months:
        current = m == as_of.replace(day=1)
        end = min(as_of, last_day(m))

        def to_date_end(n):
            if current:
                return as_of if end_rule == "as_of" else shift(as_of, -n, eom)
            return last_day(add_months(end, -n))

        if ly_rule == "as_of":
            ly_end = as_of if current else last_day(add_months(end, -12))
        else:
            ly_end = shift(end, -12, eom)
        ly = total(key, add_months(m, -12), ly_end)
        if ly_rule == "reuse":
            year_ago = add_months(m, -12)
            hit = any(k == key and year_ago <= d <= ly_end for k, d, _ in bills)
            ly = total(key, year_ago, min(as_of, last_day(year_ago))) if hit else Decimal(0)
        l1 = total(key, add_months(m, -1), to_date_end(1))
        l2 = total(key, add_months(m, -2), to_date_end(2))
        before = add_months(m, -1)
        y_last = m
        if not running:
            y_last = max(x for k, x in months if k == key and fiscal_start(x) == fiscal_start(m))
        y_end = as_of if y_last == as_of.replace(day=1) else last_day(y_last)
        y_start = fiscal_start(m)
        values = {
            "MTD": total(key, m, end),
            "LYMTD": ly,
            "L1MTD": l1,
            "L2MTD": l2,
            "L2MMTD": (l1 + l2) / 2,
            "LM": total(key, before, last_day(before)),
            "LMMTD": total(key, before, shift(end, -1, eom)),
            "L2M": total(key, add_months(m, -2), last_day(before)) / 2,
            "YTD": total(key, y_start, y_end),
            "LYTD": total(key, add_months(y_start, -12), shift(y_end, -12, eom)),
        }
        for p, v in values.items():
            out[key, m, p] = v.quantize(CENT, ROUND_HALF_UP)
    return out


@pytest.fixture(scope="module")
def bills():
    rng = random.Random(7)
    first = dt.date(2022, 1, 1)
    rows = []
    for key in ("a", "b", None):
        for _ in range(120):
            day = first + dt.timedelta(days=rng.randrange(930))
            rows.append((key, day, Decimal(rng.randrange(-500, 100_000)) / 100))
    edges = ["2024-01-31", "2024-02-28", "2024-02-29", "2023-02-28", "2023-04-30", "2024-03-30",
             "2024-03-31", "2024-05-20", "2024-05-21", "2023-05-20", "2023-05-21", "2024-06-03"]
    rows += [("edge", dt.date.fromisoformat(d), Decimal("10.01")) for d in edges]
    rows += [("dup", dt.date(2024, 5, 1), Decimal("1.00"))] * 2
    rows += [("single", dt.date(2023, 11, 15), Decimal("3.33"))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, d date, v decimal(18,2)")


RULES = list(itertools.product(("shifted", "as_of"), ("clamp", "snap"), (True, False)))


@pytest.mark.parametrize("end_rule,eom,running", RULES)
def test_against_brute_force(spark, bills, end_rule, eom, running):
    got = period_measures(
        frame(spark, bills), ["k"], "d", {"": "v"}, AS_OF, end_rule=end_rule, eom=eom, running=running
    )
    want = expected(bills, AS_OF, end_rule, end_rule, eom, running)
    found = {(r.k, r.billing_month, p): r[p] for r in got.collect() for p in PERIODS}
    assert found == want


def test_reused_last_year(spark, bills):
    got = period_measures(frame(spark, bills), ["k"], "d", {"": "v"}, AS_OF, ["LYMTD"], ly_rule="reuse")
    want = expected(bills, AS_OF, "shifted", "reuse", "clamp", True)
    found = {(r.k, r.billing_month, "LYMTD"): r.LYMTD for r in got.collect()}
    assert found == {k: v for k, v in want.items() if k[2] == "LYMTD"}


def test_floor_changes_no_value(spark, bills):
    floor = dt.date(2023, 9, 1)
    full = period_measures(frame(spark, bills), ["k"], "d", {"": "v"}, AS_OF)
    cut = period_measures(frame(spark, bills), ["k"], "d", {"": "v"}, AS_OF, floor=floor)
    kept = full.filter(F.col("billing_month") >= F.lit(floor))
    assert sorted(map(str, cut.collect())) == sorted(map(str, kept.collect()))


def test_layout_changes_no_value(spark, bills):
    def run(rows, partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        df = period_measures(frame(spark, rows), ["k"], "d", {"": "v"}, AS_OF)
        return sorted(map(str, df.collect()))

    try:
        assert run(bills, 3) == run(list(reversed(bills)), 11)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_daily_sums_give_the_same(spark, bills):
    df = frame(spark, bills)
    daily = df.groupBy("k", "d").agg(F.sum("v").cast("decimal(18,2)").alias("v"))
    a = period_measures(df, ["k"], "d", {"": "v"}, AS_OF)
    b = period_measures(daily, ["k"], "d", {"": "v"}, AS_OF)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_invariants(spark, bills):
    as_of = dt.date(2024, 3, 31)
    rows = [r for r in bills if r[1] <= as_of]
    got = {(r.k, r.billing_month): r for r in period_measures(
        frame(spark, rows), ["k"], "d", {"": "v"}, as_of).collect()}
    for (key, month), r in got.items():
        total = sum((v for k, d, v in rows if k == key and d.replace(day=1) == month), Decimal(0))
        assert r.MTD == total
        before = got.get((key, add_months(month, -1)))
        assert r.LM == (before.MTD if before else 0)
        second = got.get((key, add_months(month, -2)))
        assert abs(r.L2M * 2 - r.LM - (second.MTD if second else 0)) <= CENT
        if month.month == 3:
            assert r.YTD == sum(
                (v for k, d, v in rows if k == key and fiscal_start(d) == fiscal_start(month)), Decimal(0)
            )


def test_growth_and_per_day(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 5, 1), 20, 10), (dt.date(2024, 4, 1), 30, 0)], "billing_month date, a int, b int"
    )
    grown = growth(df, {"g": ("a", "b")}).orderBy("a").collect()
    assert [r.g for r in grown] == [1.0, None]
    rated = per_day(df, {"r": "a"}, AS_OF).orderBy("a").collect()
    assert [(r.day_lapsed, r.r) for r in rated] == [(20, 1.0), (30, 1.0)]


def test_one_aggregate_and_no_join(spark, bills):
    df = period_measures(frame(spark, bills), ["k"], "d", {"": "v"}, AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_unknown_options(spark, bills):
    with pytest.raises(ValueError):
        period_measures(frame(spark, bills), ["k"], "d", {"": "v"}, AS_OF, ["QTD"])
    with pytest.raises(ValueError):
        period_measures(frame(spark, bills), ["k"], "d", {"": "v"}, AS_OF, end_rule="x")


def test_bills_delivered_twice_count_once_by_their_key(spark):
    given = [("a", 1, dt.date(2024, 5, 3), Decimal(5)), ("a", 2, dt.date(2024, 5, 3), Decimal(5)), ("b", 3, dt.date(2024, 5, 4), Decimal(7))]
    bills = spark.createDataFrame(given * 3, "k string, n int, d date, v decimal(18,2)")
    all_, once = (
        {r.k: int(r.MTD) for r in period_measures(bills, ["k"], "d", {"": "v"}, AS_OF, ["MTD"], line_key=key).collect()}
        for key in ([], ["n"])
    )
    assert all_ == {"a": 30, "b": 21} and once == {"a": 10, "b": 7}


def test_window_sums_against_brute_force(spark):
    rng = random.Random(8)
    start = dt.date(2023, 1, 1)
    bills = [(rng.choice(["a", "b", None]), start + dt.timedelta(days=rng.randrange(300)),
              rng.choice([None, Decimal(rng.randrange(-900, 900)) / 100]), rng.randrange(9)) for _ in range(400)]
    bills += [("a", None, Decimal(5), 1)]
    anchors = [(None, 900, start, start), ("c", 901, start, start), ("a", 902, None, start), ("a", 903, start, None)]
    for i in range(120):
        first = start + dt.timedelta(days=rng.randrange(-20, 320))
        anchors.append((rng.choice("ab"), i, first, first + dt.timedelta(days=rng.randrange(-3, 90))))
    anchors += [("b", 904, dt.date(1900, 1, 1), dt.date(2100, 1, 1))] * 2
    got = window_sums(
        spark.createDataFrame(anchors, "k string, i int, lo date, hi date").repartition(3),
        spark.createDataFrame(bills, "k string, d date, v decimal(18,2), q int").repartition(4),
        ["k"], "d", "lo", "hi", {"total": "v", "units": "q"}, "n",
    )
    assert got.columns == ["k", "i", "lo", "hi", "total", "units", "n"]
    want = []
    for k, i, lo, hi in anchors:
        inside = [b for b in bills if k and b[0] == k and b[1] and lo and hi and lo <= b[1] <= hi]
        want.append((i, sum((b[2] or 0 for b in inside), Decimal(0)), sum(b[3] for b in inside), len(inside)))
    assert sorted((r.i, r.total, int(r.units), r.n) for r in got.collect()) == sorted(want)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_window_sums_never_pair_anchors_with_bills(spark):
    """No step of a hot key's sums has more rows than its anchors and days."""
    day = F.expr("date_add(DATE'2020-01-01', CAST(id % 200 AS INT))")
    bills = spark.range(20_000).select(F.lit("hot").alias("k"), day.alias("d"), F.lit(1).alias("v"))
    anchors = spark.range(5_000).select(F.lit("hot").alias("k"), F.date_sub(day, 90).alias("lo"), day.alias("hi"))
    got = window_sums(anchors, bills, ["k"], "d", "lo", "hi", {"s": "v"}).select(F.sum("s"), F.count("*"))
    ((total, n),) = got.collect()
    assert n == 5_000 and total == sum(min(i % 200 + 1, 91) * 100 for i in range(5_000))
    made = []

    def walk(node):
        if node.nodeName().endswith(("Join", "Window", "HashAggregate")):
            made.append(node.metrics().get("numOutputRows").get().value() if "Window" not in node.nodeName() else 0)
        below = [node.plan()] if node.getClass().getSimpleName().endswith("QueryStageExec") else []
        below += [node.children().apply(k) for k in range(node.children().size())]
        for one in below:
            walk(one)

    walk(got._jdf.queryExecution().executedPlan().executedPlan())
    assert len(made) > 5 and 0 < max(made) <= 5_000 + 200 * 8


def test_months_counted_whole_to_as_of_have_no_sums_of_their_own(spark, bills):
    got = period_measures(
        frame(spark, bills), ["k"], "d", {"": "v"}, AS_OF, ["L1MTD", "L2MTD", "L2MMTD"], end_rule="as_of"
    )
    # Whole months and those cut at `as_of`, each as two bigints that are named twice.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    sums = next(x for x in plan.splitlines() if "Aggregate" in x)
    assert sums.count("sum(") == 8


def test_window_join_reads_bills_once(spark, tmp_path):
    day = dt.date(2024, 5, 1)
    orders = [(k, 1, day + dt.timedelta(30 * k), "2-HIGH") for k in range(3)]
    money = [F.lit(v).cast("decimal(15,2)").alias(c) for c, v in (
        ("l_extendedprice", 100), ("l_discount", 0), ("l_tax", 0), ("l_quantity", 1))]
    tables = {
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string"),
        "lineitem": spark.range(3).select(
            F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(7).cast("long").alias("l_partkey"),
            F.lit("A").alias("l_returnflag"), *money),
        "part": spark.sql("SELECT 7L p_partkey, 'b' p_brand, 't' p_type, 1 p_size"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = REGISTRY["window_join"](spark, str(tmp_path))
    assert got.inputFiles() and all("/daily-" in f for f in got.inputFiles())
    assert sorted((r.last, r.amount, r.days) for r in got.collect()) == [
        ("2024-05-01", 100.0, 1), ("2024-05-31", 200.0, 2), ("2024-06-30", 200.0, 2)]
