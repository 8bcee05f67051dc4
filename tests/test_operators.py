import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyfold.fixed_values import STATE_COLUMNS, STATES
from tallyfold.operators import budget as B
from tallyfold.operators import facts, groups, joins, pareto, recency, running

AS_OF = dt.date(2024, 6, 10)


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_unique_by_is_deterministic(spark):
    data = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "w"), (None, 1, "v")]
    for shuffled in (data, data[::-1]):
        df = spark.createDataFrame(shuffled, "k string, n int, t string").repartition(4)
        assert rows(joins.unique_by(df, ["k"]), "k", "n", "t") == rows(
            spark.createDataFrame([("a", 1, "y"), ("b", None, "w"), (None, 1, "v")], df.schema),
            "k", "n", "t",
        )
        latest = joins.unique_by(df, ["k"], [F.col("n").desc()]).filter("k = 'a'").first()
        assert (latest.n, latest.t) == (2, "x")


def test_unique_by_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = joins.unique_by(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_lookups_keep_every_left_row(spark):
    left = spark.createDataFrame([("1", 1), ("37", 2), ("none", 3), (None, 4)], "state_code string, n int")
    named = joins.inline_lookup(left, STATES, STATE_COLUMNS)
    assert rows(named, "n", "state_name") == [
        (1, "ANDHRA PRADESH"), (2, "Not defined in SAP"), (3, None), (4, None)]
    many = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "c")], "state_code string, x string")
    assert rows(joins.lookup_one(left, many, ["state_code"]), "n", "x") == [
        (1, "a"), (2, None), (3, None), (4, None)]


def test_left_join_on_null_safe(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, n int")
    right = spark.createDataFrame([(None, "x"), ("a", "y")], "r string, v string")
    plain = joins.left_join_on(left, right, {"k": "r"}, ["v"])
    safe = joins.left_join_on(left, right, {"k": "r"}, ["v"], null_safe=True)
    assert rows(plain, "n", "v") == [(1, None), (2, "y")]
    assert rows(safe, "n", "v") == [(1, "x"), (2, "y")]


def test_headers_with_items(spark):
    header = spark.createDataFrame([(1, "CP"), (2, "CP"), (3, "ZZ"), (4, "SS")], "doc int, g string")
    items = spark.createDataFrame([(1, 10), (1, 11), (3, 12), (9, 13)], "doc int, v int")
    fact = facts.billing_fact(header, items, "doc", group="g", group_codes=["CP", "SS"])
    assert rows(fact, "doc", "v") == [(1, 10), (1, 11), (2, None), (4, None)]


def test_group_totals_match_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "k string, v int")
    full = groups.with_group_totals(df, ["k"], {"total": F.sum("v")})
    assert rows(full, "v", "total") == [(1, 3), (2, 3), (5, 5)]


def test_contribution_adds_up(spark):
    df = spark.createDataFrame([("a", Decimal(1)), ("b", Decimal(3))], "k string, v decimal(18,2)")
    got = {r.k: r.contribution for r in groups.contribution(df, ["k"], "v").collect()}
    assert got == {"a": 25.0, "b": 75.0}


def test_distinct_and_count(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    assert groups.row_count(groups.distinct_rows(df)) == 2
    assert groups.row_count(groups.distinct_keys(df, "a")) == 1


def skewed(spark):
    rng = random.Random(3)
    data = [("hot" if i % 3 else f"k{i % 17}", rng.randrange(40), i, Decimal(rng.randrange(-500, 900)) / 100)
            for i in range(2000)]
    return data, spark.createDataFrame(data, "k string, o int, id int, v decimal(18,2)").repartition(7)


@pytest.mark.parametrize("slices", [1, 5, 23])
def test_running_sum_with_a_hot_group(spark, slices):
    data, df = skewed(spark)
    got = running.running_sum(df, ["k"], [F.col("o").desc(), F.col("id")], "v", "s", slices=slices)
    want, sums = {}, {}
    for k, o, i, v in sorted(data, key=lambda r: (r[0], -r[1], r[2])):
        sums[k] = sums.get(k, Decimal(0)) + v
        want[i] = sums[k]
    assert {r.id: r.s for r in got.collect()} == want
    assert got.columns == ["k", "o", "id", "v", "s"]


AWKWARD = [
    (k, o, t, i, None if i % 11 == 0 else Decimal(i * 7 % 23 - 9))
    for i, (k, o, t) in enumerate(
        [("hot", i % 9 if i % 4 else None, "xyz"[i % 3] if i % 5 else None) for i in range(600)]
        + [(None, 1, "a")] * 40 + [(f"k{i}", i % 3, None) for i in range(60)] + [("nulls", 3, "b")] * 3
    )
]


def sort_place(o, t, i, falling, nulls_first):
    null = (o is None) != nulls_first
    return null, 0 if o is None else -o if falling else o, t is not None, t or "", i


@pytest.mark.parametrize("falling, nulls_first", [(False, True), (True, False), (True, True), (False, False)])
def test_running_sum_with_nulls_and_directions(spark, falling, nulls_first):
    df = spark.createDataFrame(AWKWARD, "k string, o int, t string, id int, v decimal(10,0)").repartition(5)
    o = F.col("o")
    if falling:
        o = o.desc_nulls_first() if nulls_first else o.desc()
    else:
        o = o if nulls_first else o.asc_nulls_last()
    want, sums = {}, {}
    for k, a, t, i, v in sorted(AWKWARD, key=lambda r: sort_place(*r[1:4], falling, nulls_first)):
        if v is not None:
            sums[k] = sums.get(k, 0) + v
        want[i] = sums.get(k)
    for slices in (1, 3, 40, 500):
        got, total = running.running_sum_and_total(df, ["k"], [o, "t", "id"], "v", "s", slices=slices)
        assert {r.id: r.s for r in got.collect()} == want
        assert total == sum(r[4] for r in AWKWARD if r[4] is not None)


@pytest.mark.parametrize("slices", [2, 30])
def test_cumulative_sum_with_ties_over_several_groups(spark, slices):
    df = spark.createDataFrame(AWKWARD, "k string, o int, t string, id int, v decimal(10,0)").repartition(3)
    want = set()
    for k in {r[0] for r in AWKWARD}:
        own = [r for r in AWKWARD if r[0] == k]
        known = [r[4] for r in own if r[4] is not None]
        for r in own:
            upto = [x[4] for x in own if x[4] is not None and (x[1] is not None or r[1] is None)
                    and (r[1] is None or x[1] >= r[1])]
            want.add((r[3], sum(upto) if upto else None, sum(known) if known else None))
    got = running.cumulative_sum(df, ["k"], "o", "v", "c", total="t_all", slices=slices)
    assert {(r.id, r.c, r.t_all) for r in got.collect()} == want


def test_running_sum_of_doubles_and_of_nothing(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(40)], "k string, id int, v double")
    got = running.running_sum(df, ["k"], ["id"], "v", "s", slices=6)
    assert {r.id: r.s for r in got.collect()} == {i: i * (i + 1) / 2 for i in range(40)}
    none, total = running.running_sum_and_total(df.limit(0), ["k"], ["id"], "v", "s")
    assert none.collect() == [] and total is None
    with pytest.raises(ValueError):
        running.running_sum(df, ["k"], [F.col("id") + 1], "v", "s")


def test_running_sum_over_everything(spark):
    df = spark.range(50).selectExpr("id", "cast(id AS decimal(18,2)) AS v")
    got = running.running_sum(df, [], [F.col("id")], "v", "s", slices=4)
    assert {r.id: int(r.s) for r in got.collect()} == {i: i * (i + 1) // 2 for i in range(50)}


@pytest.mark.parametrize("slices", [None, 1, 2, 7])
def test_cumulative_sum_treats_ties_as_peers(spark, slices):
    df = spark.createDataFrame(
        [("y", Decimal(v)) for v in (50, 30, 30, -10)] + [(None, Decimal(5))], "p string, v decimal(18,2)"
    )
    got = running.cumulative_sum(df, ["p"], "v", "v", "c", total="t", slices=slices)
    assert rows(got, "v", "t") == rows(running.partition_total(df, ["p"], "v", "t"), "v", "t")
    assert sorted(tuple(map(int, r)) for r in got.select("v", "c", "t").collect()) == [
        (-10, 100, 100), (5, 5, 5), (30, 110, 100), (30, 110, 100), (50, 50, 100)]


def test_pareto(spark):
    data = [(2024, "big", 90), (2024, "small", 10), (2023, "a", 40), (2023, "b", 40), (2023, "c", 20)]
    df = spark.createDataFrame([(y, b, Decimal(v)) for y, b, v in data], "y int, b string, v decimal(18,2)")
    got = pareto.pareto(df, "b", "v", "y")
    assert rows(got, "y", "b", "pareto") == [
        (2023, "a", "80"), (2023, "b", "80"), (2023, "c", "20"), (2024, "big", "20"), (2024, "small", "20")]


def test_pareto_lines(spark):
    df = spark.createDataFrame([("a", 1, Decimal(70)), ("a", 2, Decimal(20)), ("b", 3, Decimal(10))],
                               "b string, id int, v decimal(18,2)")
    got = pareto.pareto_lines(df, "b", "v", [F.col("id")])
    assert rows(got, "id", "pareto") == [
        (1, "20%_products"), (2, "80%_products"), (3, "20%_products")]


def test_period_join_against_brute_force(spark):
    rng = random.Random(5)
    start = dt.date(2023, 1, 1)
    bills = [(rng.choice("ab"), start + dt.timedelta(days=rng.randrange(500)), i) for i in range(200)]
    anchors = []
    for i in range(30):
        first = start + dt.timedelta(days=rng.randrange(400))
        anchors.append((rng.choice("abc"), i, first, first + dt.timedelta(days=rng.randrange(-3, 120))))
    got = joins.period_join(
        spark.createDataFrame(anchors, "k string, n int, lo date, hi date"),
        spark.createDataFrame(bills, "k string, d date, i int"),
        ["k"], "d", "lo", "hi",
    )
    want = sorted((n, i) for k, n, lo, hi in anchors for b, d, i in bills if b == k and lo <= d <= hi)
    assert sorted((r.n, r.i) for r in got.collect()) == want


BILLS = [("all", dt.date(2024, m, 5), g) for m, g in ((4, "DL"), (5, "MT"), (6, "EX"))] + [
    ("some", dt.date(2024, 5, 30), "DL"), ("some", dt.date(2024, 5, 30), "MT"),
    ("old", dt.date(2023, 1, 1), "DL")]


def test_recency(spark):
    df = spark.createDataFrame(BILLS, "c string, d date, g string")
    got = {r.c: r for r in recency.recency(df, "c", "d", AS_OF, ["g"]).collect()}
    assert got["all"].unbilled_days == 5 and got["all"].g == "EX"
    assert got["all"].unbilled_ageing_bucket == "0-30_days"
    assert got["some"].g == "MT" and got["some"].billed_months == [dt.date(2024, 5, 1)]
    assert got["old"].unbilled_ageing_bucket == "More than 120 days"
    assert got["old"].system_date == AS_OF


def test_unbilled_months(spark):
    bills = spark.createDataFrame(BILLS, "c string, d date, g string").withColumn("m", F.trunc("d", "month"))
    billed = groups.collect_months(bills, ["c"], "m", "billed")
    everyone = spark.createDataFrame([("all",), ("some",), ("old",), ("never",)], "c string")
    df = joins.left_lookup(everyone, billed, "c")
    none = {r.c: r.unbilled_months for r in recency.unbilled_months(df, "billed", AS_OF).collect()}
    year = "Apr-24,May-24,Jun-24"
    assert none == {"all": "", "some": "Apr-24,Jun-24", "old": year, "never": year}
    full = recency.unbilled_months(df, "billed", AS_OF, fully_billed="all")
    assert {r.c: r.unbilled_months for r in full.collect()} == none | {"all": year}
    with pytest.raises(ValueError):
        recency.unbilled_months(df, "billed", AS_OF, fully_billed="x")


def test_months_over_many_years(spark):
    rng = random.Random(9)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, dt.date(rng.randrange(1890, 2110), rng.randrange(1, 13), 7)]))
            for _ in range(500)] + [("none", None)]
    df = spark.createDataFrame(data, "k string, d date").repartition(3)
    want = {k: sorted({d.replace(day=1) for x, d in data if x == k and d}) for k, _ in data}
    got = {r.k: r.m for r in groups.collect_months(df, ["k"], "d", "m").collect()}
    assert got == want
    recent = {r.k: r.billed_months for r in recency.recency(df, "k", "d", AS_OF).collect()}
    assert recent == want


@pytest.mark.parametrize("as_of", [dt.date(2024, 4, 1), AS_OF, dt.date(2025, 3, 31)])
def test_unbilled_months_from_bits(spark, as_of):
    """Bits give what arrays give."""
    everyone = spark.createDataFrame([("all",), ("some",), ("old",), ("never",), ("late",)], "c string")
    more = BILLS + [("late", dt.date(2025, 2, 3), "DL"), ("late", None, "DL"), ("late", dt.date(2025, 4, 3), "DL")]
    bills = spark.createDataFrame(more, "c string, d date, g string").withColumn("m", F.trunc("d", "month"))
    by_array = joins.left_lookup(everyone, groups.collect_months(bills, ["c"], "m", "billed"), "c")
    by_bits = joins.left_lookup(everyone, recency.fiscal_bits(bills, ["c"], "d", as_of, "billed"), "c")
    assert dict(by_bits.dtypes)["billed"] == "bigint"
    for rule in ("none", "all"):
        a, b = (rows(recency.unbilled_months(x, "billed", as_of, fully_billed=rule), "c", "unbilled_months")
                for x in (by_array, by_bits))
        assert a == b


@pytest.mark.parametrize("months,last", [(12, dt.date(2025, 3, 1)), (13, dt.date(2025, 4, 1))])
def test_budget_calendar(spark, months, last):
    got = B.budget_calendar(spark.createDataFrame([("a",)], "x string"), AS_OF, months).collect()
    assert len(got) == months
    assert {r.End for r in got} == {last} == {max(r.Month for r in got)}
    assert {(r.Start, r.Fiscal_Year) for r in got} == {(dt.date(2024, 4, 1), 2024)}


def test_budget_achievement(spark):
    lakh = Decimal(100_000)
    bills = spark.createDataFrame(
        [("c", "S", dt.date(2024, 6, 7), lakh), ("c", "S", dt.date(2024, 6, 8), lakh),
         ("c", None, dt.date(2024, 4, 30), lakh)],
        "customer_code string, business_segment string, d date, v decimal(18,2)",
    )
    sales = B.cut_day_sums(bills, ["customer_code", "business_segment"], "d", "v")
    budget = spark.createDataFrame([("c", "S", "10"), ("c", "S", "10"), ("c", None, "0")],
                                   "customer_code string, segment string, `Monthly Budget` string")
    calendar = B.budget_calendar(B.budget_rows(budget, "segment"), AS_OF)
    got = {(r.segment, r.Month.month): r for r in B.budget_achievement(calendar, sales, AS_OF).collect()}
    assert len(got) == 24
    june = got["S", 6]
    assert june.achievement_percentage_of_sales_till_1_7th_of_month == 0.1
    assert june.achievement_percentage_of_sales_till_1_EOM_of_month == 0.2
    assert (june.current_day, june.remaining_days, june.btd) == (10, 20, 8.0)
    assert june.btd_per_day == 0.4 and june.budget_per_day == pytest.approx(10 / 30)
    april = got["None", 4]
    assert april.btd == -1.0 and april.remaining_days == 1
    assert april.achievement_percentage_of_sales_till_1_EOM_of_month is None
    assert got["S", 5].btd is None


def test_cut_day_sums_rise(spark):
    df = spark.createDataFrame([("c", dt.date(2024, 5, d), Decimal(d)) for d in range(1, 32)],
                               "c string, d date, v decimal(18,2)")
    row = B.cut_day_sums(df, ["c"], "d", "v").first()
    sums = [row[f"achievement_of_sales_till_{c}_of_month"] for c in B.CUTS]
    assert sums == sorted(sums) and sums[-1] == sum(range(1, 32))


def test_least_by_gives_the_rows_of_unique_by(spark):
    data = [("a", 2, "x", 1), ("a", 1, "z", 1), ("a", 1, None, 2), ("b", None, "w", 3), (None, 1, "v", 4), (None, 0, "v", 4)]
    df = spark.createDataFrame(data, "`k.1` string, n int, t string, u int").repartition(3)
    assert sorted(map(tuple, joins.least_by(df, df.columns).collect()), key=str) == sorted(data, key=str)
    for keys in (["k.1"], ["t", "u"]):
        got, want = joins.least_by(df, keys), joins.unique_by(df, keys)
        assert got.columns == df.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    narrow = joins.least_by(df, ["u"]).select("u")
    assert "min(" not in narrow._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_in_place_is_a_left_join_without_an_exchange(spark):
    left = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, None), ("b", 1, "z"), (None, 1, "n"), ("a", None, "m")]
    dim = [(1, "a", 5, None), (1, "c", 6, "u"), (1, None, 7, "v"), (1, "b", None, "w"), (None, "a", 8, "q")]
    df = spark.createDataFrame(left, "k string, n int, `t.t` string").repartition(5, "k")
    found = spark.createDataFrame(dim, "n int, k string, v int, `u/u` string").repartition(5, "k")
    got, want = joins.lookup_in_place(df, found, ["k", "n"]), joins.left_lookup(df, found, ["k", "n"])
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # The two that lay the sides out, no more.
    assert plan.count("Exchange") == 2 and "ENSURE_REQUIREMENTS" not in plan
