"""

The same results from the same inputs as the registered queries, written with
range self-joins and windows over lines. Prints one JSON line of seconds: plain
form, this library's form.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.fixed_values import REPORTED_GROUPS
from tallyfold.operators.budget import CUTS
from tallyfold.operators.periods import period_measures
from tallyfold.session import set_options
from workload.inputs import AS_OF, bills, extracts, headers, lines, state_bills, table
from workload.queries import DENSE, MEASURES, REGISTRY, SERIES

PERIODS = ("MTD", "LYMTD", "L1MTD", "L2MTD", "LM", "LMMTD", "L2M", "YTD", "LYTD")


def windows_of(m) -> dict:
    today = F.lit(AS_OF)
    current = m == F.lit(AS_OF.replace(day=1))
    end = F.least(today, F.last_day(m))
    fy = F.make_date(F.year(m) - (F.month(m) < 4).cast("int"), F.lit(4), F.lit(1))
    fy_end = F.when(current, today).otherwise(F.last_day(m))
    before = F.add_months(m, -1)

    def to_date(n):
        return F.when(current, F.add_months(today, -n)).otherwise(
            F.last_day(F.add_months(end, -n))
        )

    return {
        "MTD": (m, end),
        "LYMTD": (F.add_months(m, -12), F.add_months(end, -12)),
        "L1MTD": (before, to_date(1)),
        "L2MTD": (F.add_months(m, -2), to_date(2)),
        "LM": (before, F.last_day(before)),
        "LMMTD": (before, F.add_months(end, -1)),
        "L2M": (F.add_months(m, -2), F.last_day(before)),
        "YTD": (fy, fy_end),
        "LYTD": (F.add_months(fy, -12), F.add_months(fy_end, -12)),
    }


def plain_periods(source: DataFrame, names=PERIODS, keys=SERIES) -> DataFrame:
    """One range self-join, aggregate and join back per period."""
    month = F.trunc("billing_date", "month")
    anchors = source.select(*keys, month.alias("m")).distinct()
    result = anchors
    for name in names:
        lo, hi = windows_of(F.col("m"))[name]
        a = anchors.withColumns({"lo": lo, "hi": hi}).alias("a")
        b = source.select(*keys, "billing_date", *MEASURES.values()).alias("b")
        match = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
        match += [F.col("billing_date").between(F.col("lo"), F.col("hi"))]
        sums = [F.round(F.sum(f"b.{c}"), 2).alias(name + s) for s, c in MEASURES.items()]
        totals = a.join(b, match).groupBy(*[F.col(f"a.{k}") for k in keys], "m").agg(*sums)
        result = result.join(totals, [*keys, "m"], "left").fillna(
            0, [name + s for s in MEASURES]
        )
    return result


def plain_pareto_lines(source: DataFrame) -> DataFrame:
    frame = Window.partitionBy("product_brand").orderBy(
        F.col("billing_amount").desc(), "billing_document", "billing_item", "material_code"
    ).rowsBetween(Window.unboundedPreceding, 0)
    grand = source.agg(F.sum("billing_amount")).first()[0]
    share = F.sum("billing_amount").over(frame).cast("double") / float(grand) * 100
    return source.withColumn(
        "pareto", F.when(share <= 80, "20%_products").otherwise("80%_products")
    )


def plain_growth(source: DataFrame) -> DataFrame:
    full = plain_periods(source, keys=DENSE)
    pairs = [("MTD", "LYMTD"), ("MTD", "LMMTD"), ("YTD", "LYTD")]
    return full.select(
        *DENSE, "m", *[((F.col(a + s) - F.col(b + s)) / F.nullif(F.col(b + s), F.lit(0))).alias(f"{a}_{b}{s}")
                       for a, b in pairs for s in MEASURES]
    )


def plain_running(source: DataFrame) -> DataFrame:
    order = ["billing_date", "billing_document", "billing_item", "material_code", "billing_amount"]
    frame = Window.partitionBy("business_segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return source.select("business_segment", *order, F.sum("billing_amount").over(frame).alias("running"))


def plain_pareto(source: DataFrame) -> DataFrame:
    year = F.year("billing_date") - (F.month("billing_date") < 4).cast("int")
    totals = source.groupBy(year.alias("y"), "product_brand").agg(F.sum("billing_amount").alias("t"))
    upto = F.sum("t").over(Window.partitionBy("y").orderBy(F.desc("t")))
    share = upto.cast("double") / F.sum("t").over(Window.partitionBy("y")).cast("double")
    return totals.withColumn("pareto", F.when(share <= 0.8, "80").otherwise("20"))


def plain_contribution(source: DataFrame) -> DataFrame:
    totals = source.groupBy("product_brand").agg(F.sum("billing_amount").alias("t"))
    return totals.withColumn("share", F.col("t").cast("double") / F.sum("t").over(Window.partitionBy()).cast("double"))


def plain_totals(orders: DataFrame) -> DataFrame:
    own = Window.partitionBy("o_custkey")
    price, month = F.col("o_totalprice").cast("decimal(18,2)"), F.trunc("o_orderdate", "month")
    return orders.select(
        "o_orderkey", "o_custkey", price.alias("price"), "o_orderstatus",
        F.sum(price).over(own).alias("total"), F.max(price).over(own).alias("largest"), F.avg(price).over(own).alias("average"),
        F.sum((F.col("o_orderstatus") == "O").cast("int")).over(own).alias("open"),
        F.array_sort(F.collect_set(month).over(own)).alias("months"),
    )


def plain_buckets(lineitem: DataFrame) -> DataFrame:
    def chain(x):
        out = F.when(x == 5, "5").when(x == 10, "10")
        for low in range(11, 200, 10):
            out = out.when(x.between(low, low + 9), f"{low}-{low + 9}")
        return out.when(x > 200, ">200").otherwise("NA")

    q = F.col("l_quantity")
    forms = [chain(F.floor(q)), chain(F.floor(q * 10)), chain(F.floor(q / 2)), chain(q / 2)]
    return lineitem.select(*[f.alias(f"b{k}") for k, f in enumerate(forms)]).groupBy("b0", "b1", "b2", "b3").count()


def plain_recency(bills_: DataFrame) -> DataFrame:
    own = Window.partitionBy("customer_code")
    last = F.max("billing_date").over(own)
    month = F.collect_set(F.trunc("billing_date", "month")).over(own)
    return bills_.withColumns({"last": last, "months": F.array_sort(month)}).where("billing_date = last").select(
        "customer_code", "last", F.datediff(F.lit(AS_OF), "last").alias("days"), "months", "customer_group"
    ).dropDuplicates(["customer_code"])


def plain_cuts(source: DataFrame) -> DataFrame:
    """One filter, aggregate and join back per cut day."""
    keys = ["customer_code", "business_segment", "m"]
    monthly = source.withColumn("m", F.trunc("billing_date", "month"))
    result = monthly.select(*keys).distinct()
    for cut, last in CUTS.items():
        part = monthly.where(F.dayofmonth("billing_date") <= last).groupBy(*keys).agg(F.round(F.sum("billing_amount"), 2).alias(cut))
        result = result.join(part, keys, "left")
    return result


def plain_achievement(customer: DataFrame, source: DataFrame) -> DataFrame:
    months = F.sequence(F.lit(dt.date(2001, 4, 1)), F.lit(dt.date(2002, 3, 1)), F.expr("interval 1 month"))
    budget = customer.select(
        "customer_code", F.explode(F.array(F.lit("PROMO"), F.lit("SMALL"))).alias("business_segment"),
        F.abs(F.floor(F.col("c_acctbal") / 1000)).alias("budget"),
    ).withColumn("m", F.explode(months))
    joined = budget.join(plain_cuts(source), ["customer_code", "business_segment", "m"], "left")
    return joined.withColumns({f"share_{c}": F.col(c) / 100000 / F.nullif(F.col("budget"), F.lit(0)) for c in CUTS})


def plain_material(given: dict[str, DataFrame]) -> DataFrame:
    segments = given["MARC"].join(given["CEPC"], "PRCTR").dropDuplicates(["MATNR"])
    named = given["MARA"].dropDuplicates(["MATNR"]).join(segments.select("MATNR", "SEGMENT"), "MATNR", "left")
    return named.withColumns({c: F.initcap(c) for c in ("ZZPBD", "ZZBFLV", "SEGMENT")})


def plain_lines(given: dict[str, DataFrame]) -> DataFrame:
    """Typed lines with plain casts, headers joined to items, signs applied."""
    money = lambda c: F.coalesce(F.col(c).try_cast("decimal(18,2)"), F.lit(0))
    joined = given["VBRK"].join(given["VBRP"], "VBELN", "left")
    amount = money("NETWR") + money("MWSBP")
    credit = F.col("FKART").isin("ZREM", "RE", "ZMRE", "ZDR1") & (amount > 0)
    return joined.select(
        F.col("KDGRP").alias("customer_group"), F.col("KUNAG").alias("customer_code"), F.col("MATNR").alias("material_code"),
        F.to_date("FKDAT", "yyyyMMdd").alias("billing_date"), F.when(credit, -amount).otherwise(amount).alias("billing_amount"),
        money("NTGEW").alias("qty_in_kg"), money("FKLMG").alias("billed_quantity"), F.col("FKART").alias("billing_type"),
    )


def plain_customers(given: dict[str, DataFrame]) -> DataFrame:
    lines_, own = plain_lines(given), Window.partitionBy("customer_code")
    last = lines_.withColumns(
        {"last": F.max("billing_date").over(own), "months": F.collect_set(F.trunc("billing_date", "month")).over(own)}
    ).where("billing_date = last").dropDuplicates(["customer_code"])
    named = given["KNA1"].dropDuplicates(["KUNNR"]).join(given["ZCUST_ADD_DETAIL"].dropDuplicates(["KUNNR"]), "KUNNR", "left")
    return named.join(last, named.KUNNR == last.customer_code, "left")


def plain_budget(given: dict[str, DataFrame]) -> DataFrame:
    months = F.sequence(F.lit(dt.date(2001, 4, 1)), F.lit(dt.date(2002, 3, 1)), F.expr("interval 1 month"))
    sales = plain_lines(given).join(plain_material(given).select(F.col("MATNR").alias("material_code"), F.col("SEGMENT").alias("business_segment")), "material_code", "left")
    budget = given["customer_budget"].withColumn("m", F.explode(months)).withColumnRenamed("segment", "business_segment")
    return budget.join(plain_cuts(sales), ["customer_code", "business_segment", "m"], "left")


def plain_register(given: dict[str, DataFrame]) -> DataFrame:
    """Period joins over lines, then the masters joined to every row."""
    lines_ = plain_lines(given).where("customer_code IS NOT NULL AND material_code IS NOT NULL")
    keys = ["customer_code", "material_code"]
    measured = plain_periods(lines_, keys=keys)
    named = measured.join(plain_material(given).withColumnRenamed("MATNR", "material_code"), "material_code", "left")
    return named.join(given["KNA1"].withColumnRenamed("KUNNR", "customer_code"), "customer_code", "left")


def plain_returns(source: DataFrame) -> DataFrame:
    frame = Window.partitionBy(*SERIES)
    is_return = F.col("billing_type") == "R"
    return source.select(
        *SERIES,
        F.sum(F.when(is_return, F.col("billing_amount")).otherwise(0)).over(frame).alias("v"),
        F.sum(is_return.cast("int")).over(frame).alias("n"),
        F.avg("billing_amount").over(frame).alias("a"),
    ).distinct()


def plain_unbilled(customer: DataFrame, billed: DataFrame) -> DataFrame:
    months = F.sequence(
        F.lit(AS_OF.replace(month=4, day=1)), F.lit(AS_OF.replace(day=1)), F.expr("interval 1 month")
    )
    frame = Window.partitionBy("customer_code")
    month = F.trunc("billing_date", "month")
    sets = billed.select("customer_code", F.collect_set(month).over(frame).alias("b")).distinct()
    each = customer.withColumn("m", F.explode(months))
    every = each.select("customer_code", F.collect_set("m").over(frame).alias("e")).distinct()
    left = F.array_sort(F.array_except("e", "b"))
    return every.join(sets, "customer_code", "left").select("customer_code", left.alias("x"))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    set_options(spark)

    def seconds(build) -> float:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        return round(runs[-1], 2)

    def ours(name):
        return lambda: REGISTRY[name](spark, sf)

    def source():
        return bills(spark, sf)

    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_code"))
    past = headers(spark, sf).filter(F.col("billing_date") <= F.lit(AS_OF))
    orders, given = table(spark, sf, "orders"), extracts(spark, sf)
    wide = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_code"), "c_acctbal")
    dense = lambda: state_bills(spark, sf)
    headline = {
        "growth_ratios": lambda: plain_growth(dense()),
        "all_periods_dense": lambda: plain_periods(dense(), keys=DENSE),
        "mtd": lambda: plain_periods(source(), ["MTD"]),
        "lymtd_shifted": lambda: plain_periods(source(), ["LYMTD"]),
        "l2mmtd": lambda: plain_periods(source(), ["L1MTD", "L2MTD"]),
        "ytd_running": lambda: plain_periods(source(), ["YTD"]),
        "lytd_fy": lambda: plain_periods(source(), ["LYTD"]),
        "mtd_per_day": lambda: plain_periods(dense(), ["MTD"], DENSE),
        "billing_fact": lambda: headers(spark, sf).where(F.col("customer_group").isin(REPORTED_GROUPS)).join(lines(spark, sf), "billing_document", "left"),
        "returns_profile": lambda: plain_returns(source()),
        "group_totals": lambda: plain_totals(orders),
        "price_bucket": lambda: plain_buckets(table(spark, sf, "lineitem")),
        "brand_contribution": lambda: plain_contribution(source()),
        "pareto_brand_fy": lambda: plain_pareto(source()),
        "pareto_line": lambda: plain_pareto_lines(source()),
        "running_sum_rows": lambda: plain_running(source()),
        "customer_recency": lambda: plain_recency(headers(spark, sf)),
        "unbilled_months": lambda: plain_unbilled(customer, past),
        "cut_day_sales": lambda: plain_cuts(source()),
        "budget_achievement": lambda: plain_achievement(wide, source()),
        "material_master": lambda: plain_material(given),
        "customer_master": lambda: plain_customers(given),
        "customer_budget_report": lambda: plain_budget(given),
        "sales_register": lambda: plain_register(given),
    }
    pairs = {name: (plain, ours(name)) for name, plain in headline.items()} | {
        "all periods": (
            lambda: plain_periods(source()),
            lambda: period_measures(source(), SERIES, "billing_date", MEASURES, AS_OF, PERIODS),
        ),
    }
    found = {}
    for name, (plain, own) in pairs.items():
        found[name] = [seconds(plain), seconds(own)]
        print(name, *found[name], file=sys.stderr, flush=True)
    print(json.dumps(found))
    spark.stop()


if __name__ == "__main__":
    main()
