"""Every registered query: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.fixed_values import CREDIT_TYPES, REPORTED_GROUPS, STATE_COLUMNS, STATES
from tallyfold.functions import classify as C
from tallyfold.functions import clean, dates
from tallyfold.operators import budget as B
from tallyfold.operators import facts, groups, joins, pareto, periods, recency, running
from tallyfold.plans import billing, masters, register, reports
from tallyfold.session import scratch_path, stage
from tallyfold.sources.curated import ingest, read_bucketed, read_table, write_bucketed, write_table
from tallyfold.sources.versions import publish, read_version
from workload.inputs import (
    AS_OF,
    FLOOR,
    bills,
    decimal,
    dirty_extracts,
    extracts,
    headers,
    lines,
    materials,
    places,
    state_bills,
    table,
    text,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SERIES = ["customer_code", "product_brand"]
DENSE = ["state", "product_brand"]
MEASURES = {"": "billing_amount", "_MT": "qty_in_kg", "_CB": "billed_quantity"}


def shown(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as double, dates as text, integers as bigint."""

    def plain(f: T.StructField):
        c = clean.quoted(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        return c.alias(f.name)

    return df.select([plain(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = lambda spark, sf: shown(fn(spark, sf))
    return fn


# Cleaning and projection


@query
def clean_keys(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.concat(F.lit("  "), F.lpad(text("c_custkey"), 10, "0"), F.lit(" ")).alias("customer_code"),
        F.concat(F.col("c_name"), F.lit("  ")).alias("customer_name"),
        text(decimal("c_acctbal")).alias("balance"),
    )
    return clean.strip_zeros(clean.trim_all(raw), "all")


@query
def clean_key_only(spark, sf):
    raw = table(spark, sf, "part").select(
        F.lpad(text("p_partkey"), 18, "0").alias("material_code"),
        F.lpad(text("p_size"), 4, "0").alias("pack_size"),
    )
    return clean.strip_zeros(raw, ["material_code"])


@query
def proper_case_names(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return clean.proper_case(part, ["p_name", "p_type"])


@query
def clean_decimals(spark, sf):
    sign = F.when(F.col("c_acctbal") < 0, "-").otherwise("")
    raw = F.concat(F.format_number(F.abs(decimal("c_acctbal")), 2), sign)
    return table(spark, sf, "customer").select(
        "c_custkey",
        clean.clean_decimal(raw).alias("signed"),
        clean.clean_decimal(raw, keep_sign=False).alias("unsigned"),
    )


@query
def clean_decimals_wide(spark, sf):
    """Amounts beyond eighteen digits, read and summed; kept as text, for doubles are too coarse."""
    raw = F.concat(text("c_custkey"), F.lit("0000000000000"), text(F.abs(decimal("c_acctbal"))))
    wide = table(spark, sf, "customer").select(
        "c_nationkey", clean.clean_decimal(raw, target=clean.AMOUNT).alias("amount")
    )
    return wide.groupBy("c_nationkey").agg(text(clean.exact_sum(wide, "amount")).alias("total"))


LINE_KEY = [
    "billing_document", "billing_item", "plant", "material_code", "item_category",
    "material_description", "quantity", "net_value", "tax_amount",
]


@query
def deduped_lines(spark, sf):
    """Billing lines of which some were delivered twice, each counted once."""
    given = extracts(spark, sf)
    twice = given["VBRP"].unionByName(given["VBRP"].where("POSNR <> '2'"))
    lines = billing.billing_lines(given["VBRK"], twice, line_key=LINE_KEY)
    return lines.groupBy("customer_group").agg(
        F.count("billing_item").alias("n"), clean.exact_sum(lines, "billing_amount").alias("amount")
    )


@query
def normalised_keys(spark, sf):
    return places(spark, sf).select(
        clean.composite_key("c_custkey", "c_mktsegment").alias("exception_key"),
        clean.match_key("r_name", "c_mktsegment").alias("key"),
    )


@query
def projected_columns(spark, sf):
    names = {"s_suppkey": "plant", "s_name": "plant_name", "s_nationkey": "mrp/cb"}
    slim = clean.project(table(spark, sf, "supplier"), names)
    renamed = clean.rename(slim, {"plant_name": "name", "not_there": "ignored"})
    filled = clean.with_literals(clean.sanitise_names(renamed), {"distributor": "", "extra": "x"})
    return clean.drop_columns(clean.move_column(filled, "name", "town_villa"), "extra")


@query
def null_fill(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 10, text("p_size")).alias("mrp"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("segment"),
    )
    return clean.fill_null(clean.fill_null(part, 0, ["mrp"]), "None", ["segment"])


@query
def row_arithmetic(spark, sf):
    source = lines(spark, sf).select(
        "billing_document",
        "billing_item",
        "material_code",
        "net_value",
        "tax_amount",
        clean.add(F.col("net_value"), F.col("tax_amount")).alias("amount"),
        clean.negate(F.col("net_value")).alias("negated"),
        clean.ratio(F.col("net_value"), F.col("tax_amount")).alias("net_per_tax"),
        clean.scale(F.col("net_value"), 100_000).alias("lakhs"),
    )
    return source


# Filters and classification


@query
def price_bucket(spark, sf):
    quantity = decimal("l_quantity")
    half = F.concat(text((quantity * F.lit(Decimal("0.5"))).cast("decimal(18,2)")))
    picked = table(spark, sf, "lineitem").select(
        C.price_bucket(text(quantity)).alias("by_quantity"),
        C.price_bucket(text(quantity * 10)).alias("by_tens"),
        C.price_bucket(half).alias("by_half"),
        C.price_bucket(half, floor=False).alias("by_half_exact"),
    )
    return picked.groupBy("by_quantity", "by_tens", "by_half", "by_half_exact").agg(
        F.count("*").alias("n")
    )


@query
def age_bucket(spark, sf):
    days = F.datediff(F.lit(AS_OF), F.col("billing_date"))
    return (
        headers(spark, sf)
        .select(C.age_bucket(days).alias("bucket"), days.alias("days"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("days").alias("low"), F.max("days").alias("high"))
    )


@query
def trade_channel(spark, sf):
    kept = headers(spark, sf).filter(C.in_codes(F.col("customer_group"), REPORTED_GROUPS))
    return (
        kept.select(
            "customer_group", billing.trade_channel(F.col("customer_group")).alias("trade")
        )
        .groupBy("customer_group", "trade")
        .agg(F.count("*").alias("n"))
    )


@query
def merged_segment(spark, sf):
    merged = C.merge_codes(F.col("p_type"), ["SMALL", "MEDIUM"], "SMALL & MEDIUM")
    return table(spark, sf, "part").select("p_partkey", merged.alias("new_segment"))


@query
def status_flags(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        C.regex_flag(F.col("p_type"), "M", "deleted", "not deleted").alias("deletion_indicator"),
        C.code_flag(F.lpad(text("p_size"), 2, "0"), 1, "blocked", "unblocked").alias("block_status"),
        C.code_flag(F.col("p_name"), 1, "blocked", "unblocked").alias("no_code"),
    )


@query
def signed_amounts(spark, sf):
    amount = F.col("billing_amount")
    is_return = F.col("billing_type") == "R"
    signed = lines(spark, sf).select(
        "billing_type",
        C.signed_amount(amount, F.col("billing_type"), ["R"]).alias("signed"),
        C.value_if(is_return, amount).alias("returned"),
        C.flag_if(is_return).alias("is_return"),
    )
    return signed.groupBy("billing_type").agg(
        F.sum("signed").alias("signed"),
        F.sum("returned").alias("returned"),
        F.sum("is_return").alias("return_lines"),
    )


@query
def date_range_filter(spark, sf):
    kept = headers(spark, sf, FLOOR, AS_OF)
    return kept.select("billing_document", "billing_date", "customer_group")


@query
def first_known_column(spark, sf):
    large = F.when(F.col("p_size") > 25, F.col("p_name"))
    return table(spark, sf, "part").select(
        "p_partkey", C.first_known(large, F.col("p_type")).alias("label")
    )


# Joins


@query
def dim_lookup_state(spark, sf):
    coded_customers = table(spark, sf, "customer").select(
        "c_custkey", text(F.col("c_nationkey") + 1).alias("state_code")
    )
    return joins.inline_lookup(coded_customers, STATES, STATE_COLUMNS)


@query
def enriched_lines(spark, sf):
    """Lines with material and customer attributes, summed per brand and segment."""
    home = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_code"), F.col("c_mktsegment").alias("market")
    )
    full = joins.left_lookup(
        joins.left_lookup(lines(spark, sf), headers(spark, sf), "billing_document"),
        materials(spark, sf),
        "material_code",
    )
    enriched = joins.left_lookup(full, home, "customer_code")
    return enriched.groupBy("product_brand", "market").agg(
        F.sum("billing_amount").alias("amount"), F.count("*").alias("n")
    )


@query
def left_join_on_keys(spark, sf):
    """Suppliers with their nation and region through differently named keys."""
    nation = table(spark, sf, "nation")
    with_nation = joins.left_join_on(
        table(spark, sf, "supplier"), nation, {"s_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"]
    )
    return joins.left_join_on(
        with_nation, table(spark, sf, "region"), {"n_regionkey": "r_regionkey"}, ["r_name"]
    )


@query
def billing_fact(spark, sf):
    fact = facts.billing_fact(
        headers(spark, sf),
        lines(spark, sf),
        "billing_document",
        group="customer_group",
        group_codes=REPORTED_GROUPS,
    )
    return fact.select(
        "billing_document",
        "customer_code",
        "billing_date",
        "billing_item",
        "material_code",
        "billing_amount",
    )


@query
def bucketed_fact(spark, sf):
    """The billing fact from headers and items stored in buckets of the document."""
    root, run = scratch_path(spark, "buckets"), uuid.uuid4().hex
    given = {"headers": headers(spark, sf), "items": lines(spark, sf)}
    stored = {
        name: read_bucketed(spark, write_bucketed(df, root, f"{name}_{run}", "billing_document", 16))
        for name, df in given.items()
    }
    fact = facts.billing_fact(
        stored["headers"],
        stored["items"],
        "billing_document",
        group="customer_group",
        group_codes=REPORTED_GROUPS,
    )
    return fact.select(
        "billing_document",
        "customer_code",
        "billing_date",
        "billing_item",
        "material_code",
        "billing_amount",
    )


@query
def unique_dim(spark, sf):
    """Customers with the one latest bill of each."""
    latest = headers(spark, sf).select("customer_code", "billing_date", "billing_document")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_code"), "c_name")
    return joins.lookup_one(customer, latest, ["customer_code"], [F.col("billing_date").desc()])


@query
def global_share(spark, sf):
    """Each customer's sales as a share of all sales."""
    per_customer = groups.group_sum(
        table(spark, sf, "orders").select("o_custkey", decimal("o_totalprice").alias("price")),
        ["o_custkey"],
        "price",
        "sales",
    )
    grand = groups.global_total(per_customer, "sales", "total")
    full = joins.with_scalar(per_customer, grand, "total")
    return full.withColumn("share", clean.ratio(F.col("sales"), F.col("total")))


# Aggregates and windows


@query
def fiscal_brand_totals(spark, sf):
    full = bills(spark, sf).withColumn("fiscal_year", dates.fiscal_year(F.col("billing_date")))
    return groups.group_sum(full, ["fiscal_year", "product_brand"], "billing_amount", "total")


@query
def group_totals(spark, sf):
    """Each bill with its customer's totals and billed months."""
    bill = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        decimal("o_totalprice").alias("price"),
        "o_orderstatus",
        dates.month_start(F.col("o_orderdate").cast("date")).alias("month"),
    )
    full = groups.with_group_totals(
        bill.drop("month"),
        ["o_custkey"],
        {
            "customer_total": F.sum("price"),
            "largest": F.max("price"),
            "bills": F.count("price"),
            "open_bills": F.sum(C.flag_if(F.col("o_orderstatus") == "O")),
        },
    )
    average = clean.ratio(F.col("customer_total"), F.col("bills"))
    full = full.withColumn("average", average).drop("bills")
    months = groups.collect_months(bill, ["o_custkey"], "month", "months")
    with_months = joins.left_lookup(full, months, "o_custkey")
    return with_months.withColumn("months", dates.month_list(F.col("months")))


@query
def distinct_keys(spark, sf):
    return groups.distinct_keys(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query
def distinct_lines(spark, sf):
    return groups.distinct_rows(
        table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus")
    )


@query
def returns_profile(spark, sf):
    return facts.returns_profile(bills(spark, sf), SERIES, "billing_amount", "billing_type", ["R"])


@query
def last_billed(spark, sf):
    return recency.last_date(headers(spark, sf), ["customer_code"], "billing_date", "last_billed")


@query
def brand_contribution(spark, sf):
    return groups.contribution(bills(spark, sf), ["product_brand"], "billing_amount")


@query
def cumulative_by_year(spark, sf):
    """Customer totals by falling amount within the fiscal year, in whole thousands so
    that equal totals occur."""
    full = bills(spark, sf).withColumn("fiscal_year", dates.fiscal_year(F.col("billing_date")))
    totals = groups.group_sum(full, ["fiscal_year", "customer_code"], "billing_amount", "raw")
    coarse = totals.withColumn("total", F.floor(F.col("raw") / 1000)).drop("raw")
    return running.cumulative_sum(
        stage(coarse, "year_totals"), ["fiscal_year"], "total", "total", "cumulative", total="year_total"
    )


@query
def running_sum_rows(spark, sf):
    slim = bills(spark, sf).select(
        "business_segment", "billing_date", "billing_document", "billing_item", "material_code",
        "billing_amount",
    )
    order = ["billing_date", "billing_document", "billing_item", "material_code", "billing_amount"]
    return running.running_sum(
        slim, ["business_segment"], [F.col(c) for c in order], "billing_amount", "running"
    )


@query
def pareto_brand_fy(spark, sf):
    full = bills(spark, sf).withColumn("fiscal_year", dates.fiscal_year(F.col("billing_date")))
    return pareto.pareto(full, "product_brand", "billing_amount", "fiscal_year")


@query
def pareto_customer_fy(spark, sf):
    full = bills(spark, sf).withColumn("fiscal_year", dates.fiscal_year(F.col("billing_date")))
    return pareto.pareto(full, "customer_code", "billing_amount", "fiscal_year")


@query
def pareto_line(spark, sf):
    slim = bills(spark, sf).select(
        "product_brand", "billing_amount", "billing_document", "billing_item", "material_code"
    )
    tiebreak = [F.col(c) for c in ("billing_document", "billing_item", "material_code")]
    return pareto.pareto_lines(slim, "product_brand", "billing_amount", tiebreak)


@query
def focus_brand_tag(spark, sf):
    """Region and brand sales, tagged by the focus list."""
    totals = groups.group_sum(
        state_bills(spark, sf), ["region", "product_brand"], "billing_amount", "total"
    )
    return register.focus_tag(
        totals, register.focus_brands(extracts(spark, sf)["focus_brand"])
    )


# Period measures


@query
def window_join(spark, sf):
    """Sales of each customer's bill days in the 45 days up to them."""
    sums = groups.group_sum(
        bills(spark, sf), ["customer_code", "billing_date"], "billing_amount", "amount"
    )
    # The anchors and the bills: bills are joined once.
    daily = stage(sums, "daily")
    day = F.col("billing_date")
    anchors = daily.select(
        "customer_code", F.date_sub(day, 45).alias("first"), day.alias("last")
    )
    summed = periods.window_sums(
        anchors, daily, ["customer_code"], "billing_date", "first", "last", {"amount": "amount"}, "days"
    )
    return summed.drop("first")


def measure(spark, sf, keys, *names, **options):
    source = state_bills(spark, sf) if "state" in keys else bills(spark, sf)
    return periods.period_measures(source, keys, "billing_date", MEASURES, AS_OF, names, **options)


@query
def mtd(spark, sf):
    return measure(spark, sf, SERIES, "MTD")


BILL_KEY = ["billing_document", "billing_item", "material_code", "billing_type", *MEASURES.values()]


@query
def mtd_of_repeated_bills(spark, sf):
    """Bills of which some were delivered twice, each counted once."""
    given = bills(spark, sf)
    twice = given.unionByName(given.where("billing_item <> 2"))
    return periods.period_measures(
        twice, SERIES, "billing_date", MEASURES, AS_OF, ["MTD"], line_key=[*BILL_KEY, "billing_date", *SERIES]
    )


@query
def lymtd_shifted(spark, sf):
    return measure(spark, sf, SERIES, "LYMTD")


@query
def lymtd_asof_end(spark, sf):
    return measure(spark, sf, SERIES, "LYMTD", end_rule="as_of")


@query
def lymtd_reuse(spark, sf):
    return measure(spark, sf, SERIES, "LYMTD", ly_rule="reuse")


@query
def l1mtd_l2mtd(spark, sf):
    return measure(spark, sf, SERIES, "L1MTD", "L2MTD")


@query
def l1mtd_l2mtd_asof_end(spark, sf):
    return measure(spark, sf, SERIES, "L1MTD", "L2MTD", "L2MMTD", end_rule="as_of")


@query
def l2mmtd(spark, sf):
    return measure(spark, sf, SERIES, "L2MMTD")


@query
def lm(spark, sf):
    return measure(spark, sf, SERIES, "LM")


@query
def lmmtd(spark, sf):
    return measure(spark, sf, SERIES, "LMMTD")


@query
def lmmtd_snap(spark, sf):
    return measure(spark, sf, SERIES, "LMMTD", eom="snap")


@query
def l2m(spark, sf):
    return measure(spark, sf, SERIES, "L2M")


@query
def ytd_running(spark, sf):
    return measure(spark, sf, SERIES, "YTD")


@query
def ytd_fy(spark, sf):
    return measure(spark, sf, SERIES, "YTD", running=False)


@query
def lytd_running(spark, sf):
    return measure(spark, sf, SERIES, "LYTD")


@query
def lytd_fy(spark, sf):
    return measure(spark, sf, SERIES, "LYTD", running=False)


@query
def all_periods_dense(spark, sf):
    """Every period for nation and brand, reported from the floor month on."""
    return measure(spark, sf, DENSE, *periods.PERIODS, floor=FLOOR)


@query
def growth_ratios(spark, sf):
    full = measure(spark, sf, DENSE, *register.REGISTER_PERIODS)
    pairs = register.growth_pairs()
    return periods.growth(full, pairs).select(*DENSE, "billing_month", *pairs)


@query
def mtd_per_day(spark, sf):
    rated = {f"MTD_per_day{s}": f"MTD{s}" for s in MEASURES}
    return periods.per_day(measure(spark, sf, DENSE, "MTD"), rated, AS_OF)


# Customers


@query
def customer_recency(spark, sf):
    out = recency.recency(
        headers(spark, sf), "customer_code", "billing_date", AS_OF, ["customer_group"]
    )
    return out.withColumn("billed_months", dates.month_list(F.col("billed_months")))


def missed(spark, sf, rule):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_code"))
    billed = recency.fiscal_bits(headers(spark, sf), ["customer_code"], "billing_date", AS_OF, "billed")
    full = joins.left_lookup(customer, billed, "customer_code")
    return recency.unbilled_months(full, "billed", AS_OF, fully_billed=rule).drop("billed")


@query
def unbilled_months(spark, sf):
    return missed(spark, sf, "none")


@query
def unbilled_months_all(spark, sf):
    return missed(spark, sf, "all")


# Budgets


@query
def budget_calendar_12(spark, sf):
    return B.budget_calendar(extracts(spark, sf)["material_budget"], AS_OF)


@query
def budget_calendar_13(spark, sf):
    return B.budget_calendar(extracts(spark, sf)["Asm_Budget"], AS_OF, 13)


@query
def cut_day_sales(spark, sf):
    return B.cut_day_sums(
        bills(spark, sf), ["customer_code", "business_segment"], "billing_date", "billing_amount"
    )


@query
def budget_achievement(spark, sf):
    budget = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_code"),
        F.explode(F.array(F.lit("PROMO"), F.lit("SMALL"), F.lit(None))).alias("segment"),
        text(F.abs(F.floor(F.col("c_acctbal") / 1000))).alias("Monthly Budget"),
    )
    rows = B.budget_rows(budget, "segment")
    segment = F.when(F.col("business_segment") != "LARGE", F.col("business_segment"))
    sales = B.cut_day_sums(
        bills(spark, sf).withColumn("business_segment", segment),
        ["customer_code", "business_segment"],
        "billing_date",
        "billing_amount",
    )
    return B.budget_achievement(B.budget_calendar(rows, AS_OF), sales, AS_OF)


# Masters and the register


@query
def group_text(spark, sf):
    given = extracts(spark, sf)
    return masters.customer_group_text(given["KNVV"], given["T151T"])


def all_reports(spark, sf, given=extracts, **changed):
    contact = {"nsm_name_lit": "head office", "nsm_email_lit": "head@office.example"}
    options = reports.ReportOptions(as_of=AS_OF, floor=FLOOR, contact=contact, **changed)
    return reports.Reports(spark, given(spark, sf), options)


@query
def material_master(spark, sf):
    given = extracts(spark, sf)
    return masters.material_master(given["MARA"], given["MARC"], given["CEPC"])


@query
def customer_master(spark, sf):
    return all_reports(spark, sf)["customer_master"]


@query
def sales_force_master(spark, sf):
    given = extracts(spark, sf)
    customer = masters.customers(given["KNA1"])
    contact = {"nsm_name_lit": "head office", "nsm_email_lit": "head@office.example"}
    return masters.sales_force_master(given["ZCUST_ADD_DETAIL"], customer, contact)


@query
def sales_register(spark, sf):
    return all_reports(spark, sf)["sales_register"]


@query
def sales_register_spanning(spark, sf):
    """The register with to-date windows that end on `as_of` itself and with year
    totals by fiscal-year label."""
    return all_reports(spark, sf, end_rule="as_of", running=False, keep_sign=False)[
        "sales_register"
    ]


@query
def sales_register_dirty(spark, sf):
    """The register from padded codes, grouped digits, signs at either end, and every
    customer group and document type."""
    return all_reports(spark, sf, dirty_extracts)["sales_register"]


@query
def sales_register_dirty_unsigned(spark, sf):
    """The same with the signs of quantities and weights lost."""
    return all_reports(spark, sf, dirty_extracts, keep_sign=False)["sales_register"]


@query
def customer_master_all(spark, sf):
    """Customers billed in every month are shown as if in none."""
    return all_reports(spark, sf, fully_billed="all")["customer_master"]


@query
def customer_budget_report(spark, sf):
    return all_reports(spark, sf)["customer_budget"]


# Sources and sinks


@query
def roundtrip_parquet(spark, sf):
    """Bills through a curated table partitioned by month, all read back."""
    root = scratch_path(spark, "curated")
    monthly = headers(spark, sf).withColumn(
        "billing_month", dates.month_start(F.col("billing_date"))
    )
    # Rebalancing splits a month that outgrows a file, whatever the input's size.
    by_month = monthly.hint("rebalance", "billing_month")
    write_table(by_month, root, "bills", partition_by=["billing_month"])
    return read_table(spark, root, "bills").select(
        "billing_document", "customer_code", "billing_date", "customer_group"
    )


@query
def versioned_bills(spark, sf):
    """Bill headers in two versions, the second of which writes the months that differ; both read."""
    root, month = scratch_path(spark, "versions"), F.date_format("billing_date", "yyyy-MM")
    all_bills = headers(spark, sf)
    late = F.col("billing_date") >= F.lit(FLOOR)
    first = publish(all_bills.where(~late | (F.col("customer_group") != "DL")), root, "bills", month)
    second = publish(all_bills, root, "bills", month)
    both = [
        read_version(spark, root, "bills", version=v).select(F.lit(v.number).alias("version"), "billing_date")
        for v in (first, second)
    ]
    return both[0].union(both[1]).groupBy("version", month.alias("month")).agg(F.count("*").alias("bills"))


@query
def incremental_daily_sales(spark, sf):
    """Sales per group and month from daily sums that were kept up to date: first some lines
    were missing, then those months alone were summed again."""
    store = scratch_path(spark, "store")
    given = extracts(spark, sf)
    lines = stage(billing.billing_lines(given["VBRK"], given["VBRP"]), reports.LINES)
    known = ~((F.col("billing_date") >= F.lit(FLOOR)) & (F.col("customer_group") == "MT"))
    reports.refresh_daily(lines.where(known), store)
    daily = read_version(spark, store, reports.DAILY, version=reports.refresh_daily(lines, store).version)
    return daily.groupBy("customer_group", F.date_format("billing_date", "yyyy-MM").alias("month")).agg(
        clean.exact_sum(daily, "billing_amount").alias("amount"),
        clean.exact_sum(daily, "qty_in_kg").alias("kg"),
        F.sum("lines").alias("lines"),
        F.sum("damage_doc_count").alias("return_lines"),
    )


@query
def ingest_delimited(spark, sf):
    """Customers as a padded delimited extract, ingested into a curated table."""
    raw, curated = scratch_path(spark, "raw"), scratch_path(spark, "curated")
    extract = table(spark, sf, "customer").select(
        F.lpad(text("c_custkey"), 10, "0").alias("KUNNR"),
        F.concat(F.lit('"'), F.col("c_name"), F.lit(" ")).alias("NAME1"),
        F.lpad(text("c_nationkey"), 3, "0").alias("REGIO"),
    )
    joined = extract.select(
        F.concat_ws("^", "KUNNR", "NAME1", "REGIO").alias("KUNNR^NAME1^REGIO")
    )
    # No character is a quote, and the one column never needs a separator.
    joined.write.option("header", True).option("quote", "").option("sep", "\u0001").option(
        "escape", ""
    ).csv(f"{raw}/KNA1")
    ingest(spark, raw, curated, "KNA1", "^", zero_cols=["KUNNR"])
    return read_table(spark, curated, "KNA1")
