"""The given tables as billing inputs: typed bills and text-only extracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.fixed_values import CREDIT_TYPES, MATERIAL_NAMES, REPORTED_GROUPS, SALES_FORCE_NAMES
from tallyfold.functions.clean import MONEY
from tallyfold.functions.dates import between_dates
from tallyfold.sources.delimited import clean_extract

AS_OF = dt.date(2001, 7, 15)
FLOOR = dt.date(1999, 4, 1)

GROUP_OF_PRIORITY = {
    "1-URGENT": "DL",
    "2-HIGH": "MT",
    "3-MEDIUM": "EX",
    "4-NOT SPECIFIED": "OT",
    "5-LOW": "JM",
}
GROUP_OF_SEGMENT = {
    "AUTOMOBILE": "DL",
    "BUILDING": "MT",
    "FURNITURE": "EX",
    "HOUSEHOLD": "JM",
    "MACHINERY": "ZZ",
}
SEGMENT_OF_CENTRE = {"PC1": "BISC", "PC2": "COOK", "PC3": "CAKE"}
BUDGET_SEGMENTS = ["Biscuit & Cookies", "Cake", "Rusk"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def decimal(c: str, kind: str = MONEY) -> Column:
    return F.col(c).cast(kind)


def coded(c: str, codes: dict[str, str], other: str | None = None) -> Column:
    out = F
    for value, code in codes.items():
        out = out.when(F.col(c) == value, F.lit(code))
    return out.otherwise(F.lit(other)) if other is not None else out


def net_value() -> Column:
    gross, off = decimal("l_extendedprice"), decimal("l_discount", "decimal(4,2)")
    return (gross * (F.lit(1).cast("decimal(4,2)") - off)).cast(MONEY)


def tax_amount(net: Column) -> Column:
    return (net * decimal("l_tax", "decimal(4,2)")).cast(MONEY)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Invoice lines: document, codes, type, net, tax, amount and quantity."""
    net = net_value()
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("billing_document"),
        F.col("l_linenumber").alias("billing_item"),
        F.col("l_partkey").alias("material_code"),
        F.col("l_returnflag").alias("billing_type"),
        net.alias("net_value"),
        tax_amount(net).alias("tax_amount"),
        (net + tax_amount(net)).cast(MONEY).alias("billing_amount"),
        decimal("l_quantity").alias("billed_quantity"),
    )


def headers(
    spark: SparkSession, sf: str, low: dt.date | None = None, high: dt.date | None = None
) -> DataFrame:
    """Billing headers, optionally dated from `low` through `high`."""
    orders = table(spark, sf, "orders")
    if high is not None:
        first = low or dt.date(1900, 1, 1)
        orders = orders.filter(between_dates(F.col("o_orderdate"), first, high))
    return orders.select(
        F.col("o_orderkey").alias("billing_document"),
        F.col("o_custkey").alias("customer_code"),
        F.col("o_orderdate").cast("date").alias("billing_date"),
        coded("o_orderpriority", GROUP_OF_PRIORITY).alias("customer_group"),
    )


def materials(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("material_code"),
        F.col("p_brand").alias("product_brand"),
        F.col("p_type").alias("business_segment"),
        F.col("p_size").alias("mrp"),
    )


def bills(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with bill date, customer, brand, segment and weight."""
    return (
        lines(spark, sf)
        .join(headers(spark, sf), "billing_document")
        .join(materials(spark, sf), "material_code")
        .withColumn("qty_in_kg", (F.col("billed_quantity") * F.col("mrp")).cast(MONEY))
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with nation and region."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    home = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customer = table(spark, sf, "customer")
    return customer.join(home, customer.c_nationkey == home.n_nationkey)


def state_bills(spark: SparkSession, sf: str) -> DataFrame:
    """Bills with the customer's nation and region."""
    home = places(spark, sf).select(
        F.col("c_custkey").alias("customer_code"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
    )
    return bills(spark, sf).join(home, "customer_code")


# Text-only extracts, shaped as the ERP delivers them.


def _filled(df: DataFrame, fields: list[str], given: dict[str, Column]) -> DataFrame:
    return df.select([given.get(f, F.lit("")).alias(f) for f in fields])


def extracts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    part, customer = table(spark, sf, "part"), table(spark, sf, "customer")
    supplier, region = table(spark, sf, "supplier"), table(spark, sf, "region")
    net = net_value()
    urgent = F.col("o_orderpriority") == "1-URGENT"
    doc_type = (
        F.when(F.col("o_orderstatus") != "P", "ZF2").when(urgent, "ZDR1").otherwise("ZREM")
    )
    vbrk = orders.select(
        text("o_orderkey").alias("VBELN"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("FKDAT"),
        doc_type.alias("FKART"),
        coded("o_orderpriority", GROUP_OF_PRIORITY).alias("KDGRP"),
        text("o_custkey").alias("KUNAG"),
        F.concat(F.lit("INV"), text("o_orderkey")).alias("XBLNR"),
    )
    quantity = decimal("l_quantity")
    vbrp = lineitem.select(
        F.concat(F.lit("PC"), text("l_linenumber")).alias("PRCTR"),
        text("l_suppkey").alias("WERKS"),
        F.when(F.col("l_linestatus") == "O", "TAN").otherwise("REN").alias("PSTYV"),
        F.lit("1000").alias("VKORG_AUFT"),
        text(tax_amount(net)).alias("MWSBP"),
        text("l_orderkey").alias("VBELN"),
        text("l_linenumber").alias("POSNR"),
        text("l_partkey").alias("MATNR"),
        F.concat(F.lit("Item "), F.col("l_returnflag")).alias("ARKTX"),
        text(quantity).alias("FKIMG"),
        F.lit("CV").alias("VRKME"),
        text(quantity).alias("FKLMG"),
        text(net).alias("NETWR"),
        text((quantity * F.lit(25)).cast(MONEY)).alias("NTGEW"),
    )
    size = F.col("p_size")
    mara = _filled(
        part,
        list(MATERIAL_NAMES),
        {
            "MATNR": text("p_partkey"),
            "LVORM": F.when(size % 10 == 0, "X").otherwise(""),
            "MATKL": F.col("p_type"),
            "ZZPBD": F.upper("p_brand"),
            "ZZBFLV": F.col("p_name"),
            "ZZMRP": text(size),
            "ZZPCT": F.lower("p_type"),
            "ZZSZE": F.concat(text(size), F.lit("g")),
            "ZZFMT": F.lit("pack"),
            "ZZMRPCB": text(size * 12),
            "ZZNOBIS": F.lit("8"),
            "ZZSECQTY": F.lit("24"),
            "ZZSECTYP": F.lit("box"),
        },
    )
    centres = F.array(*[F.concat(F.lit("PC"), text(size % 7 + n)) for n in (1, 2)])
    marc = part.select(text("p_partkey").alias("MATNR"), F.explode(centres).alias("PRCTR"))
    cepc = marc.select("PRCTR").distinct().select(
        "PRCTR", coded("PRCTR", SEGMENT_OF_CENTRE, "RUSK").alias("SEGMENT")
    )
    kna1 = places(spark, sf).select(
        text("c_custkey").alias("KUNNR"),
        F.upper("c_name").alias("NAME1"),
        text(F.col("n_nationkey") + 1).alias("REGIO"),
        F.when(F.col("c_acctbal") < 0, "01").otherwise("").alias("AUFSD"),
        F.col("n_name").alias("ZZDT"),
        F.col("c_mktsegment").alias("ZZTN"),
        F.col("r_name").alias("ZZGP"),
        F.lower("c_mktsegment").alias("ZZML"),
        F.col("r_name").alias("ZZONE"),
    )
    level = F.substring("o_orderpriority", 1, 1)
    roles = {
        "SONAME": "so", "ASMNAME": "asm", "RSMNAME": "rsm", "ZSMNAME": "zsm", "NSMNAME": "nsm",
        "DSM_NAME": "dsm", "SR_NAME": "sr", "EMPCD1": "e1", "EMPCD2": "e2", "EMPCD3": "e3",
        "EMPCD5": "e5", "SMTP_1": "so@", "SMTP_2": "asm@", "SMTP_3": "rsm@", "ZSMMAIL": "zsm@",
    }
    detail = _filled(
        orders.select("o_custkey", "o_orderpriority").distinct(),
        list(SALES_FORCE_NAMES),
        {"KUNNR": text("o_custkey")}
        | {f: F.concat(F.lit(f"{word} "), level) for f, word in roles.items()},
    )
    number = F.substring("p_brand", 7, 10).cast("int")
    brands = part.select("p_brand", (number % 5).alias("r_regionkey")).distinct()
    amount = F.abs(decimal("c_acctbal")) * F.lit(1).cast("decimal(4,2)")
    budget = customer.select(
        text("c_custkey").alias("customer_code"),
        F.explode(F.array(*[F.lit(s) for s in BUDGET_SEGMENTS], F.lit(None))).alias("segment"),
        text(amount.cast(MONEY)).alias("Monthly Budget"),
    )
    return {
        "VBRK": vbrk,
        "VBRP": vbrp,
        "MARA": mara,
        "MARC": marc,
        "CEPC": cepc,
        "KNA1": kna1,
        "ZCUST_ADD_DETAIL": detail,
        "KNVV": customer.select(
            text("c_custkey").alias("KUNNR"),
            F.lit("1000").alias("VKORG"),
            coded("c_mktsegment", GROUP_OF_SEGMENT).alias("KDGRP"),
        ),
        "T151T": orders.select("o_orderpriority").distinct().select(
            coded("o_orderpriority", GROUP_OF_PRIORITY).alias("KDGRP"),
            F.concat(F.lit("Group "), F.col("o_orderpriority")).alias("KTEXT"),
        ),
        "focus_brand": brands.join(region, "r_regionkey").select(
            F.col("r_name").alias("region"), F.col("p_brand").alias("product_brand")
        ),
        "customer_budget": budget,
        "Asm_Budget": supplier.select(
            F.col("s_name").alias("asm"), text(decimal("s_acctbal")).alias("budget")
        ),
        "material_budget": part.select(
            text("p_partkey").alias("material_code"),
            text(decimal("p_retailprice")).alias("budget"),
        ),
    }


# The same extracts as they come in practice: padded codes, grouped digits, signs at either
# end, every customer group and document type.

GROUPS = [*REPORTED_GROUPS, "OT", "XX"]
DOC_TYPES = [*CREDIT_TYPES, "ZF2", "ZF2", "ZF2"]
PADDED = {"VBRK": ["VBELN", "KUNAG"], "VBRP": ["VBELN", "MATNR"]}


def _picked(c: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (c % len(values) + 1).cast("int"))


def _printed(number: Column, minus: Column, leading: bool = False) -> Column:
    """Digits in groups of three; a minus before or behind them."""
    digits, sign = F.format_number(number, 2), F.when(minus, "-").otherwise("")
    return F.concat(sign, digits) if leading else F.concat(digits, sign)


def dirty_extracts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    net, quantity = net_value(), decimal("l_quantity")
    credit, back = F.col("l_linenumber") % 6 == 5, F.col("l_linenumber") % 5 == 2
    given = extracts(spark, sf)
    vbrk = orders.select(
        text("o_orderkey").alias("VBELN"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("FKDAT"),
        _picked(F.col("o_orderkey"), DOC_TYPES).alias("FKART"),
        _picked(F.col("o_custkey"), GROUPS).alias("KDGRP"),
        text("o_custkey").alias("KUNAG"),
        F.concat(F.lit("INV"), text("o_orderkey")).alias("XBLNR"),
    )
    vbrp = lineitem.select(
        F.concat(F.lit("PC"), text("l_linenumber")).alias("PRCTR"),
        text("l_suppkey").alias("WERKS"),
        F.when(F.col("l_linestatus") == "O", "TAN").otherwise("REN").alias("PSTYV"),
        F.lit("1000").alias("VKORG_AUFT"),
        _printed(tax_amount(net), credit).alias("MWSBP"),
        text("l_orderkey").alias("VBELN"),
        text("l_linenumber").alias("POSNR"),
        text("l_partkey").alias("MATNR"),
        F.concat(F.lit("Item "), F.col("l_returnflag")).alias("ARKTX"),
        text(quantity).alias("FKIMG"),
        F.lit("CV").alias("VRKME"),
        _printed((quantity * F.lit(37)).cast(MONEY), back).alias("FKLMG"),
        _printed(net, credit).alias("NETWR"),
        _printed((quantity * F.lit(25)).cast(MONEY), back, leading=True).alias("NTGEW"),
    )
    texts = [(g, f"Group {g}") for g in GROUPS]
    dirty = {"VBRK": vbrk, "VBRP": vbrp}
    for name, codes in PADDED.items():
        padded = {c: F.concat(F.lit("  "), F.lpad(c, 18, "0"), F.lit(" ")) for c in codes}
        dirty[name] = clean_extract(dirty[name].withColumns(padded), codes)
    return given | dirty | {"T151T": spark.createDataFrame(texts, "KDGRP string, KTEXT string")}
