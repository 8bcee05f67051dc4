"""SQL twins of the masters and of the reports built from text-only extracts."""

from __future__ import annotations

from collections.abc import Mapping

from tallyfold.fixed_values import (
    MATERIAL_NAMES,
    REGISTER_COLUMNS,
    REPORTED_GROUPS,
    SALES_FORCE_NAMES,
    STATES,
)
from workload import oracles as o
from workload.inputs import AS_OF, BUDGET_SEGMENTS, DOC_TYPES, FLOOR, GROUP_OF_PRIORITY, GROUPS

# One of each set of equal lines.
ONCE = "SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_linestatus, l_returnflag, l_quantity, l_tax, "

# Registered billing lines of the reported groups, with bare headers.
SOLD = f"""
net_lines AS (SELECT *, {o.NET} AS net FROM lineitem),
tax_lines AS (
  SELECT *, net + CAST(net * CAST(l_tax AS DECIMAL(4,2)) AS {o.MONEY}) AS gross FROM net_lines
),
sold_lines AS (
  SELECT {o.case('o_orderpriority', GROUP_OF_PRIORITY)} AS customer_group,
         'Group ' || o_orderpriority AS customer_group_description,
         CAST(o_custkey AS VARCHAR) AS customer_code, CAST(l_partkey AS VARCHAR) AS material_code,
         CASE l_linestatus WHEN 'O' THEN 'TAN' WHEN 'F' THEN 'REN' END AS item_category,
         'Item ' || l_returnflag AS material_description,
         CASE WHEN l_orderkey IS NOT NULL THEN 'CV' END AS "UoM",
         CAST(o_orderdate AS DATE) AS billing_date,
         CASE WHEN o_orderstatus <> 'P' THEN 'ZF2' WHEN o_orderpriority = '1-URGENT' THEN 'ZDR1'
              ELSE 'ZREM' END AS billing_type,
         CAST(gross AS {o.MONEY}) AS plus, CAST(l_quantity AS {o.MONEY}) AS billed_quantity,
         CAST(l_quantity * 25 AS {o.MONEY}) AS qty_in_kg
  FROM orders LEFT JOIN tax_lines ON l_orderkey = o_orderkey
),
sold AS (
  SELECT *, CASE WHEN billing_type <> 'ZF2' AND plus > 0 THEN -plus ELSE plus END AS billing_amount
  FROM sold_lines WHERE customer_group IN ({o.codes(REPORTED_GROUPS)})
),
mats AS (
  SELECT *, CAST(p_partkey AS VARCHAR) AS material_code,
         CASE p_size % 7 WHEN 0 THEN 'Bisc' WHEN 1 THEN 'Cook' WHEN 2 THEN 'Cake' ELSE 'Rusk' END AS segment,
         CASE p_size % 7 WHEN 0 THEN 'Biscuit & Cookies' WHEN 1 THEN 'Biscuit & Cookies'
              WHEN 2 THEN 'Cake' ELSE 'Rusk' END AS business_segment
  FROM part
),
states AS (
  SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in STATES)}) s(state_code, state)
),
custs AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_code, {o.initcap('c_name')} AS customer_name,
         CAST(n_nationkey + 1 AS VARCHAR) AS state_code, {o.initcap('state')} AS state_name,
         CASE WHEN c_acctbal < 0 THEN '01' ELSE '' END AS central_block_code,
         CASE WHEN c_acctbal < 0 THEN 'blocked' ELSE 'unblocked' END AS block_status,
         {o.initcap('n_name')} AS district, {o.initcap('c_mktsegment')} AS town_village,
         {o.initcap('r_name')} AS region, {o.initcap('c_mktsegment')} AS block_tehsil, r_name AS zone
  FROM {o.HOMES} LEFT JOIN states ON states.state_code = CAST(n_nationkey + 1 AS VARCHAR)
),
detail AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS customer_code, o_orderpriority[1] AS level FROM orders
),
team AS (SELECT customer_code, min(level) AS level FROM detail GROUP BY ALL)"""


def quote(name: str) -> str:
    return f'"{name}"'


def select(columns: Mapping[str, str]) -> str:
    return ",\n  ".join(f"{sql} AS {quote(name)}" for name, sql in columns.items())


def material_master() -> str:
    given = {
        "MATNR": "material_code",
        "LVORM": "CASE WHEN p_size % 10 = 0 THEN 'X' ELSE '' END",
        "MATKL": "p_type",
        "ZZPBD": "p_brand",
        "ZZBFLV": o.initcap("p_name"),
        "ZZMRP": "CAST(p_size AS VARCHAR)",
        "ZZPCT": "lower(p_type)",
        "ZZSZE": "CAST(p_size AS VARCHAR) || 'g'",
        "ZZFMT": "'pack'",
        "ZZMRPCB": "CAST(p_size * 12 AS VARCHAR)",
        "ZZNOBIS": "'8'",
        "ZZSECQTY": "'24'",
        "ZZSECTYP": "'box'",
    }
    columns = {name: given.get(field, "''") for field, name in MATERIAL_NAMES.items()}
    columns |= {
        "deletion_indicator": "CASE WHEN p_size % 10 = 0 THEN 'deleted' ELSE 'not deleted' END",
        "segment": "segment",
        "new_segment": "business_segment",
    }
    return f"WITH {SOLD} SELECT {select(columns)} FROM mats"


def sales_force_master() -> str:
    cased = {"SONAME": "So", "ASMNAME": "Asm", "RSMNAME": "Rsm", "ZSMNAME": "Zsm",
             "NSMNAME": "Nsm", "DSM_NAME": "Dsm", "SR_NAME": "Sr"}
    plain = {"EMPCD1": "e1", "EMPCD2": "e2", "EMPCD3": "e3", "EMPCD5": "e5", "SMTP_1": "so@",
             "SMTP_2": "asm@", "SMTP_3": "rsm@", "ZSMMAIL": "zsm@"}
    given = {f: f"'{word} ' || level" for f, word in (cased | plain).items()}
    given["KUNNR"] = "customer_code"
    columns = {name: given.get(field, "''") for field, name in SALES_FORCE_NAMES.items()}
    taken = ["customer_name", "block_status", "zone", "region", "state_code", "town_village",
             "district", "state_name"]
    columns |= {c: c for c in taken}
    columns |= {"nsm_name_lit": "'head office'", "nsm_email_lit": "'head@office.example'"}
    return f"WITH {SOLD} SELECT {select(columns)} FROM detail LEFT JOIN custs USING (customer_code)"


def customer_master(fallback: str = "''") -> str:
    kept = ["customer_code", "state_code", "customer_name", "central_block_code", "district",
            "town_village", "region", "block_tehsil", "zone", "block_status", "state_name"]
    columns = {c: f"c.{c}" for c in kept}
    for role in ("so", "asm", "rsm", "zsm"):
        columns[f"{role}_name"] = f"'{role} ' || level"
        columns[f"{role}_email"] = f"'{role}@ ' || level"
    columns |= {
        "customer_group": "customer_group",
        "customer_group_description": "customer_group_description",
        "trade": "trade",
        "last_billed_date": o.day_text("last_billed_date"),
        "system_date": f"CASE WHEN last_billed_date IS NOT NULL THEN '{AS_OF}' END",
        "unbilled_days": "days",
        "unbilled_ageing_bucket": o.AGE,
        "unbilled_months": f"coalesce(months, {fallback})",
    }
    return f"""
WITH {SOLD},
days AS (
  SELECT customer_code, max(billing_date) AS last_billed_date,
         CAST({o.TODAY} - max(billing_date) AS BIGINT) AS days
  FROM sold GROUP BY ALL
),
latest AS (
  SELECT customer_code, max(customer_group) AS customer_group
  FROM sold JOIN days USING (customer_code) WHERE billing_date = last_billed_date GROUP BY ALL
),
texts AS (SELECT DISTINCT customer_group, customer_group_description FROM sold),
elapsed AS (
  SELECT CAST(unnest(generate_series({o.fy_start(o.TODAY)}, {o.CURRENT}, INTERVAL 1 MONTH)) AS DATE) AS m
),
missing AS (
  SELECT c.customer_code, string_agg(strftime(m, '%b-%y'), ',' ORDER BY m) AS months
  FROM custs c CROSS JOIN elapsed
  WHERE NOT EXISTS (SELECT 1 FROM sold s WHERE s.customer_code = c.customer_code
                    AND {o.month('s.billing_date')} = m)
  GROUP BY ALL
),
full_rows AS (
  SELECT c.*, level, customer_group, customer_group_description,
         CASE WHEN customer_group IS NOT NULL THEN {o.trade('customer_group')} END AS trade,
         last_billed_date, days, months
  FROM custs c LEFT JOIN team USING (customer_code) LEFT JOIN days USING (customer_code)
  LEFT JOIN latest USING (customer_code) LEFT JOIN texts USING (customer_group)
  LEFT JOIN missing USING (customer_code)
)
SELECT {select(columns)} FROM full_rows c"""


def customer_budget() -> str:
    segments = ", ".join(f"('{s}')" for s in [*BUDGET_SEGMENTS, "None"])
    return f"""
WITH {SOLD},
b AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_code, segment,
         CAST(abs(CAST(c_acctbal AS {o.MONEY})) AS VARCHAR) AS budget
  FROM customer, (VALUES {segments}) s(segment)
),
s AS (
  SELECT customer_code, coalesce(business_segment, 'None') AS segment, {o.month('billing_date')} AS m,
         day(last_day({o.month('billing_date')})) AS montly_days, {o.cut_sums()}
  FROM sold LEFT JOIN mats USING (material_code) GROUP BY ALL
),
j AS (
  SELECT b.*, x.m, s.* EXCLUDE (customer_code, segment, m)
  FROM b CROSS JOIN {o.months_of_year(12)} x
  LEFT JOIN s ON s.customer_code = b.customer_code AND s.segment = b.segment AND s.m = x.m
)
SELECT customer_code, segment, budget AS "Monthly Budget", {o.BUDGET_DATES},
       {o.achievement_select(o.dbl('budget'))}
FROM j"""


def dirty(sql: str, keep_sign: bool) -> str:
    """A report on the extracts as they come in practice (`dirty_extracts`)."""
    group = f"([{o.codes(GROUPS)}])[o_custkey % {len(GROUPS)} + 1]"
    back = "CASE WHEN l_linenumber % 5 = 2 THEN -1 ELSE 1 END *" if keep_sign else ""
    swaps = {
        f"{o.case('o_orderpriority', GROUP_OF_PRIORITY)} AS customer_group": f"{group} AS customer_group",
        "'Group ' || o_orderpriority": f"'Group ' || {group}",
        "CASE WHEN o_orderstatus <> 'P' THEN 'ZF2' WHEN o_orderpriority = '1-URGENT' THEN 'ZDR1'\n"
        "              ELSE 'ZREM' END": f"([{o.codes(DOC_TYPES)}])[o_orderkey % {len(DOC_TYPES)} + 1]",
        f"CAST(gross AS {o.MONEY}) AS plus": f"CAST(CASE WHEN l_linenumber % 6 = 5 THEN -gross ELSE gross END "
        f"AS {o.MONEY}) AS plus",
        f"CAST(l_quantity AS {o.MONEY}) AS billed_quantity": f"CAST({back} l_quantity * 37 AS {o.MONEY}) AS billed_quantity",
        f"CAST(l_quantity * 25 AS {o.MONEY}) AS qty_in_kg": f"CAST({back} l_quantity * 25 AS {o.MONEY}) AS qty_in_kg",
        # Leading zeros go, also from a code of nothing else.
        "CAST(o_custkey AS VARCHAR) AS customer_code, CAST(l_partkey AS VARCHAR) AS material_code":
        "ltrim(CAST(o_custkey AS VARCHAR), '0') AS customer_code, ltrim(CAST(l_partkey AS VARCHAR), '0') AS material_code",
        "billing_type = 'ZREM'": "billing_type IN ('ZREM', 'RE')",
    }
    for clean, spoiled in swaps.items():
        if clean not in sql:
            raise ValueError(f"the clean report does not say {clean}")
        sql = sql.replace(clean, spoiled)
    return sql


def spanning_windows() -> dict[str, tuple[str, str]]:
    """Windows that end on the current day, and year totals by fiscal-year label."""
    label = f"OVER (PARTITION BY {', '.join(REGISTER_KEYS)}, {o.fy('m')})"
    latest = f"max({o.FY_END}) {label}"
    return o.WINDOWS | {
        "LYMTD": (o.shift("m", -12), o.as_of_end(12)),
        "L1MTD": (o.shift("m", -1), o.as_of_end(1)),
        "L2MTD": (o.shift("m", -2), o.as_of_end(2)),
        "YTD": (o.fy_start("m"), latest),
        "LYTD": (o.shift(o.fy_start("m"), -12), o.shift(f"({latest})", -12)),
    }


REGISTER_KEYS = ("customer_code", "material_code")


def sales_register(windows: Mapping[str, tuple[str, str]] = o.WINDOWS) -> str:
    keys = REGISTER_KEYS
    columns = {
        c: c
        for c in ("customer_group", "customer_code", "material_code", "item_category",
                  "material_description", "UoM", "customer_name", "region", "state_code",
                  "district", "zone", "business_segment", "customer_group_description")
    }
    columns["region"] = "coalesce(region, '')"
    columns["business_segment"] = "coalesce(business_segment, 'None')"
    columns["exception_key"] = "concat_ws('_', customer_code, material_code)"
    from_part = {
        "product_category": "lower(p_type)",
        "product_brand": "brand",
        "brand_flavour": o.initcap("p_name"),
        "mrp": "CAST(p_size AS VARCHAR)",
        "pack_size": "CAST(p_size AS VARCHAR) || 'g'",
        "pack_format": "'pack'",
        "mrp_cb": "CAST(p_size * 12 AS VARCHAR)",
        "no_of_bisc_pk": "'8'",
        "secondary_pack_qty": "'24'",
        "secondary_pkt_type": "'box'",
        "material_group": "p_type",
    }
    columns |= {
        name: sql if name == "product_brand" else f"CASE WHEN p_partkey IS NOT NULL THEN {sql} END"
        for name, sql in from_part.items()
    }
    for role, code in (("zsm", "e5"), ("rsm", "e3"), ("asm", "e2"), ("so", "e1")):
        columns[role] = f"'{role.capitalize()} ' || level"
        columns[f"{role}_emp_code"] = f"'{code} ' || level"
        columns[f"{role}_email"] = f"'{role}@ ' || level"
    columns["town_villa"] = "town_village"
    columns["mrp_group"] = o.price_case("p_size")
    columns["trade"] = o.trade("customer_group")
    columns |= {
        c: "''"
        for c in ("brand_billed", "distributors", "distributors_category", "customer_budget",
                  "focus_brand", "state_name")
    }
    columns["type"] = (
        "CASE WHEN lower(coalesce(region, '') || brand) IN (SELECT key FROM focus) "
        "THEN 'Growth Driver Brand' ELSE 'Others' END"
    )
    columns["80_20 rule"] = (
        f"CASE WHEN {o.dbl('upto')} / {o.dbl('whole')} * 100 <= 80 THEN '80' ELSE '20' END"
    )
    columns["billing_month"] = o.day_text("m")
    columns["brand_billing_amount"] = o.dbl("brand_total")
    columns["contribution"] = f"{o.dbl('brand_total')} / {o.dbl('(SELECT sum(total) FROM by_brand)')} * 100"
    for s in o.VALUES:
        for p in ("MTD", "LYMTD", "LM", "LMMTD", "L2M", "L2MMTD", "YTD", "LYTD"):
            columns[p + s] = o.dbl(p + s)
        columns[f"MTD_per_day{s}"] = f"{o.dbl(f'MTD{s}')} / ({o.LAPSED})"
    for name, (a, b) in o.GROWTH.items():
        columns[name] = f"CASE WHEN {b} <> 0 THEN ({o.dbl(a)} - {o.dbl(b)}) / {o.dbl(b)} END"
    days = {
        "LY_first_date_month": windows["LYMTD"][0],
        "LY_end_date": windows["LYMTD"][1],
        "L1MTD_first_date_month": windows["L1MTD"][0],
        "L1MTD_end_date": windows["L1MTD"][1],
        "L2MTD_first_date_month": windows["L2MTD"][0],
        "L2MTD_end_date": windows["L2MTD"][1],
        "LM_first_date_month": windows["LM"][0],
        "LM_end_date": windows["LM"][1],
        "LMTD_first_date_month": windows["LMMTD"][0],
        "LMTD_end_date": windows["LMMTD"][1],
        "L2M_AVG_first_date_month": windows["L2M"][0],
        "L2M_AVG_end_date": windows["L2M"][1],
        "current_fy_start": windows["YTD"][0],
        "current_fy_end": o.WINDOWS["YTD"][1],
        "last_fy_start": windows["LYTD"][0],
        "last_fy_end": o.WINDOWS["LYTD"][1],
    }
    columns |= {c: o.day_text(f"CAST({sql} AS DATE)") for c, sql in days.items()}
    columns["current_date"] = f"'{AS_OF}'"
    columns["day_lapsed"] = f"CAST({o.LAPSED} AS BIGINT)"
    columns |= {
        "damage_value": o.dbl("damage_value"),
        "damage_doc_count": "damage_doc_count",
        "average_billing_amount": "average_billing_amount",
    }
    ordered = {c: columns[c] for c in REGISTER_COLUMNS}
    same = "IS NOT DISTINCT FROM"
    return f"""
WITH {SOLD}, {o.FOCUS},
{o.period_ctes('sold', keys, windows)},
profile AS (
  SELECT customer_code, material_code,
         sum(CASE WHEN billing_type = 'ZREM' THEN billing_amount ELSE 0 END) AS damage_value,
         CAST(count(*) FILTER (billing_type = 'ZREM') AS BIGINT) AS damage_doc_count,
         {o.dbl('sum(billing_amount)')} / nullif(count(billing_amount), 0) AS average_billing_amount
  FROM sold GROUP BY ALL
),
by_year AS (
  SELECT {o.fy('billing_date')} AS y, coalesce(p_brand, '') AS brand, sum(billing_amount) AS total
  FROM sold LEFT JOIN mats USING (material_code) GROUP BY ALL
),
ranked AS (
  SELECT y, brand, sum(total) OVER (PARTITION BY y ORDER BY total DESC NULLS LAST) AS upto,
         sum(total) OVER (PARTITION BY y) AS whole
  FROM by_year
),
by_brand AS (SELECT brand, sum(total) AS total FROM by_year GROUP BY ALL),
grain AS (
  SELECT DISTINCT customer_group, customer_group_description, customer_code, material_code,
         item_category, material_description, "UoM", {o.month('billing_date')} AS m
  FROM sold WHERE {o.month('billing_date')} BETWEEN DATE '{FLOOR}' AND {o.TODAY}
),
wide AS (
  SELECT g.*, mats.* EXCLUDE (material_code, segment), coalesce(p_brand, '') AS brand,
         custs.* EXCLUDE (customer_code, state_name), level,
         x.* EXCLUDE (customer_code, material_code, m), damage_value, damage_doc_count,
         average_billing_amount
  FROM grain g LEFT JOIN mats USING (material_code) LEFT JOIN custs USING (customer_code)
  LEFT JOIN team USING (customer_code)
  LEFT JOIN measured x ON x.customer_code {same} g.customer_code
    AND x.material_code {same} g.material_code AND x.m = g.m
  LEFT JOIN profile p ON p.customer_code {same} g.customer_code
    AND p.material_code {same} g.material_code
)
SELECT {select(ordered)}
FROM (
  SELECT wide.*, upto, whole, total AS brand_total
  FROM wide LEFT JOIN ranked ON ranked.y = {o.fy('m')} AND ranked.brand = wide.brand
  LEFT JOIN by_brand ON by_brand.brand = wide.brand
)"""


def build() -> dict[str, str]:
    return {
        "material_master": material_master(),
        "sales_force_master": sales_force_master(),
        "deduped_lines": f"""
WITH {SOLD.split("),\nmats AS")[0].replace("SELECT *, " + o.NET, ONCE + o.NET)})
SELECT customer_group, count(plus) AS n, {o.dbl("sum(billing_amount)")} AS amount
FROM sold GROUP BY customer_group""",
        "incremental_daily_sales": f"""
WITH {SOLD.split("),\nmats AS")[0]})
SELECT customer_group, strftime(billing_date, '%Y-%m') AS month, {o.dbl("sum(billing_amount)")} AS amount,
       {o.dbl("sum(qty_in_kg)")} AS kg, count(billing_amount) AS lines,
       count(*) FILTER (billing_type IN ('ZREM', 'RE')) AS return_lines
FROM sold GROUP BY ALL""",
        "customer_master": customer_master(),
        "customer_budget_report": customer_budget(),
        "sales_register": sales_register(),
        "sales_register_spanning": sales_register(spanning_windows()),
        "sales_register_dirty": dirty(sales_register(), keep_sign=True),
        "sales_register_dirty_unsigned": dirty(sales_register(), keep_sign=False),
        "customer_master_all": customer_master(o.EVERY_MONTH),
    }
