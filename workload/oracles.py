"""The SQL twin of each registered query, for DuckDB on the same tables.

The period measures are written as range self-joins of anchors and bills, a form
independent of the one the operators use.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from tallyfold.fixed_values import REPORTED_GROUPS, STATES
from workload.inputs import AS_OF, FLOOR, GROUP_OF_PRIORITY, GROUP_OF_SEGMENT

TODAY = f"DATE '{AS_OF}'"
CURRENT = f"DATE '{AS_OF.replace(day=1)}'"
START = f"DATE '{FLOOR}'"
MONEY = "DECIMAL(18,2)"


def case(column: str, codes: Mapping[str, str], other: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{value}' THEN '{code}'" for value, code in codes.items())
    return f"CASE {column} {arms} ELSE {other} END"


def codes(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def shift(d: str, months: int) -> str:
    return f"CAST({d} + INTERVAL ({months}) MONTH AS DATE)"


def fy(d: str) -> str:
    return f"(year({d}) - CASE WHEN month({d}) < 4 THEN 1 ELSE 0 END)"


def fy_start(d: str) -> str:
    return f"make_date({fy(d)}, 4, 1)"


def month(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def day_text(d: str) -> str:
    return f"strftime({d}, '%Y-%m-%d')"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def initcap(c: str) -> str:
    words = f"string_split(lower({c}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


NET = f"CAST(CAST(l_extendedprice AS {MONEY}) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS {MONEY})"

LINES = f"""
net_lines AS (
  SELECT *, {NET} AS net FROM lineitem
),
tax_lines AS (
  SELECT *, CAST(net * CAST(l_tax AS DECIMAL(4,2)) AS {MONEY}) AS tax FROM net_lines
),
lines AS (
  SELECT l_orderkey AS billing_document, l_linenumber AS billing_item, l_partkey AS material_code,
         l_returnflag AS billing_type, net AS net_value, tax AS tax_amount,
         CAST(net + tax AS {MONEY}) AS billing_amount, CAST(l_quantity AS {MONEY}) AS billed_quantity
  FROM tax_lines
),
headers AS (
  SELECT o_orderkey AS billing_document, o_custkey AS customer_code,
         CAST(o_orderdate AS DATE) AS billing_date,
         {case('o_orderpriority', GROUP_OF_PRIORITY)} AS customer_group
  FROM orders
)"""

BILLS = (
    LINES
    + f""",
bills AS (
  SELECT l.*, h.customer_code, h.billing_date, h.customer_group, p.p_brand AS product_brand,
         p.p_type AS business_segment, CAST(l.billed_quantity * p.p_size AS {MONEY}) AS qty_in_kg
  FROM lines l JOIN headers h USING (billing_document) JOIN part p ON p.p_partkey = l.material_code
)"""
)

STATE_BILLS = (
    BILLS
    + """,
state_bills AS (
  SELECT b.*, n.n_name AS state, r.r_name AS region
  FROM bills b JOIN customer c ON c.c_custkey = b.customer_code
  JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
)"""
)

ORACLES: dict[str, str] = {}

ORACLES["clean_keys"] = f"""
SELECT regexp_replace(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), '^0+', '') AS customer_code,
       regexp_replace(trim(c_name), '^0+', '') AS customer_name,
       regexp_replace(CAST(CAST(c_acctbal AS {MONEY}) AS VARCHAR), '^0+', '') AS balance
FROM customer"""

ORACLES["clean_key_only"] = """
SELECT CASE WHEN p_partkey = 0 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS material_code,
       lpad(CAST(p_size AS VARCHAR), 4, '0') AS pack_size
FROM part"""

ORACLES["proper_case_names"] = (
    f"SELECT p_partkey, {initcap('p_name')} AS p_name, {initcap('p_type')} AS p_type FROM part"
)

ORACLES["clean_decimals"] = f"""
SELECT c_custkey, {dbl(f'CAST(c_acctbal AS {MONEY})')} AS signed,
       abs({dbl(f'CAST(c_acctbal AS {MONEY})')}) AS unsigned
FROM customer"""

ORACLES["clean_decimals_wide"] = f"""
SELECT c_nationkey::BIGINT AS c_nationkey, CAST(sum(CAST(
  CAST(c_custkey AS VARCHAR) || '0000000000000' || CAST(abs(CAST(c_acctbal AS {MONEY})) AS VARCHAR)
  AS DECIMAL(28,2))) AS VARCHAR) AS total
FROM customer GROUP BY 1"""

HOMES = """
customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey"""

ORACLES["normalised_keys"] = f"""
SELECT c_custkey || '_' || c_mktsegment AS exception_key, lower(r_name || c_mktsegment) AS key
FROM {HOMES}"""

ORACLES["projected_columns"] = """
SELECT s_suppkey AS plant, CAST(s_nationkey AS BIGINT) AS mrp_cb, '' AS distributor,
       s_name AS town_villa
FROM supplier"""

ORACLES["null_fill"] = """
SELECT p_partkey, CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) ELSE '0' END AS mrp,
       CASE WHEN p_type <> 'PROMO' THEN p_type ELSE 'None' END AS segment
FROM part"""

ORACLES["row_arithmetic"] = f"""
WITH {LINES}
SELECT billing_document, CAST(billing_item AS BIGINT) AS billing_item, material_code,
       {dbl('net_value')} AS net_value, {dbl('tax_amount')} AS tax_amount,
       {dbl('net_value + tax_amount')} AS amount, {dbl('-net_value')} AS negated,
       CASE WHEN tax_amount <> 0 THEN {dbl('net_value')} / {dbl('tax_amount')} END AS net_per_tax,
       {dbl('net_value')} / 100000 AS lakhs
FROM lines"""


def price_case(x: str) -> str:
    arms = " ".join(
        f"WHEN {x} BETWEEN {low} AND {low + 9} THEN '{low}-{low + 9}'" for low in range(11, 200, 10)
    )
    return (
        f"CASE WHEN {x} = 5 THEN '5' WHEN {x} = 10 THEN '10' {arms} WHEN {x} > 200 THEN '>200' "
        "ELSE 'NA' END"
    )


ORACLES["price_bucket"] = f"""
WITH q AS (
  SELECT l_quantity AS a, l_quantity * 10 AS b, floor(l_quantity / 2) AS c, l_quantity / 2 AS d
  FROM lineitem
)
SELECT {price_case('a')} AS by_quantity, {price_case('b')} AS by_tens,
       {price_case('c')} AS by_half, {price_case('d')} AS by_half_exact, count(*) AS n
FROM q GROUP BY ALL"""

AGE = """CASE WHEN days BETWEEN 0 AND 30 THEN '0-30_days' WHEN days BETWEEN 31 AND 45 THEN '31-45_days'
       WHEN days BETWEEN 46 AND 60 THEN '46-60_days' WHEN days BETWEEN 61 AND 75 THEN '61-75_days'
       WHEN days BETWEEN 76 AND 90 THEN '76-90_days' WHEN days BETWEEN 91 AND 120 THEN '91-120_days'
       WHEN days > 120 THEN 'More than 120 days' ELSE 'Not Applicable' END"""

ORACLES["age_bucket"] = f"""
WITH d AS (SELECT CAST({TODAY} - CAST(o_orderdate AS DATE) AS BIGINT) AS days FROM orders)
SELECT {AGE} AS bucket, count(*) AS n, min(days) AS low, max(days) AS high FROM d GROUP BY ALL"""


def trade(c: str) -> str:
    return f"""CASE WHEN {c} IN ('DL','MD','MS','SS','RL','CP') THEN 'General Trade(GT)'
       WHEN {c} IN ('MT','EC') THEN 'Modern Trade(MT)' WHEN {c} IN ('DE','EX') THEN 'Export(EX)'
       WHEN {c} = 'PL' THEN 'PL' ELSE 'Others(OT)' END"""


ORACLES["trade_channel"] = f"""
WITH {LINES}
SELECT customer_group, {trade('customer_group')} AS trade, count(*) AS n
FROM headers WHERE customer_group IN ({codes(REPORTED_GROUPS)}) GROUP BY ALL"""

ORACLES["merged_segment"] = """
SELECT p_partkey,
       CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'SMALL & MEDIUM' ELSE p_type END AS new_segment
FROM part"""

ORACLES["status_flags"] = """
SELECT p_partkey,
       CASE WHEN p_type LIKE '%M%' THEN 'deleted' ELSE 'not deleted' END AS deletion_indicator,
       CASE WHEN p_size = 1 THEN 'blocked' ELSE 'unblocked' END AS block_status,
       'unblocked' AS no_code
FROM part"""

ORACLES["signed_amounts"] = f"""
WITH {LINES}
SELECT billing_type,
       {dbl("sum(CASE WHEN billing_type = 'R' THEN -billing_amount ELSE billing_amount END)")} AS signed,
       {dbl("sum(CASE WHEN billing_type = 'R' THEN billing_amount ELSE 0 END)")} AS returned,
       CAST(count(*) FILTER (billing_type = 'R') AS BIGINT) AS return_lines
FROM lines GROUP BY billing_type"""

ORACLES["date_range_filter"] = f"""
WITH {LINES}
SELECT billing_document, {day_text('billing_date')} AS billing_date, customer_group
FROM headers WHERE billing_date BETWEEN {START} AND {TODAY}"""

ORACLES["first_known_column"] = """
SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name ELSE p_type END AS label FROM part"""

STATE_VALUES = ", ".join(f"('{a}', '{b}')" for a, b in STATES)

ORACLES["dim_lookup_state"] = f"""
SELECT c_custkey, CAST(c_nationkey + 1 AS VARCHAR) AS state_code, s.state_name
FROM customer LEFT JOIN (VALUES {STATE_VALUES}) s(state_code, state_name)
  ON s.state_code = CAST(c_nationkey + 1 AS VARCHAR)"""

ORACLES["enriched_lines"] = f"""
WITH {BILLS}
SELECT product_brand, c_mktsegment AS market, {dbl('sum(billing_amount)')} AS amount, count(*) AS n
FROM bills JOIN customer ON c_custkey = customer_code GROUP BY ALL"""

ORACLES["left_join_on_keys"] = """
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal, n_name,
       CAST(n_regionkey AS BIGINT) AS n_regionkey, r_name
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey"""

ORACLES["billing_fact"] = f"""
WITH {LINES}
SELECT h.billing_document, customer_code, {day_text('billing_date')} AS billing_date,
       CAST(billing_item AS BIGINT) AS billing_item, material_code,
       {dbl('billing_amount')} AS billing_amount
FROM headers h LEFT JOIN lines l ON l.billing_document = h.billing_document
WHERE customer_group IN ({codes(REPORTED_GROUPS)})"""

ORACLES["bucketed_fact"] = ORACLES["billing_fact"]

ORACLES["unique_dim"] = f"""
WITH {LINES},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY customer_code ORDER BY billing_date DESC, billing_document) AS rank
  FROM headers
)
SELECT c_custkey AS customer_code, c_name, {day_text('billing_date')} AS billing_date, billing_document
FROM customer LEFT JOIN ranked ON customer_code = c_custkey AND rank = 1"""

ORACLES["global_share"] = f"""
WITH s AS (
  SELECT o_custkey, sum(CAST(o_totalprice AS {MONEY})) AS sales FROM orders GROUP BY o_custkey
)
SELECT o_custkey, {dbl('sales')} AS sales, {dbl('(SELECT sum(sales) FROM s)')} AS total,
       {dbl('sales')} / {dbl('(SELECT sum(sales) FROM s)')} AS share
FROM s"""

ORACLES["fiscal_brand_totals"] = f"""
WITH {BILLS}
SELECT {fy('billing_date')} AS fiscal_year, product_brand, {dbl('sum(billing_amount)')} AS total
FROM bills GROUP BY ALL"""

ORACLES["group_totals"] = f"""
WITH b AS (
  SELECT o_orderkey, o_custkey, CAST(o_totalprice AS {MONEY}) AS price, o_orderstatus,
         {month('o_orderdate')} AS m
  FROM orders
),
t AS (
  SELECT o_custkey, {dbl('sum(price)')} AS customer_total, {dbl('max(price)')} AS largest,
         {dbl('sum(price)')} / count(price) AS average,
         CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS open_bills
  FROM b GROUP BY o_custkey
),
d AS (
  SELECT o_custkey, string_agg(strftime(m, '%b-%y'), ',' ORDER BY m) AS months
  FROM (SELECT DISTINCT o_custkey, m FROM b) GROUP BY o_custkey
)
SELECT o_orderkey, b.o_custkey, {dbl('price')} AS price, o_orderstatus, customer_total, largest,
       average, open_bills, months
FROM b JOIN t USING (o_custkey) JOIN d USING (o_custkey)"""

ORACLES["distinct_keys"] = """
SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem"""

ORACLES["distinct_lines"] = "SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem"

ORACLES["returns_profile"] = f"""
WITH {BILLS}
SELECT customer_code, product_brand,
       {dbl("sum(CASE WHEN billing_type = 'R' THEN billing_amount ELSE 0 END)")} AS damage_value,
       CAST(count(*) FILTER (billing_type = 'R') AS BIGINT) AS damage_doc_count,
       {dbl('sum(billing_amount)')} / count(*) AS average_billing_amount
FROM bills GROUP BY ALL"""

ORACLES["last_billed"] = f"""
WITH {LINES}
SELECT customer_code, {day_text('max(billing_date)')} AS last_billed FROM headers GROUP BY ALL"""

ORACLES["brand_contribution"] = f"""
WITH {BILLS},
t AS (SELECT product_brand, sum(billing_amount) AS total FROM bills GROUP BY ALL)
SELECT product_brand, {dbl('total')} AS group_total,
       {dbl('total')} / {dbl('(SELECT sum(total) FROM t)')} * 100 AS contribution
FROM t"""

ORACLES["cumulative_by_year"] = f"""
WITH {BILLS},
t AS (
  SELECT {fy('billing_date')} AS fiscal_year, customer_code,
         CAST(floor(sum(billing_amount) / 1000) AS BIGINT) AS total
  FROM bills GROUP BY ALL
)
SELECT fiscal_year, customer_code, total,
       CAST(sum(total) OVER (PARTITION BY fiscal_year ORDER BY total DESC) AS BIGINT) AS cumulative,
       CAST(sum(total) OVER (PARTITION BY fiscal_year) AS BIGINT) AS year_total
FROM t"""

ORACLES["running_sum_rows"] = f"""
WITH {BILLS}
SELECT business_segment, {day_text('billing_date')} AS billing_date, billing_document,
       CAST(billing_item AS BIGINT) AS billing_item, material_code,
       {dbl('billing_amount')} AS billing_amount,
       {dbl('''sum(billing_amount) OVER (PARTITION BY business_segment ORDER BY billing_date,
         billing_document, billing_item, material_code, billing_amount
         ROWS UNBOUNDED PRECEDING)''')} AS running
FROM bills"""

def pareto_sql(by: str) -> str:
    return f"""
WITH {BILLS},
t AS (
  SELECT {fy('billing_date')} AS fiscal_year, {by}, sum(billing_amount) AS total
  FROM bills GROUP BY ALL
),
c AS (
  SELECT *, sum(total) OVER (PARTITION BY fiscal_year ORDER BY total DESC) AS upto,
         sum(total) OVER (PARTITION BY fiscal_year) AS whole
  FROM t
)
SELECT fiscal_year, {by}, {dbl('total')} AS total_amount, {dbl('upto')} AS cumulative_sum,
       {dbl('upto')} / {dbl('whole')} * 100 AS cumulative_perc,
       CASE WHEN {dbl('upto')} / {dbl('whole')} * 100 <= 80 THEN '80' ELSE '20' END AS pareto
FROM c"""


ORACLES["pareto_brand_fy"] = pareto_sql("product_brand")
ORACLES["pareto_customer_fy"] = pareto_sql("customer_code")

ORACLES["pareto_line"] = f"""
WITH {BILLS},
c AS (
  SELECT product_brand, billing_amount, billing_document, billing_item, material_code,
         sum(billing_amount) OVER (PARTITION BY product_brand ORDER BY billing_amount DESC,
           billing_document, billing_item, material_code ROWS UNBOUNDED PRECEDING) AS upto,
         sum(billing_amount) OVER () AS whole
  FROM bills
)
SELECT product_brand, {dbl('billing_amount')} AS billing_amount, billing_document,
       CAST(billing_item AS BIGINT) AS billing_item, material_code, {dbl('upto')} AS cumulative_sales,
       {dbl('upto')} / {dbl('whole')} * 100 AS cumulative_percentage,
       CASE WHEN {dbl('upto')} / {dbl('whole')} * 100 <= 80
            THEN '20%_products' ELSE '80%_products' END AS pareto
FROM c"""

FOCUS = """
focus AS (
  SELECT DISTINCT lower(r_name || p_brand) AS key FROM part
  JOIN region ON r_regionkey = CAST(substring(p_brand, 7) AS INT) % 5
)"""

ORACLES["focus_brand_tag"] = f"""
WITH {STATE_BILLS}, {FOCUS},
t AS (
  SELECT region, product_brand, sum(billing_amount) AS total, lower(region || product_brand) AS key
  FROM state_bills GROUP BY ALL
)
SELECT key, region, product_brand, {dbl('total')} AS total,
       CASE WHEN key IN (SELECT key FROM focus) THEN 'Growth Driver Brand' ELSE 'Others' END AS type
FROM t"""


# Period measures: for each anchor month m the first and last day of the window.

M_END = "last_day(m)"
NEW_END = f"least({TODAY}, last_day(m))"
FY_END = f"CASE WHEN m = {CURRENT} THEN {TODAY} ELSE last_day(m) END"


def to_date_end(n: int) -> str:
    return (
        f"CASE WHEN m = {CURRENT} THEN {shift(TODAY, -n)} "
        f"ELSE last_day({shift(NEW_END, -n)}) END"
    )


def as_of_end(n: int) -> str:
    return f"CASE WHEN m = {CURRENT} THEN {TODAY} ELSE last_day({shift(NEW_END, -n)}) END"


def snapped(d: str, n: int) -> str:
    return f"CASE WHEN {d} = last_day({d}) THEN last_day({shift(d, -n)}) ELSE {shift(d, -n)} END"


WINDOWS = {
    "MTD": ("m", NEW_END),
    "LYMTD": (shift("m", -12), shift(NEW_END, -12)),
    "L1MTD": (shift("m", -1), to_date_end(1)),
    "L2MTD": (shift("m", -2), to_date_end(2)),
    "LM": (shift("m", -1), f"last_day({shift('m', -1)})"),
    "LMMTD": (shift("m", -1), shift(NEW_END, -1)),
    "L2M": (shift("m", -2), f"last_day({shift('m', -1)})"),
    "YTD": (fy_start("m"), FY_END),
    "LYTD": (shift(fy_start("m"), -12), shift(f"({FY_END})", -12)),
}
VALUES = {"": "billing_amount", "_MT": "qty_in_kg", "_CB": "billed_quantity"}


def period_ctes(
    source: str, keys: Sequence[str], windows: Mapping[str, tuple[str, str]], values=VALUES
) -> str:
    """CTE `measured`: one row per key and month with exact decimal sums."""
    k = ", ".join(keys)
    same = " AND ".join(f"a.{x} IS NOT DISTINCT FROM b.{x}" for x in keys)
    sums = ", ".join(f"sum({c}) AS {c}" for c in values.values())
    ctes = [
        f"daily AS (SELECT {k}, billing_date, {sums} FROM {source} GROUP BY {k}, billing_date)",
        f"anchors AS (SELECT DISTINCT {k}, {month('billing_date')} AS m FROM daily)",
    ]
    columns, joins = [], []
    for name, (first, last) in windows.items():
        totals = ", ".join(f"sum(b.{c}) AS {c}" for c in values.values())
        ctes.append(
            f"w_{name} AS (SELECT {', '.join('a.' + x for x in keys)}, a.m, {totals} "
            f"FROM (SELECT *, {first} AS lo, {last} AS hi FROM anchors) a "
            f"JOIN daily b ON {same} AND b.billing_date BETWEEN a.lo AND a.hi GROUP BY ALL)"
        )
        match = " AND ".join(f"a.{x} IS NOT DISTINCT FROM w_{name}.{x}" for x in keys)
        joins.append(f"LEFT JOIN w_{name} ON {match} AND a.m = w_{name}.m")
        columns += [
            f"CAST(coalesce(w_{name}.{c}, 0) AS DECIMAL(28,2)) AS {name}{s}"
            for s, c in values.items()
        ]
    picked = ", ".join([f"a.{x}" for x in keys] + ["a.m"] + columns)
    ctes.append(f"sums AS (SELECT {picked} FROM anchors a {' '.join(joins)})")
    half = "CAST(0.5 AS DECIMAL(2,1))"
    halves = [
        f"CAST(round(L2M{s} * {half}, 2) AS DECIMAL(28,2)) AS L2M{s}" for s in values if "L2M" in windows
    ]
    replaced = f"REPLACE ({', '.join(halves)})" if halves else ""
    extra = ""
    if "L1MTD" in windows:
        extra = "".join(
            f", CAST(round((L1MTD{s} + L2MTD{s}) * {half}, 2) AS DECIMAL(28,2)) AS L2MMTD{s}"
            for s in values
        )
    ctes.append(f"measured AS (SELECT * {replaced}{extra} FROM sums)")
    return ",\n".join(ctes)


def period_query(source_ctes, source, keys, windows, shown, where="") -> str:
    columns = ", ".join(f"{dbl(p + s)} AS {p}{s}" for s in VALUES for p in shown)
    return f"""WITH {source_ctes},
{period_ctes(source, keys, windows)}
SELECT {', '.join(keys)}, {day_text('m')} AS billing_month, {columns} FROM measured {where}"""


SERIES = ("customer_code", "product_brand")
DENSE = ("state", "product_brand")


def series_query(*names: str, **changed: tuple[str, str]) -> str:
    windows = {n: (WINDOWS | changed)[n] for n in names}
    return period_query(BILLS, "bills", SERIES, windows, names)


ORACLES["window_join"] = f"""
WITH {BILLS},
daily AS (
  SELECT customer_code, billing_date, sum(billing_amount) AS amount FROM bills GROUP BY ALL
)
SELECT a.customer_code, {day_text('a.billing_date')} AS last, {dbl('sum(b.amount)')} AS amount,
       count(*) AS days
FROM daily a JOIN daily b ON a.customer_code = b.customer_code
  AND b.billing_date BETWEEN a.billing_date - 45 AND a.billing_date
GROUP BY ALL"""

ORACLES["mtd"] = series_query("MTD")
ORACLES["mtd_of_repeated_bills"] = period_query(
    f"""{BILLS},
once AS (
  SELECT DISTINCT billing_document, billing_item, material_code, billing_type, billing_date,
         customer_code, product_brand, billing_amount, qty_in_kg, billed_quantity
  FROM bills
)""",
    "once",
    SERIES,
    {"MTD": WINDOWS["MTD"]},
    ["MTD"],
)
ORACLES["lymtd_shifted"] = series_query("LYMTD")
ORACLES["lymtd_asof_end"] = series_query("LYMTD", LYMTD=(shift("m", -12), as_of_end(12)))
ORACLES["l1mtd_l2mtd"] = series_query("L1MTD", "L2MTD")
ORACLES["lm"] = series_query("LM")
ORACLES["lmmtd"] = series_query("LMMTD")
ORACLES["lmmtd_snap"] = series_query("LMMTD", LMMTD=(shift("m", -1), snapped(NEW_END, 1)))
ORACLES["l2m"] = series_query("L2M")
ORACLES["ytd_running"] = series_query("YTD")
ORACLES["lytd_running"] = series_query("LYTD")
ORACLES["l2mmtd"] = period_query(
    BILLS, "bills", SERIES, {n: WINDOWS[n] for n in ("L1MTD", "L2MTD")}, ["L2MMTD"]
)
ORACLES["l1mtd_l2mtd_asof_end"] = period_query(
    BILLS,
    "bills",
    SERIES,
    {"L1MTD": (shift("m", -1), as_of_end(1)), "L2MTD": (shift("m", -2), as_of_end(2))},
    ["L1MTD", "L2MTD", "L2MMTD"],
)

FIRST_SHIFTED, LAST_SHIFTED = WINDOWS["LYMTD"]
ORACLES["lymtd_reuse"] = f"""WITH {BILLS},
{period_ctes('bills', SERIES, {'MTD': WINDOWS['MTD']})},
matched AS (
  SELECT a.*, EXISTS (
    SELECT 1 FROM daily b WHERE b.customer_code = a.customer_code
      AND b.product_brand = a.product_brand
      AND b.billing_date BETWEEN {shift('a.m', -12)}
      AND {shift(f"least({TODAY}, last_day(a.m))", -12)}) AS billed
  FROM anchors a
)
SELECT a.customer_code, a.product_brand, {day_text('a.m')} AS billing_month,
  {', '.join(f"CASE WHEN a.billed THEN {dbl(f'b.MTD{s}')} ELSE 0.0::DOUBLE END AS LYMTD{s}" for s in VALUES)}
FROM matched a LEFT JOIN measured b
  ON a.customer_code = b.customer_code AND a.product_brand = b.product_brand
  AND b.m = {shift('a.m', -12)}"""


def fiscal_label_query(name: str, first: str, last: str) -> str:
    """Year totals through the key's latest window end of the fiscal year."""
    sums = ", ".join(f"sum(b.{c}) AS {c}" for c in VALUES.values())
    shown = ", ".join(f"{dbl(f'coalesce(t.{c}, 0)')} AS {name}{s}" for s, c in VALUES.items())
    days = ", ".join(f"sum({c}) AS {c}" for c in VALUES.values())
    return f"""WITH {BILLS},
daily AS (
  SELECT customer_code, product_brand, billing_date, {days} FROM bills GROUP BY 1, 2, 3
),
anchors AS (
  SELECT customer_code, product_brand, m, {fy('m')} AS y, {first} AS lo, {last} AS hi
  FROM (SELECT DISTINCT customer_code, product_brand, {month('billing_date')} AS m FROM daily)
),
years AS (
  SELECT customer_code, product_brand, y, min(lo) AS lo, max(hi) AS hi FROM anchors GROUP BY 1, 2, 3
),
totals AS (
  SELECT y.customer_code, y.product_brand, y.y, {sums}
  FROM years y JOIN daily b ON b.customer_code = y.customer_code
    AND b.product_brand = y.product_brand AND b.billing_date BETWEEN y.lo AND y.hi
  GROUP BY 1, 2, 3
)
SELECT a.customer_code, a.product_brand, {day_text('a.m')} AS billing_month, {shown}
FROM anchors a LEFT JOIN totals t USING (customer_code, product_brand, y)"""


ORACLES["ytd_fy"] = fiscal_label_query("YTD", *WINDOWS["YTD"])
ORACLES["lytd_fy"] = fiscal_label_query("LYTD", *WINDOWS["LYTD"])

ALL_PERIODS = ("MTD", "LYMTD", "L1MTD", "L2MTD", "L2MMTD", "LM", "LMMTD", "L2M", "YTD", "LYTD")
ORACLES["all_periods_dense"] = period_query(
    STATE_BILLS, "state_bills", DENSE, WINDOWS, ALL_PERIODS, f"WHERE m >= {START}"
)

GROWTH = {}
for _s in VALUES:
    GROWTH[f"growth_percentage_MTD_vs_LYMTD{_s}"] = (f"MTD{_s}", f"LYMTD{_s}")
    GROWTH[f"growth_percentage_MTD_Vs_LMMTD{_s}"] = (f"MTD{_s}", f"LMMTD{_s}")
    GROWTH[f"growth__percentage_MTD_Vs_L2MMTD{_s}"] = (f"MTD{_s}", f"L2MMTD{_s}")
GROWTH["growth_percentage_YTD_vs_LYTD"] = ("YTD", "LYTD")
GROWTH["growth_percentage_YTD_Vs_LYTD_CB"] = ("YTD_CB", "LYTD_CB")
GROWTH["growth__percentage_YTD_Vs_LYTD_MT"] = ("YTD_MT", "LYTD_MT")


def growth_sql(a: str, b: str, name: str) -> str:
    return f"CASE WHEN {b} <> 0 THEN ({dbl(a)} - {dbl(b)}) / {dbl(b)} END AS {name}"


ORACLES["growth_ratios"] = f"""WITH {STATE_BILLS},
{period_ctes('state_bills', DENSE, WINDOWS)}
SELECT state, product_brand, {day_text('m')} AS billing_month,
  {', '.join(growth_sql(a, b, n) for n, (a, b) in GROWTH.items())}
FROM measured"""

LAPSED = f"CASE WHEN m = {CURRENT} THEN {AS_OF.day} ELSE day(last_day(m)) END"
ORACLES["mtd_per_day"] = f"""WITH {STATE_BILLS},
{period_ctes('state_bills', DENSE, {'MTD': WINDOWS['MTD']})}
SELECT state, product_brand, {day_text('m')} AS billing_month, CAST({LAPSED} AS BIGINT) AS day_lapsed,
  {', '.join(f"{dbl(f'MTD{s}')} AS MTD{s}" for s in VALUES)},
  {', '.join(f"{dbl(f'MTD{s}')} / ({LAPSED}) AS MTD_per_day{s}" for s in VALUES)}
FROM measured"""


# Customers

ORACLES["customer_recency"] = f"""
WITH {LINES},
past AS (SELECT * FROM headers),
last AS (
  SELECT customer_code, max(billing_date) AS last_billed_date FROM past GROUP BY ALL
),
detail AS (
  SELECT p.customer_code, max(customer_group) AS customer_group
  FROM past p JOIN last l ON l.customer_code = p.customer_code AND billing_date = last_billed_date
  GROUP BY ALL
),
sets AS (
  SELECT customer_code, string_agg(strftime(m, '%b-%y'), ',' ORDER BY m) AS billed_months
  FROM (SELECT DISTINCT customer_code, {month('billing_date')} AS m FROM past) GROUP BY ALL
),
aged AS (SELECT *, CAST({TODAY} - last_billed_date AS BIGINT) AS days FROM last)
SELECT customer_code, billed_months, customer_group, {day_text('last_billed_date')} AS last_billed_date,
       '{AS_OF}' AS system_date, days AS unbilled_days, {AGE} AS unbilled_ageing_bucket
FROM aged JOIN detail USING (customer_code) JOIN sets USING (customer_code)"""


def unbilled_sql(fallback: str) -> str:
    return f"""
WITH {LINES},
past AS (SELECT * FROM headers),
elapsed AS (
  SELECT CAST(unnest(generate_series({fy_start(TODAY)}, {CURRENT}, INTERVAL 1 MONTH)) AS DATE) AS m
),
missing AS (
  SELECT c_custkey AS customer_code, string_agg(strftime(m, '%b-%y'), ',' ORDER BY m) AS months
  FROM customer CROSS JOIN elapsed
  WHERE NOT EXISTS (
    SELECT 1 FROM past WHERE past.customer_code = c_custkey AND {month('billing_date')} = m)
  GROUP BY ALL
)
SELECT c_custkey AS customer_code, coalesce(months, {fallback}) AS unbilled_months
FROM customer LEFT JOIN missing ON customer_code = c_custkey"""


EVERY_MONTH = "(SELECT string_agg(strftime(m, '%b-%y'), ',' ORDER BY m) FROM elapsed)"
ORACLES["unbilled_months"] = unbilled_sql("''")
ORACLES["unbilled_months_all"] = unbilled_sql(EVERY_MONTH)


# Budgets

def calendar_sql(columns: str, source: str, months: int) -> str:
    first = fy_start(TODAY)
    last = shift(first, months - 1)
    return f"""
SELECT {columns}, CAST({fy(TODAY)} AS BIGINT) AS "Fiscal_Year", {day_text(first)} AS "Start",
       {day_text(last)} AS "End", {day_text('m')} AS "Month", {day_text('m')} AS "Month_formatted"
FROM {source}, (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 MONTH)) AS m)"""


ORACLES["budget_calendar_12"] = calendar_sql(
    "CAST(p_partkey AS VARCHAR) AS material_code, "
    f"CAST(CAST(p_retailprice AS {MONEY}) AS VARCHAR) AS budget",
    "part",
    12,
)
ORACLES["budget_calendar_13"] = calendar_sql(
    f"s_name AS asm, CAST(CAST(s_acctbal AS {MONEY}) AS VARCHAR) AS budget", "supplier", 13
)

CUT_DAYS = {"1_7th": 7, "1_14th": 14, "1_21th": 21, "1_EOM": 31}


def cut_sums(amount: str = "billing_amount") -> str:
    return ", ".join(
        f"sum(CASE WHEN day(billing_date) <= {d} THEN {amount} ELSE 0 END) AS s_{c}"
        for c, d in CUT_DAYS.items()
    )


def cut_shown() -> str:
    return ", ".join(
        f"{dbl(f's_{c}')} AS achievement_of_sales_till_{c}_of_month" for c in CUT_DAYS
    )


ORACLES["cut_day_sales"] = f"""
WITH {BILLS},
s AS (
  SELECT customer_code, business_segment, {month('billing_date')} AS m, {cut_sums()}
  FROM bills GROUP BY ALL
)
SELECT customer_code, business_segment, {day_text('m')} AS billing_month, {cut_shown()},
       CAST(day(last_day(m)) AS BIGINT) AS montly_days
FROM s"""


def achievement_select(target: str) -> str:
    """Achievement columns over `j`, budget rows with sales and month m."""
    percents = ", ".join(
        f"CASE WHEN {target} <> 0 THEN {dbl(f's_{c}')} / 100000 / {target} END "
        f"AS achievement_percentage_of_sales_till_{c}_of_month"
        for c in CUT_DAYS
    )
    balance = f"({target} - {dbl('s_1_EOM')} / 100000)"
    left = f"(CASE WHEN m = {CURRENT} THEN montly_days - {AS_OF.day} ELSE 1 END)"
    return f"""{cut_shown()}, CAST(montly_days AS BIGINT) AS montly_days,
       {target} / montly_days AS budget_per_day,
       CAST(CASE WHEN m = {CURRENT} THEN {AS_OF.day} ELSE 1 END AS BIGINT) AS current_day,
       CAST({left} AS BIGINT) AS remaining_days, {balance} AS btd,
       CASE WHEN {left} <> 0 THEN {balance} / {left} END AS btd_per_day, {percents}"""


def months_of_year(count: int) -> str:
    first = fy_start(TODAY)
    return (
        f"(SELECT CAST(unnest(generate_series({first}, {shift(first, count - 1)}, INTERVAL 1 MONTH)) "
        "AS DATE) AS m)"
    )


BUDGET_DATES = f"""CAST({fy(TODAY)} AS BIGINT) AS "Fiscal_Year", {day_text(fy_start(TODAY))} AS "Start",
       {day_text(shift(fy_start(TODAY), 11))} AS "End", {day_text('m')} AS "Month",
       {day_text('m')} AS "Month_formatted\""""

ORACLES["budget_achievement"] = f"""
WITH {BILLS},
b AS (
  SELECT c_custkey AS customer_code, segment,
         CAST(CAST(abs(floor(c_acctbal / 1000)) AS BIGINT) AS VARCHAR) AS budget
  FROM customer, (VALUES ('PROMO'), ('SMALL'), ('None')) s(segment)
),
s AS (
  SELECT customer_code, CASE WHEN business_segment = 'LARGE' THEN 'None' ELSE business_segment END
         AS segment, {month('billing_date')} AS m, day(last_day({month('billing_date')})) AS montly_days,
         {cut_sums()}
  FROM bills GROUP BY ALL
),
j AS (
  SELECT b.*, x.m, s.* EXCLUDE (customer_code, segment, m)
  FROM b CROSS JOIN {months_of_year(12)} x
  LEFT JOIN s ON s.customer_code = b.customer_code AND s.segment = b.segment AND s.m = x.m
)
SELECT customer_code, segment, budget AS "Monthly Budget", {BUDGET_DATES},
       {achievement_select(dbl('budget'))}
FROM j"""


# Sources and sinks

ORACLES["roundtrip_parquet"] = f"""
WITH {LINES}
SELECT billing_document, customer_code, {day_text('billing_date')} AS billing_date, customer_group
FROM headers"""

ORACLES["versioned_bills"] = f"""
WITH {LINES},
seen AS (
  SELECT 1 AS version, billing_date FROM headers
  WHERE billing_date < DATE '{FLOOR}' OR customer_group <> 'DL'
  UNION ALL
  SELECT 2, billing_date FROM headers
)
SELECT CAST(version AS BIGINT) AS version, strftime(billing_date, '%Y-%m') AS month, count(*) AS bills
FROM seen GROUP BY ALL"""

ORACLES["ingest_delimited"] = """
SELECT CASE WHEN c_custkey = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS "KUNNR",
       '"' || c_name AS "NAME1", lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS "REGIO"
FROM customer"""

ORACLES["group_text"] = f"""
WITH t AS (
  SELECT DISTINCT {case('o_orderpriority', GROUP_OF_PRIORITY)} AS g, 'Group ' || o_orderpriority AS t
  FROM orders
)
SELECT CAST(c_custkey AS VARCHAR) AS "KUNNR", '1000' AS "VKORG", g2 AS "KDGRP", t AS "KTEXT"
FROM (SELECT *, {case('c_mktsegment', GROUP_OF_SEGMENT)} AS g2 FROM customer) LEFT JOIN t ON g = g2"""

from workload import oracles_reports  # noqa: E402

ORACLES |= oracles_reports.build()
