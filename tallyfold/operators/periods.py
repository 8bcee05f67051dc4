"""Period-over-period measures on an April fiscal calendar.

Every period window starts on a month start, so it is some whole months plus at
most one month cut at a day that follows from the month and `as_of` alone. Lines
are therefore reduced to one row per (key, month) in a single aggregate that
sums each month whole and up to each cut day. Earlier months are then fetched by
range frames on the month number. The windows hold at most one row per month and
key, however many lines a key has, and no line is joined or repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.functions.clean import decimal_sum, exact_sum, exact_type, half, quoted, ratio
from tallyfold.functions.dates import (
    days_in_month,
    fiscal_start_of,
    fiscal_year,
    in_current_month,
    month_index,
    month_start,
    shift_months,
)
from tallyfold.operators.joins import unique_by

PERIODS = ("MTD", "LYMTD", "L1MTD", "L2MTD", "L2MMTD", "LM", "LMMTD", "L2M", "YTD", "LYTD")

# Month sums each period is built from.
_PARTS = {
    "MTD": {"own"},
    "LYMTD": {"ly"},
    "L1MTD": {"l1"},
    "L2MTD": {"l2"},
    "L2MMTD": {"l1", "l2"},
    "LM": {"whole"},
    "LMMTD": {"lm"},
    "L2M": {"whole"},
    "YTD": {"whole", "own"},
    "LYTD": {"whole", "lytd"},
}


def _cut_tests(day: Column, as_of: dt.date, ly_rule: str, end_rule: str, eom: str) -> dict:
    """For each month sum, which of the month's days count.

    A sum read from n months later is cut at that later month's end date moved
    back n months, where the end date is `as_of` in the current month.
    """
    today = F.lit(as_of)
    current = F.lit(as_of.replace(day=1))

    def cut(n: int, end: Column) -> Column:
        return day <= shift_months(end, -n, eom)

    def end_of_month(n: int) -> Column:
        return F.last_day(F.add_months(month_start(day), n))

    def whole_unless_current(n: int) -> Column:
        later = F.add_months(month_start(day), n)
        return (later < current) | ((later == current) & (day <= shift_months(today, -n, eom)))

    def up_to_current(n: int) -> Column:
        return F.add_months(month_start(day), n) <= current

    tests = {
        "whole": F.lit(True),
        "own": day <= today,
        "ly": cut(12, F.least(today, end_of_month(12))),
        "l1": whole_unless_current(1),
        "l2": whole_unless_current(2),
        "lm": cut(1, F.least(today, end_of_month(1))),
        "lytd": cut(12, F.when(F.add_months(month_start(day), 12) == current, today).otherwise(
            end_of_month(12)
        )),
    }
    if end_rule == "as_of":
        tests["l1"], tests["l2"] = up_to_current(1), up_to_current(2)
    if ly_rule == "as_of":
        tests["ly"] = up_to_current(12)
    return tests


def period_measures(
    bills: DataFrame,
    keys: Sequence[str],
    date: str,
    measures: Mapping[str, str],
    as_of: dt.date,
    periods: Sequence[str] = PERIODS,
    *,
    end_rule: str = "shifted",
    ly_rule: str | None = None,
    eom: str = "clamp",
    running: bool = True,
    floor: dt.date | None = None,
    line_key: Sequence[str] = (),
) -> DataFrame:
    """One row per key and billed month with every asked-for period and measure.

    bills     lines or any pre-aggregate of them that keeps the bill date
    measures  suffix -> integer or decimal column; period columns are named period +
              suffix. Sums are exact, see `decimal_sum`
    end_rule  where LYMTD, L1MTD and L2MTD end for the current month: 'shifted' on
              the same day of the earlier month, 'as_of' on `as_of` itself, which
              spans all months in between
    ly_rule   `end_rule` for LYMTD alone; also 'reuse', which takes last year's
              whole MTD value if a bill falls in the shifted window
    eom       'clamp' or 'snap', see `shift_months`
    running   YTD and LYTD through each month; otherwise through the key's latest
              month of the fiscal year, the same for all its months
    floor     first reported month; older bills are read only as far as needed
    line_key  columns that tell bills apart; of bills equal in them one counts

    All bills after `as_of` in the current month count in no to-date measure.
    Null measures count as zero.
    """
    ly_rule = ly_rule or end_rule
    if end_rule not in ("shifted", "as_of") or ly_rule not in ("shifted", "as_of", "reuse"):
        raise ValueError(f"unknown end rule {end_rule!r} / {ly_rule!r}")
    unknown = set(periods) - set(PERIODS)
    if unknown:
        raise ValueError(f"unknown periods {sorted(unknown)}")

    if floor is not None:
        first_used = fiscal_start_of(floor)
        bills = bills.filter(F.col(date) >= F.lit(first_used.replace(year=first_used.year - 1)))

    if line_key:
        bills = unique_by(bills, line_key)
    kinds = {s: exact_type(bills, c) for s, c in measures.items()}
    needed = set().union(*[_PARTS[p] for p in periods])
    # To `as_of`, a month counts for a later one whole or not at all: no sum of its own.
    by_month_alone = {"l1", "l2"} & needed if end_rule == "as_of" else set()
    if "LYMTD" in periods and ly_rule != "shifted":
        needed |= {"whole", "own"} if ly_rule == "as_of" else {"own", "ly"}
    if by_month_alone:
        needed |= {"whole", "own"}

    tests = _cut_tests(F.col(date), as_of, ly_rule, end_rule, eom)
    sums = []
    for part in sorted(needed - by_month_alone):
        for suffix, column in measures.items():
            x = quoted(column)
            kept = x if part == "whole" else F.when(tests[part], x)
            total = decimal_sum(kept, kinds[suffix])
            zero = F.lit(0).cast(f"decimal(38,{kinds[suffix].scale})")
            sums.append(F.coalesce(total, zero).alias(f"__{part}{suffix}"))
    if "LYMTD" in periods and ly_rule == "reuse":
        sums.append(F.max(tests["ly"].cast("int")).alias("__ly_billed"))
    months = bills.groupBy(
        *[quoted(k) for k in keys], month_start(F.col(date)).alias("billing_month")
    ).agg(*sums)

    month = F.col("billing_month")
    is_current = in_current_month(month, as_of)
    ordered = months.withColumns({"__month": month_index(month), "__fy": fiscal_year(month)})
    until_current = _cut_tests(month, as_of, ly_rule, end_rule, eom)
    ordered = ordered.withColumns(
        {
            f"__{part}{s}": F.when(until_current[part], F.col(f"__whole{s}")).otherwise(
                F.lit(0).cast(f"decimal(38,{kinds[s].scale})")
            )
            for part in sorted(by_month_alone)
            for s in measures
        }
    )
    by_key = Window.partitionBy(*[quoted(k) for k in keys])
    by_month, by_year = by_key.orderBy("__month"), by_key.orderBy("__fy")

    def back(column: str, first: int, last: int) -> Column:
        """Sum of a column over the months `first` to `last` before this one."""
        frame = by_month.rangeBetween(-first, -last)
        return F.coalesce(F.sum(column).over(frame), F.lit(0))

    def through(column: str, n: int) -> Column:
        """Sum over this fiscal year (moved back n months) before this month."""
        upto = F.sum(column).over(by_month.rangeBetween(Window.unboundedPreceding, -n - 1))
        years = F.sum(column).over(
            by_year.rangeBetween(Window.unboundedPreceding, -1 - n // 12)
        )
        return F.coalesce(upto, F.lit(0)) - F.coalesce(years, F.lit(0))

    def to_as_of(n: int, whole: str, own: str, plain: Column) -> Column:
        return F.when(is_current, back(whole, n, 1) + F.col(own)).otherwise(plain)

    out: dict[str, Column] = {}
    for suffix in measures:
        whole, own = f"__whole{suffix}", f"__own{suffix}"
        values = {}
        for n in (1, 2):
            if f"l{n}" in needed:
                plain = back(f"__l{n}{suffix}", n, n)
                shifted = end_rule == "shifted"
                values[f"L{n}MTD"] = plain if shifted else to_as_of(n, whole, own, plain)
        if "L2MMTD" in periods:
            values["L2MMTD"] = values["L1MTD"] + values["L2MTD"]
        if "MTD" in periods:
            values["MTD"] = F.col(own)
        if "LYMTD" in periods:
            if ly_rule == "reuse":
                billed = F.max("__ly_billed").over(by_month.rangeBetween(-12, -12)) == 1
                values["LYMTD"] = F.when(billed, back(own, 12, 12)).otherwise(F.lit(0))
            else:
                plain = back(f"__ly{suffix}", 12, 12)
                is_shifted = ly_rule == "shifted"
                values["LYMTD"] = plain if is_shifted else to_as_of(12, whole, own, plain)
        if "LM" in periods:
            values["LM"] = back(whole, 1, 1)
        if "LMMTD" in periods:
            values["LMMTD"] = back(f"__lm{suffix}", 1, 1)
        if "L2M" in periods:
            values["L2M"] = back(whole, 2, 1)
        if "YTD" in periods:
            this = F.when(is_current, F.col(own)).otherwise(F.col(whole))
            values["YTD"] = through(whole, 0) + this
        if "LYTD" in periods:
            values["LYTD"] = through(whole, 12) + back(f"__lytd{suffix}", 12, 12)
        out |= {p + suffix: values[p] for p in periods}

    result = ordered.withColumns(out)
    if not running:
        latest = (
            Window.partitionBy(*[quoted(k) for k in keys], "__fy")
            .orderBy("__month")
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        )
        labelled = [p + s for p in ("YTD", "LYTD") if p in periods for s in measures]
        result = result.withColumns({c: F.last(quoted(c)).over(latest) for c in labelled})
    if floor is not None:
        result = result.filter(month >= F.lit(floor.replace(day=1)))
    averages = ("L2MMTD", "L2M")

    def finished(period: str, suffix: str) -> Column:
        value = quoted(period + suffix)
        if period in averages:
            value = half(value)
        elif kinds[suffix].scale > 2:
            value = F.round(value, 2)
        return value.alias(period + suffix)

    return result.select(
        *[quoted(k) for k in keys],
        "billing_month",
        *[finished(p, s) for s in measures for p in periods],
    )


def window_sums(
    anchors: DataFrame,
    bills: DataFrame,
    keys: Sequence[str],
    date: str,
    first: str,
    last: str,
    sums: Mapping[str, str],
    count: str | None = None,
) -> DataFrame:
    """Each anchor with the sums over the bills of its key dated in [first, last].

    `sums` maps new columns to integer or decimal ones of `bills`; `count` names a column
    for the number of bills. No anchor meets a bill: bills are summed to one row per key and
    day, days on which some window begins or ends join them as empty days, and a running sum
    per key tells what lies up to any day. A window is the difference of the sums at its two
    ends, each fetched by one equi-join on key and day, so there are never more rows than
    anchors and days. Per key a task sorts calendar days, however many bills or anchors the
    key has. Anchors without bills, with an empty window or with a null in key or date get 0.
    """
    day = F.col("__day")
    totals = {f"__sum{k}": exact_sum(bills, c) for k, c in enumerate(sums.values())}
    named = [quoted(k) for k in keys]
    daily = bills.groupBy(*named, quoted(date).alias("__day")).agg(
        *[c.alias(n) for n, c in totals.items()], F.count("*").alias("__n")
    )
    start = F.date_sub(quoted(first), 1)
    ends = [anchors.select(*named, c.alias("__day")) for c in (start, quoted(last))]
    points = ends[0].union(ends[1]).distinct().withColumn("__end", F.lit(True))
    both = daily.unionByName(points, allowMissingColumns=True).where(day.isNotNull())
    through = Window.partitionBy(*named).orderBy("__day").rangeBetween(Window.unboundedPreceding, 0)
    columns = [*totals, "__n"]
    sums_upto = [F.coalesce(F.sum(c).over(through), F.lit(0)).alias(c) for c in columns]
    upto = both.select(*named, day, "__end", *sums_upto).where("__end")
    out = anchors
    for side, end in (("a", start), ("b", quoted(last))):
        look = upto.select(
            *named, day.alias(f"__day_{side}"), *[F.col(c).alias(c + side) for c in columns]
        )
        out = out.withColumn(f"__day_{side}", end).join(look, [*keys, f"__day_{side}"], "left")
    whole = quoted(first) <= quoted(last)

    def between(c: str) -> Column:
        kind = "bigint" if c == "__n" else upto.schema[c].dataType
        change = (F.col(c + "b") - F.col(c + "a")).cast(kind)
        return F.coalesce(F.when(whole, change), F.lit(0).cast(kind))

    given = [between(c).alias(n) for c, n in zip(totals, sums)]
    if count:
        given.append(between("__n").alias(count))
    return out.select(*[F.col(f"`{c}`") for c in anchors.columns], *given)


def growth(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Columns (a - b) / b, null where b is zero."""
    return df.withColumns(
        {
            name: F.try_divide(
                quoted(a).cast("double") - quoted(b).cast("double"), quoted(b).cast("double")
            )
            for name, (a, b) in pairs.items()
        }
    )


def per_day(
    df: DataFrame, measures: Mapping[str, str], as_of: dt.date, month: str = "billing_month"
) -> DataFrame:
    """Days lapsed of each month and each measure's daily rate (new name -> measure)."""
    lapsed = F.when(
        in_current_month(F.col(month), as_of), F.lit(as_of.day)
    ).otherwise(days_in_month(F.col(month)))
    with_days = df.withColumn("day_lapsed", lapsed)
    return with_days.withColumns(
        {new: ratio(quoted(m), F.col("day_lapsed")) for new, m in measures.items()}
    )
