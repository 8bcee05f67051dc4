"""Flags, code groups, buckets and conditional measures."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_codes(c: Column, codes: Iterable[str]) -> Column:
    return c.isin(list(codes))


def has_elements(array: Column) -> Column:
    """True for a non-null array with at least one element."""
    return F.coalesce(F.size(array) >= 1, F.lit(False))


def regex_flag(c: Column, pattern: str, yes: str, no: str) -> Column:
    return F.when(F.trim(c).rlike(pattern), F.lit(yes)).otherwise(F.lit(no))


def code_flag(c: Column, code: int, yes: str, no: str) -> Column:
    return F.when(c.try_cast("int") == F.lit(code), F.lit(yes)).otherwise(F.lit(no))


def map_codes(c: Column, groups: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """The label of the first group that holds the code."""
    out = F
    for codes, label in groups:
        out = out.when(in_codes(c, codes), F.lit(label))
    return out.otherwise(F.lit(default))


def merge_codes(c: Column, codes: Sequence[str], label: str) -> Column:
    """`label` for the given codes, every other value unchanged."""
    return F.when(F.trim(c).isin(list(codes)), F.lit(label)).otherwise(c)


#: Whole numbers that a look-up of labels spans at most; wider ranges are tested one by one.
MOST_LABELS = 1_000


def bucketize(
    c: Column,
    ranges: Sequence[tuple[int, int, str]],
    *,
    exact: Sequence[int] = (),
    above: tuple[int, str] | None = None,
    default: str = "NA",
    floor: bool = True,
) -> Column:
    """Label of the inclusive range a value falls in.

    Text is read as a number first. With `floor` fractions are cut off before the
    look-up, so 20.5 falls in a range that ends at 20. Values in `exact` are their
    own label; values over ``above[0]`` take ``above[1]``; anything else, nulls
    included, takes `default`.
    """
    number = c.try_cast("double")
    if floor:
        number = F.signum(number) * F.floor(F.abs(number))
        low = min([*exact, *(a for a, _, _ in ranges)])
        high = max([*exact, *(b for _, b, _ in ranges)])
        if high - low < MOST_LABELS:
            # Whole numbers look their label up, so the text is read twice, not once per range.
            labels: list[str | None] = [None] * (high - low + 1)
            for first, last, label in reversed(ranges):
                labels[first - low : last - low + 1] = [label] * (last - first + 1)
            for value in exact:
                labels[value - low] = str(value)
            table = F.array(*[F.lit(x) for x in labels])
            found = F.get(table, F.when(number.between(low, high), number - low).cast("int"))
            over = F.when(number > above[0], F.lit(above[1])) if above is not None else F.lit(None)
            return F.coalesce(found, over, F.lit(default))
    out = F
    for value in exact:
        out = out.when(number == value, F.lit(str(value)))
    for first, last, label in ranges:
        out = out.when(number.between(first, last), F.lit(label))
    if above is not None:
        out = out.when(number > above[0], F.lit(above[1]))
    return out.otherwise(F.lit(default))


def price_bucket(c: Column, *, floor: bool = True) -> Column:
    """5 and 10 stand alone, then tens from 11-20 to 191-200, then >200."""
    tens = [(low, low + 9, f"{low}-{low + 9}") for low in range(11, 200, 10)]
    return bucketize(c, tens, exact=(5, 10), above=(200, ">200"), floor=floor)


def age_bucket(days: Column) -> Column:
    """Ageing label of a day count; null and negative counts are not applicable."""
    edges = [(0, 30), (31, 45), (46, 60), (61, 75), (76, 90), (91, 120)]
    return bucketize(
        days,
        [(low, high, f"{low}-{high}_days") for low, high in edges],
        above=(120, "More than 120 days"),
        default="Not Applicable",
    )


def signed_amount(amount: Column, doc_type: Column, types: Sequence[str]) -> Column:
    """Positive amounts of return and debit documents turn negative."""
    flip = doc_type.isin(list(types)) & (amount > 0)
    return F.when(flip, -amount).otherwise(amount)


def value_if(pred: Column, x: Column) -> Column:
    return F.when(pred, x).otherwise(F.lit(0))


def flag_if(pred: Column) -> Column:
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def first_known(*cols: Column) -> Column:
    return F.coalesce(*cols)
