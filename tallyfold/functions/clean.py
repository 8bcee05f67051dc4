"""Projections and cleaning expressions. Everything stays a built-in Catalyst expression."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
#: Amounts read from text, and sums of them: room for totals of any ledger.
AMOUNT = "decimal(28,2)"
#: What number text is stripped of (fixed value): all but letters, digits, white space, dots.
NUMBER_MARKS = r"[^\sA-Za-z0-9.]"


def quoted(name: str) -> Column:
    """A column by its exact name, even if the name holds dots or slashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def trim_all(df: DataFrame) -> DataFrame:
    return df.select([F.trim(quoted(c)).alias(c) for c in df.columns])


def strip_zeros(df: DataFrame, cols: Iterable[str] | str) -> DataFrame:
    """Remove leading zeros from `cols`, or from every column with ``"all"``.

    A value of only zeros becomes the empty string.
    """
    chosen = set(df.columns) if cols == "all" else set(cols)
    return df.select(
        [
            (F.regexp_replace(quoted(c), "^0+", "") if c in chosen else quoted(c)).alias(c)
            for c in df.columns
        ]
    )


def project(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select the mapping's keys, each under its new name."""
    return df.select([quoted(old).alias(new) for old, new in mapping.items()])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary; entries for absent columns are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def sanitise_names(df: DataFrame, replacements: Mapping[str, str] | None = None) -> DataFrame:
    """Replace characters that relational sinks refuse in column names."""
    swaps = replacements or {"/": "_"}
    renamed = {}
    for name in df.columns:
        clean = name
        for bad, good in swaps.items():
            clean = clean.replace(bad, good)
        if clean != name:
            renamed[name] = clean
    return df.withColumnsRenamed(renamed)


def with_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def move_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """The column `old` under the name `new`, as the last column."""
    rest = [quoted(c) for c in df.columns if c != old]
    return df.select(*rest, quoted(old).alias(new))


def proper_case(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.initcap(quoted(c)) for c in cols})


def fill_null(df: DataFrame, value, cols: Iterable[str]) -> DataFrame:
    """Typed null fill: the value takes the column's type, so a numeric fill
    also works on columns that arrive as text."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(quoted(c), F.lit(value).cast(types[c])) for c in cols})


def clean_decimal(
    c: Column, *, keep_sign: bool = True, default=0, target: str = "decimal(38,2)"
) -> Column:
    """Number text such as ``1,234.50`` or ``5-`` to a decimal.

    Commas and every character outside `NUMBER_MARKS` go. With `keep_sign` a leading or
    trailing minus still makes the value negative; without it the minus is lost like any
    other mark. Text that is no number becomes `default` (``None`` keeps it null). A number
    that `target` can't hold is an error, in ANSI mode and outside it.
    """
    text = F.trim(c.cast("string"))
    # Plain numbers need no pattern; coalesce stops at the first that parses. Few branches
    # matter: they are compiled once per column, and Java leaves large methods slow.
    plain = F.replace(text, F.lit(","), F.lit(""))
    if not keep_sign:
        plain = F.replace(plain, F.lit("-"), F.lit(""))
    bare = F.regexp_replace(text, NUMBER_MARKS, "")
    signed = F.concat(F.when(text.rlike(r"^-|-$"), "-").otherwise(""), bare) if keep_sign else bare
    too_large = F.raise_error(F.concat(F.lit(f"number beyond {target}: "), text)).cast(target)
    is_number = F.abs(bare.try_cast("double")) < float("inf")
    tries = [plain.try_cast(target), signed.try_cast(target), F.when(is_number, too_large)]
    if default is not None:
        tries.append(F.lit(default).cast(target))
    return F.coalesce(*tries)


def composite_key(*cols: str, sep: str = "_") -> Column:
    return F.concat_ws(sep, *[quoted(c) for c in cols])


def match_key(*cols: str) -> Column:
    """Case-insensitive key over several columns; a null part counts as empty."""
    return F.lower(F.concat(*[F.coalesce(quoted(c), F.lit("")) for c in cols]))


def add(a: Column, b: Column) -> Column:
    return a + b


def negate(c: Column) -> Column:
    return -c


def ratio(a: Column, b: Column) -> Column:
    """a / b as double, null when b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def scale(c: Column, divisor: int) -> Column:
    return c.cast("double") / F.lit(float(divisor))


def half(c: Column) -> Column:
    """c / 2 rounded to cents, without leaving decimals."""
    return F.round(c * F.lit(Decimal("0.5")), 2)


def to_units(c: Column, scale: int) -> Column:
    """A decimal as a whole number of its last place, such as cents."""
    return (c * F.lit(10**scale)).cast("bigint")


def from_units(c: Column, scale: int) -> Column:
    return c.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))


def exact_type(df: DataFrame, column: str) -> T.DecimalType:
    """The decimal type that holds a column's values; integers have no places."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return T.DecimalType(20, 0)
    if not isinstance(kind, T.DecimalType):
        raise TypeError(f"exact sums need integers or decimals; {column} is {kind.simpleString()}")
    return kind


def decimal_sum(value: Column, kind: T.DecimalType) -> Column:
    """Sum of values of a decimal type, exact and the same in ANSI mode and outside it.

    Up to 18 digits the units are summed as two bigints, of the low 20 bits and the rest,
    several times faster than wide decimals; they hold totals up to 9.6e24 units. Wider
    types are summed as decimals. A total beyond either is an error.
    """
    scale = kind.scale
    if kind.precision > 18:
        total = F.sum(value.cast(kind))
        if kind.precision <= 28:  # ten digits to spare
            return total.cast(f"decimal(38,{scale})")
        lost = total.isNull() & (F.count(value) > 0)
        return F.when(lost, _overflow(scale)).otherwise(total).cast(f"decimal(38,{scale})")
    units = to_units(value.cast(kind), scale)
    high, low = F.try_sum(F.shiftright(units, 20)), F.try_sum(units.bitwiseAND((1 << 20) - 1))
    whole = (high.cast("decimal(20,0)") * F.lit(Decimal(1 << 20)) + low).cast("decimal(38,0)")
    lost = high.isNull() & low.isNotNull()
    place = F.lit(Decimal(1).scaleb(-scale))
    return F.when(lost, _overflow(scale)).otherwise((whole * place).cast(f"decimal(38,{scale})"))


def _overflow(scale: int) -> Column:
    return F.raise_error(F.lit("a sum is beyond what its decimals hold")).cast(f"decimal(38,{scale})")


def exact_sum(df: DataFrame, column: str, value: Column | None = None) -> Column:
    """Exact sum of an integer or decimal column, or of `value` made from it; see `decimal_sum`."""
    value = quoted(column) if value is None else value
    return decimal_sum(value, exact_type(df, column))
