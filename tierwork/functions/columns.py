"""Column expressions. All of them stay inside JVM code generation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

MONEY = "decimal(18,2)"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- text ---------------------------------------------------------------------

def blank_to_null(c: str | Column) -> Column:
    """Trim spaces (only spaces: a tab survives) and turn '' into NULL."""
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def clean_text(df: DataFrame) -> DataFrame:
    """Apply :func:`blank_to_null` to every string column in one projection."""
    return df.select(*[
        blank_to_null(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


# ---- typed coercion -----------------------------------------------------------

def coerced(c: str | Column, kind: str) -> Column:
    """Cast that yields NULL for a value that does not parse. Whole numbers may
    be written with a fraction of zeros ('12.0'), as CSV exports often do."""
    value = as_col(c)
    if kind in ("int", "bigint"):
        number = value.try_cast("double")
        return F.coalesce(value.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))
    return value.try_cast(kind)


def coerce_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns in one projection; absent names are ignored."""
    return df.select(*[
        coerced(c, types[c]).alias(c) if c in types and types[c] != "string" else F.col(c)
        for c in df.columns
    ])


# ---- money --------------------------------------------------------------------

def exact_sum(c: str | Column) -> Column:
    """Sum two-decimal amounts exactly: the result does not depend on the order
    in which partial sums are merged. Use ``as_amount`` on the final value."""
    return F.sum(as_col(c).cast(MONEY))


def as_amount(c: str | Column) -> Column:
    return F.round(as_col(c), 2).cast("double")


def money_total(c: str | Column) -> Column:
    return as_amount(exact_sum(c))


def percent(part: str | Column, whole: str | Column) -> Column:
    """Ratio in percent with two decimals; NULL when the whole is zero."""
    return F.round(F.try_divide(as_col(part), as_col(whole)) * 100, 2)


# ---- time ---------------------------------------------------------------------

def calendar_days(start: str | Column, end: str | Column) -> Column:
    """Midnights crossed between two instants."""
    return F.datediff(as_col(end), as_col(start))


def elapsed_days(start: str | Column, end: str | Column) -> Column:
    """Whole 24-hour periods between two instants, rounded down (also below
    zero). Built on calendar arithmetic, hence free of time-zone effects."""
    start, end = as_col(start), as_col(end)
    days = F.datediff(end, start)
    overshoot = F.timestamp_add("DAY", days, start) > end
    return days - overshoot.cast("int")


def date_key(c: str | Column) -> Column:
    """yyyyMMdd as an int."""
    c = as_col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_start(c: str | Column) -> Column:
    return F.trunc(as_col(c), "month")


def next_month(c: str | Column) -> Column:
    return F.add_months(month_start(c), 1)


def month_bounds(month: str) -> tuple[str, str]:
    """First day of 'YYYY-MM' and of the month after it."""
    year, number = (int(x) for x in month.split("-"))
    after = (year + 1, 1) if number == 12 else (year, number + 1)
    return f"{year:04d}-{number:02d}-01", f"{after[0]:04d}-{after[1]:02d}-01"


def in_month(c: str | Column, month: str) -> Column:
    """Half-open range on the bare column, so that the scan can prune on it.
    String bounds take the type of the column, zoned or not."""
    first, after = month_bounds(month)
    return (as_col(c) >= F.lit(first)) & (as_col(c) < F.lit(after))


def up_to_month(c: str | Column, month: str) -> Column:
    return as_col(c) < F.lit(month_bounds(month)[1])


# ---- predicates ---------------------------------------------------------------

def not_in(c: str | Column, values: Iterable) -> Column:
    """NOT IN: a NULL value is dropped as well."""
    return ~as_col(c).isin(*values)


def in_box(lat: str | Column, lng: str | Column, lat_range: tuple, lng_range: tuple) -> Column:
    return as_col(lat).between(*lat_range) & as_col(lng).between(*lng_range)


def outside(c: str | Column, low, high) -> Column:
    """Range violation; NULL is no violation."""
    return (as_col(c) < F.lit(low)) | (as_col(c) > F.lit(high))


def newer_than(c: str | Column, mark) -> Column:
    """Strictly newer than a high-watermark, given as text or as a datetime."""
    c = as_col(c)
    return c > F.lit(mark if isinstance(mark, str) else mark.isoformat(sep=" "))


def is_late(actual: str | Column, promised: str | Column) -> Column:
    return as_col(actual) > as_col(promised)


def is_weekend(c: str | Column) -> Column:
    return F.dayofweek(as_col(c)).isin(1, 7)


def reached(status: str | Column, wanted: str, evidence: str | Column) -> Column:
    """Status says so, or the evidence column is present (three-valued OR)."""
    return (as_col(status) == wanted) | as_col(evidence).isNotNull()


# ---- buckets ------------------------------------------------------------------

def clipped(c: str | Column, low, high) -> Column:
    """Clip to a range; NULL stays NULL."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def bin_number(c: str | Column, low: float, high: float, bins: int) -> Column:
    """Zero-based equal-width bin of a clipped value; the top edge belongs to the
    last bin."""
    position = F.floor((clipped(c, low, high) - low) * bins / (high - low))
    return F.when(position >= bins, bins - 1).otherwise(position).cast("int")
