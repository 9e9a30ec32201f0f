"""Reusable column expressions: rule lists, lookups, exact ratios, geometry."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_RADIUS_KM = 6371.0


def _case(branches: Iterable[tuple[Column, object]], default) -> Column:
    out = None
    for cond, value in branches:
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def first_match(c: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first pattern that matches; null matches none."""
    return _case(((c.rlike(p), label) for p, label in rules), default)


def below_cuts(c: Column, cuts: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first cut point the value is below, else ``top``."""
    return _case(((c < cut, label) for cut, label in cuts), top)


def within_ranges(
    c: Column, ranges: Sequence[tuple[tuple[int, int], str]], default: str
) -> Column:
    """Label of the first closed range that holds the value."""
    return _case(((c.between(lo, hi), label) for (lo, hi), label in ranges), default)


def lookup(c: Column, table: Mapping, default) -> Column:
    """Value for a key of a small fixed table."""
    return _case(((c == k, v) for k, v in table.items()), default)


def lookup_members(c: Column, table: Mapping[str, Sequence], default: str) -> Column:
    """Name of the member list that holds the value."""
    return _case(((c.isin(*members), k) for k, members in table.items()), default)


def flag_sum(flags: Iterable[str]) -> Column:
    """Number of true flags."""
    return reduce(lambda a, b: a + b, (F.col(f).cast("int") for f in flags))


def in_range_or(c: Column, low: float, high: float, default: float) -> Column:
    """The value when it lies in the closed range; null, NaN and the rest give
    the default."""
    return F.when(c.between(low, high), c).otherwise(F.lit(default))


def ratio_half_up(num: Column, den: Column, places: int) -> Column:
    """``num / den`` rounded half up to ``places`` digits, in integers.

    Both sides are non-negative whole numbers. Doubles would round an exact
    half by their binary value, so 1305 / 60000 could give 2.17 % or 2.18 %.
    The sums run in DECIMAL(38,0): num * 2 * 10^places would overflow a long
    long before the count itself does.
    """
    scale = 10**places
    n = num.cast("decimal(20,0)")
    d = den.cast("decimal(20,0)")
    top = n * F.lit(2 * scale) + d
    bottom = d * F.lit(2)
    whole = F.call_function("div", top, bottom).cast("decimal(20,0)")
    return whole * F.lit(Decimal(1).scaleb(-places))


def try_decimal(c: Column, precision: int, scale: int) -> Column:
    """Cast that gives null where the value does not fit."""
    return c.try_cast(T.DecimalType(precision, scale))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds between two local timestamps, free of any time zone.

    Fractions are cut from each side before the difference is taken.
    """
    whole = [F.date_trunc("second", c).cast("timestamp_ntz") for c in (end, start)]
    return (whole[0] - whole[1]).cast("interval second").cast("bigint")


def to_local_timestamp(c: Column) -> Column:
    """Text to a local timestamp.

    The whole pattern counts, ``yyyy-MM-dd HH:mm:ss``, with a fraction of up
    to nine digits or none. Anything else, a part of a date or an offset
    included, is null.
    """
    text = c.cast("string")
    whole = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,9})?$")
    return F.when(whole, text.try_cast("timestamp_ntz"))


def year_text(ts: Column) -> Column:
    """Four-digit year; unlike date_format free of the session time zone."""
    return F.lpad(F.year(ts).cast("string"), 4, "0")


def month_text(ts: Column) -> Column:
    """yyyy-MM."""
    return F.concat(year_text(ts), F.lit("-"), F.lpad(F.month(ts).cast("string"), 2, "0"))


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in kilometres."""
    dlat = F.radians(lat2 - lat1)
    dlng = F.radians(lng2 - lng1)
    half = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(dlng / 2), 2)
    return F.asin(F.sqrt(half)) * F.lit(2 * EARTH_RADIUS_KM)


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the type can hold one."""
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
