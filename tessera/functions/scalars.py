"""Scalar rules: ratios that never explode, provenance, symbols and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    """x, but null for NaN and infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def safe_ratio(num: Column, den: Column, most: float = 1e6) -> Column:
    """Null for a zero or infinite denominator, or beyond ``most`` in size; a negative denominator keeps its sign."""
    r = F.try_divide(num, finite(den))
    return F.when(F.abs(r) <= most, r)


def guard(x: Column, floor: float, positive: bool = False) -> Column:
    """x where it is finite and its size (or value, if only positive ones count) is above the floor."""
    return F.when((x if positive else F.abs(x)) > floor, finite(x))


def first_known(*pairs: tuple[Column, str]) -> tuple[Column, Column]:
    """(value, tag): the first value that is known, and the tag of its source."""
    return F.coalesce(*(v for v, _ in pairs)), F.coalesce(*(F.when(v.isNotNull(), F.lit(t)) for v, t in pairs))


def oldest(*operands: tuple[Column, Column]) -> Column:
    """struct(available, place, period_end) of the operand that became available first; nulls never win, ties go to the
    first."""
    parts = [F.struct(a.alias("available"), F.lit(i).alias("place"), e.alias("period_end")) for i, (a, e) in enumerate(operands)]
    return F.array_min(F.filter(F.array(*parts), lambda x: x["available"].isNotNull()))


def business_days(day: Column, n: int) -> Column:
    """n business days (Monday to Friday) from ``day``; a weekend first rolls back to Friday."""
    monday0 = F.weekday(day)
    start = F.date_sub(day, F.greatest(monday0 - 4, F.lit(0)))
    k = F.least(monday0, F.lit(4)) + n
    return F.date_add(start, (F.floor(k / 5) * 7 + F.pmod(k, F.lit(5)) - F.least(monday0, F.lit(4))).cast("int"))


def consensus(strong_buy: Column, buy: Column, hold: Column, sell: Column, strong_sell: Column) -> Column:
    """Mean rating from -2 to 2; null without ratings."""
    return F.try_divide((2 * strong_buy + buy - sell - 2 * strong_sell).cast("double"), strong_buy + buy + hold + sell + strong_sell)


def drift(now: Column, then: Column) -> Column:
    return F.try_divide(now - then, F.abs(then))


def pair_slug(pair: Column) -> Column:
    """BASE/QUOTE as BASE-QUOTE; null if it is not a pair."""
    p = F.upper(F.trim(pair))
    return F.when(p.rlike("^[A-Z0-9]+/[A-Z0-9]+$"), F.translate(p, "/", "-"))


def class_suffix(symbol: Column) -> Column:
    """A one-letter share class after a dot is written after a dash."""
    return F.regexp_replace(symbol, r"\.([A-Z])$", "-$1")


def option_symbol(code: Column) -> Column:
    """struct(root, expiry, kind, strike) of a 21-character option code; null fields where it does not parse."""
    pattern = r"^([A-Z]{1,6})\s*(\d{6})([CP])(\d{8})$"
    part = lambda k: F.nullif(F.regexp_extract(code, pattern, k), F.lit(""))
    return F.struct(part(1).alias("root"), F.to_date(part(2), "yyMMdd").alias("expiry"), part(3).alias("kind"), (part(4).cast("double") / 1000).alias("strike"))
