"""Numeric, text and date expressions with one agreed meaning.

Money is decimal: rows are ``MONEY``, sums are ``TOTAL`` (wide enough for
10^18, so whole-company totals fit), ratios are computed from ``TOTAL``
operands. That keeps at least 14 fractional digits in every quotient, so a
percentage is rounded once and never twice.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(18,4)"
TOTAL = "decimal(20,2)"
TOTAL4 = "decimal(22,4)"
# Raw floats pass through nine fractional digits before they are rounded.
NUMERIC = "decimal(28,9)"
# Unit prices and costs at the same scale, narrow enough to divide exactly.
UNIT = "decimal(20,9)"

# The code points Unicode lists as White_Space.
UNICODE_SPACES = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def dec(value: str) -> Column:
    """Exact decimal literal (a float literal would turn products into doubles)."""
    return F.lit(Decimal(value))


def money(c: Column | str) -> Column:
    return F.round(_col(c).cast(NUMERIC), 2).cast(MONEY)


def rate(c: Column | str) -> Column:
    return F.round(_col(c).cast(NUMERIC), 4).cast(RATE)


def numeric(c: Column | str) -> Column:
    return _col(c).cast(NUMERIC)


def int_round(c: Column | str) -> Column:
    """Float to BIGINT, halves away from zero (a plain cast truncates)."""
    return F.round(_col(c).cast("double")).cast("bigint")


def trim_all(c: Column | str) -> Column:
    """Strip every Unicode space; ``F.trim`` strips U+0020 only."""
    return F.btrim(_col(c), F.lit(UNICODE_SPACES))


def upper_trim(c: Column | str) -> Column:
    return F.upper(trim_all(c))


def year_of(c: Column | str) -> Column:
    return F.year(_col(c)).cast("bigint")


def month_of(c: Column | str) -> Column:
    return F.month(_col(c)).cast("bigint")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "month")


def month_index(c: Column | str, base_year: int) -> Column:
    """Months elapsed since January of ``base_year``."""
    return (F.year(_col(c)) - base_year) * 12 + F.month(_col(c)) - 1


def first_of_month(ano: Column | str, mes: Column | str) -> Column:
    return F.make_date(_col(ano).cast("int"), _col(mes).cast("int"), F.lit(1))


def total(c: Column | str) -> Column:
    """Exact sum of a money column."""
    return F.sum(_col(c)).cast(TOTAL)


def or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0)).cast(TOTAL)


def times(quantity: Column | str, unit_value: Column | str) -> Column:
    return (_col(quantity).cast("decimal(18,0)") * _col(unit_value)).cast(TOTAL)


def pct(part: Column, whole: Column, part_type: str = TOTAL) -> Column:
    """``part / whole * 100`` rounded to two digits; NULL on a zero divisor."""
    quotient = F.try_divide(part.cast(part_type), whole.cast(TOTAL))
    return F.round(quotient * 100, 2).cast(TOTAL)


def ratio(part: Column, whole: Column, digits: int, operand: str = TOTAL) -> Column:
    quotient = F.try_divide(part.cast(operand), whole.cast(operand))
    return F.round(quotient, digits).cast(f"decimal(22,{digits})")


def growth_pct(now: Column, before: Column, absolute_base: bool) -> Column:
    """Percent change; profit measures divide by the magnitude of the base."""
    return pct(now - before, F.abs(before) if absolute_base else before)


def not_below_zero(c: Column) -> Column:
    """``greatest(c, 0)`` that stays NULL for NULL (Spark's skips NULLs)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0).cast(TOTAL4)))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def formatted_id(prefix: str, number: Column | str, width: int) -> Column:
    """``prefix-000123``: a number padded with zeros to ``width`` digits, longer
    ones in full; NULL for NULL."""
    number = F.col(number) if isinstance(number, str) else number
    return F.when(number.isNotNull(), F.format_string(f"{prefix}-%0{width}d", number.cast("bigint")))
