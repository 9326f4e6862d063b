"""Number functions that never throw on dirty input, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^[+-]?[0-9]+$"
_SPACE = " \t\r\n\f\x0b"


def int64_or_zero(c: Column) -> Column:
    """Whole 64-bit integers only; blanks around, fractions, overflow and words give 0."""
    return F.coalesce(F.when(c.rlike(_INTEGER), c.try_cast("bigint")), F.lit(0).cast("bigint"))


def number_or_null(c: Column) -> Column:
    """Double of a decimal number with optional blanks around, else null.

    The end of the text keeps out what a cast would take as well: ``12d``, ``NaN``, ``Infinity``,
    and the ``x`` test hexadecimal numbers.
    """
    t = F.rtrim(c.cast("string"), F.lit(_SPACE))
    last = F.right(t, F.lit(1))
    decimal = (last.between("0", "9") | (last == ".")) & ~t.contains("x") & ~t.contains("X")
    return F.when(decimal, t.try_cast("double"))


def lenient_double(c: Column) -> Column:
    return F.coalesce(number_or_null(c), F.lit(0.0))


def lenient_long(c: Column) -> Column:
    """Like ``lenient_double`` as a whole number: the fraction is cut, beyond 64 bits gives 0.

    Whole numbers take the integer path, so that large ids keep every digit. Casts skip blanks.
    """
    return F.coalesce(c.cast("string").try_cast("bigint"), number_or_null(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def finite_or_null(c: Column) -> Column:
    """Null for NaN and both infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def micros_to_units(c: Column) -> Column:
    return c / F.lit(1_000_000)


def round_half_even(c: Column) -> Column:
    return F.bround(c, 0).cast("bigint")


def flag(c: Column) -> Column:
    """1 for a positive number, else 0 (also for null)."""
    return F.coalesce((c > 0).cast("int"), F.lit(0))
