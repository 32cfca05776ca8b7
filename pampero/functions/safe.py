"""Casts and arithmetic that answer NULL, never an error, on dirty data.

Spark's ``try_cast`` is laxer than the warehouse semantics this package keeps: it reads
``'2024'`` as a date, ``'yes'`` as true and ``'1.5d'`` as a number. The guards below reject
those before casting.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
_TIMESTAMP = r"^\s*\d{4}-\d{1,2}-\d{1,2}([T ].*)?$"
_WHOLE = r"^\s*[+-]?\d+\s*$"


def safe_double(text: Column) -> Column:
    """Finite number or infinity from text; Java's ``d``/``f`` suffixes and NaN are no numbers."""
    suffixed = F.substring(text, -1, 1).isin("d", "D", "f", "F") & ~text.rlike("(?i)inf$")
    number = F.when(~suffixed, text).try_cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def safe_long(text: Column) -> Column:
    return F.when(text.rlike(_WHOLE), text).try_cast("bigint")


def safe_date(text: Column) -> Column:
    return F.when(text.rlike(_DATE), text).try_cast("date")


def safe_timestamp(text: Column) -> Column:
    """Timestamp from text; text without a zone is read in the session zone (UTC)."""
    return F.when(text.rlike(_TIMESTAMP), text).try_cast("timestamp")


def safe_bool(text: Column) -> Column:
    word = F.lower(text)
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL on a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def _all_present(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def strict_greatest(*columns: Column) -> Column:
    """Largest argument, NULL when any is NULL (``F.greatest`` skips NULLs)."""
    return F.when(_all_present(list(columns)), F.greatest(*columns))


def strict_least(*columns: Column) -> Column:
    """Smallest argument, NULL when any is NULL (``F.least`` skips NULLs)."""
    return F.when(_all_present(list(columns)), F.least(*columns))


def clamp(value: Column, low: float, high: float) -> Column:
    """Value held within [low, high]; NULL stays NULL."""
    held = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNotNull(), held)


def at_least(value: Column, floor: float) -> Column:
    """Value, or the floor where it is below; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def non_null_count(columns: list[str]) -> Column:
    """How many of the named columns hold a value, as bigint."""
    return _count_where([F.col(c).isNotNull() for c in columns])


def null_count(columns: list[str]) -> Column:
    """How many of the named columns are NULL, as bigint."""
    return _count_where([F.col(c).isNull() for c in columns])


def _count_where(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("bigint") for c in conditions])
