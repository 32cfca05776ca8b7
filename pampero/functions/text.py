"""Text keys used for joins between sources that spell names differently."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented capital letters and the plain letters they fold to.
ACCENTED = "ÁÀÄÂÃÉÈËÊÍÌÏÎÓÒÖÔÕÚÙÜÛÑÇ"
PLAIN = "AAAAAEEEEIIIIOOOOOUUUUNC"


def trim_whitespace(value: Column) -> Column:
    """Strip every kind of Unicode whitespace at both ends (``F.trim`` strips spaces only)."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def normalize_text(value: Column) -> Column:
    """Accent-free upper-case key with single spaces; NULL stays NULL."""
    upper = F.upper(trim_whitespace(value.cast("string")))
    return F.regexp_replace(F.translate(upper, ACCENTED, PLAIN), r"[\t\n\f\r ]+", " ")
