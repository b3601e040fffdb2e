"""Stray blanks, under binary or padded comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trailing blanks do not count when two values are compared.
PADDED = "UTF8_BINARY_RTRIM"
# As PADDED, and upper and lower case are equal too.
PADDED_ANY_CASE = "UTF8_LCASE_RTRIM"


def has_stray_blanks(col: Column | str, collation: str | None = None) -> Column:
    """True when trimming changes the value; NULL for NULL.

    With ``collation=PADDED`` only leading blanks are noticed, as in engines
    that pad values before comparing them.
    """
    value = F.col(col) if isinstance(col, str) else col
    if collation:
        value = F.collate(value, collation)
    return value != F.trim(value)
