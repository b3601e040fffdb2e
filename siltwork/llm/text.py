"""Words and folds shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What separates words: blank, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"


def whole(text: str | Column) -> Column:
    """The text, empty for NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: str | Column) -> Column:
    """Words of a text in order; an empty array for NULL."""
    return F.array_remove(F.split(whole(text), SPACE), "")


def fold(identifier: str | Column, folds: int) -> Column:
    """Remainder of the CRC-32 of an id's decimal text; NULL ids are in fold 0."""
    column = F.col(identifier) if isinstance(identifier, str) else identifier
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds)), F.lit(0))
