"""Code standardisation and key clean-up."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted codes and their labels.
GENDER_CODES = {"F": "Female", "M": "Male"}
GENDER_CODES_AND_WORDS = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
UNKNOWN = "N/A"
ERP_KEY_PREFIX = "NAS"


def map_codes(
    col: Column | str, labels: Mapping[str, str], default: str | None = UNKNOWN
) -> Column:
    """Label of the trimmed, upper-cased code; NULL, blank and unknown give ``default``."""
    code = F.upper(F.trim(col))
    codes_by_label: dict[str, list[str]] = {}
    for known, label in labels.items():
        codes_by_label.setdefault(label, []).append(known)
    mapped = F.when(code.isNull(), F.lit(default))
    for label, codes in codes_by_label.items():
        mapped = mapped.when(code.isin(codes), F.lit(label))
    return mapped.otherwise(F.lit(default))


def strip_prefix(
    col: Column | str, prefix: str = ERP_KEY_PREFIX, any_case: bool = False
) -> Column:
    """``col`` without ``prefix``; values that do not start with it stay as they are.

    ``any_case`` takes the prefix in upper or lower case, as engines do whose
    comparison ignores case.
    """
    value = F.col(col) if isinstance(col, str) else col
    rest = F.substring(value, len(prefix) + 1, 2**31 - 1)
    head = F.substring(value, 1, len(prefix))
    starts = F.upper(head) == prefix.upper() if any_case else value.startswith(prefix)
    return F.when(starts, rest).otherwise(value)
