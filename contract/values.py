"""SQL for value rules that several checks share."""

from __future__ import annotations

from collections.abc import Mapping

from siltwork.functions.codes import UNKNOWN


def label(column: str, labels: Mapping[str, str]) -> str:
    """The label that a code, trimmed and in upper case, has in ``labels``."""
    codes = ", ".join(f"'{code}'" for code in labels)
    words = ", ".join(f"'{word}'" for word in labels.values())
    return f"coalesce(map([{codes}], [{words}])[upper(trim({column}))], '{UNKNOWN}')"


def repaired(sales: str, quantity: str, price: str) -> tuple[str, str, str]:
    """Amounts repaired from one another: known and positive ones stay.

    Sales that do not equal quantity times price, both without their sign, are
    replaced by it where it is known.
    """
    product = f"abs({quantity}) * cast(abs({price}) as bigint)"
    agrees = f"{sales} is not distinct from coalesce({product}, {sales})"
    return (
        f"if({sales} > 0 and {agrees}, {sales}, {product})",
        f"if({quantity} > 0, {quantity}, {sales} // nullif(abs({price}), 0))",
        f"if({price} > 0, {price}, {sales} // nullif({quantity}, 0))",
    )
