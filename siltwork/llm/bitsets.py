"""Sets of 64-bit hashes as bits of a fixed number, made block by block.

The leading bits of a hash say in which block it lies, so blocks can be made in
different tasks; all of them together reach the driver and go to all tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

#: Bits of a block, as a power of two: a place in a block takes two bytes.
BLOCK = 16


def blocks(bits: int) -> int:
    """Number of blocks of a set of ``2 ** bits`` bits."""
    return 1 << (bits - BLOCK)


def collected(rows: DataFrame, bits: int) -> np.ndarray:
    """The set from rows (block, bits); ``2 ** (bits - 3)`` bytes, whatever the table."""
    found = np.zeros((blocks(bits), 1 << (BLOCK - 3)), dtype=np.uint8)
    for row in rows.toLocalIterator():
        found[row["block"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return found.reshape(-1)


def has(found: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which places of the set are marked."""
    return ((found[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).astype(bool)
