"""A bit table of fixed size over 64-bit hashes. It lets a scan leave out most rows that a following exact join would drop."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bit_table(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bytes of a table of `bits` (a power of two) with a bit set for each value of the only column."""
    slot = F.col(hashes.columns[0]).bitwiseAND(bits - 1)
    one = F.expr(f"shiftleft(1L, cast({hashes.columns[0]} & 31 as int))")
    words = hashes.select(F.shiftright(slot, 5).alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = words.toArrow()  # at most bits / 32 rows
    table = np.zeros(bits // 32, "<u4")
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return table.view(np.uint8)


def marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes.view(np.uint64) & np.uint64(8 * len(table) - 1)
    return (table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
