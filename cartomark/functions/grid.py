"""Square hierarchical grid: cell ids, parents and bounding-box covers.

A cell id is the Z-order (Morton) key of the cell's column and row, so the id of
the parent ``k`` levels up is a right shift by ``2 * k`` bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MASK31 = 0x7FFFFFFF
#: Added to cell columns and rows before interleaving, so that negative cells
#: keep their order and shifting still yields the parent.
CELL_BIAS = 1 << 30


def _spread_bits(value: Column) -> Column:
    # Binary digits read as base-4 digits land on the even bit positions.
    low31 = value.cast("bigint").bitwiseAND(F.lit(_MASK31))
    return F.conv(F.bin(low31), 4, 10).cast("bigint")


def morton(x: Column, y: Column) -> Column:
    """Z-order key: the bits of ``x`` on even, of ``y`` on odd positions (31 bits each)."""
    return _spread_bits(x).bitwiseOR(F.shiftleft(_spread_bits(y), 1))


def axis_cell(value: Column, size: float | Column) -> Column:
    """Column or row number of the cell holding ``value``."""
    return F.floor(value / size).cast("bigint")


def cell_id(col: Column, row: Column, level: Column | None = None) -> Column:
    """Id of the cell at a grid column and row (either may be negative).

    With a ``level``, column and row count cells of that many steps coarser, and
    the id is that of the parent of the base cells inside.
    """
    bias = F.lit(CELL_BIAS)
    if level is not None:
        bias = F.call_function("shiftright", F.lit(CELL_BIAS).cast("bigint"), level.cast("int"))
    return morton(col + bias, row + bias)


def parent_cell(cell: Column, levels: int | Column) -> Column:
    """Id of the enclosing cell ``levels`` steps coarser."""
    steps = F.lit(levels) if isinstance(levels, int) else levels
    return F.call_function("shiftrightunsigned", cell, (steps * 2).cast("int"))


def bbox_cover(xmin: Column, ymin: Column, xmax: Column, ymax: Column, size: float | Column) -> Column:
    """Array of the ids of all cells a box touches."""
    cols = F.sequence(axis_cell(xmin, size), axis_cell(xmax, size))
    rows = F.sequence(axis_cell(ymin, size), axis_cell(ymax, size))
    return F.flatten(F.transform(cols, lambda c: F.transform(rows, lambda r: cell_id(c, r))))
