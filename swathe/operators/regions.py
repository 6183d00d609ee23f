"""Connected regions of cells of one class.

Cells are combined to blocks of 8 columns and 7 rows, one row for each block and
class with the cells as 56 bits. Regions inside a block are found on the bits. Only the sides
of blocks are joined, and what that links is labelled by hooking and pointer
jumping, so the number of rows that iterate is that of regions inside blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathe.plans.regions import roots
from swathe.plans.scratch import written

WIDTH, HEIGHT = 8, 7
_ROW = 0xFF
_NOT_EAST = sum(0x7F << 8 * y for y in range(HEIGHT))
_NOT_WEST = sum(0xFE << 8 * y for y in range(HEIGHT))


def _sideways(s: str) -> str:
    """Bits and those one column further either way."""
    return f"({s} | shiftleft({s} & {_NOT_EAST}L, 1) | shiftrightunsigned({s} & {_NOT_WEST}L, 1))"


def _grown(s: str, diagonal: bool) -> str:
    """Bits and their neighbours."""
    if diagonal:
        wide = _sideways(s)
        return f"transform(array({wide}), w -> w | shiftleft(w, 8) | shiftrightunsigned(w, 8))[0]"
    return f"({_sideways(s)} | shiftleft({s}, 8) | shiftrightunsigned({s}, 8))"


def _parts(diagonal: bool) -> str:
    """The regions of ``bits`` as an array of bits, of which a block has 32 at most."""
    steps = "sequence(1, cast(bit_count(a.rest) AS int))"
    filled = f"aggregate({steps}, a.rest & -a.rest, (s, i) -> {_grown('s', diagonal)} & a.rest)"
    part = f"transform(array({filled}), f -> named_struct('rest', a.rest & ~f, 'found', concat(a.found, array(f))))[0]"
    start = "named_struct('rest', bits, 'found', cast(array() AS array<bigint>))"
    turns = "sequence(1, least(32, cast(bit_count(bits) AS int)))"
    return f"aggregate({turns}, {start}, (a, i) -> CASE WHEN a.rest = 0 THEN a ELSE {part} END).found"


def _side_columns(x: int) -> str:
    """One column of the bits as 8 bits, the southernmost row lowest."""
    return "(" + " | ".join(f"shiftleft(shiftrightunsigned(bits, {8 * y + x}) & 1L, {y})" for y in range(HEIGHT)) + ")"


def _blocks(cells: DataFrame, class_col: str, ix: str, iy: str) -> DataFrame:
    place = f"cast(pmod({iy}, {HEIGHT}) * 8 + pmod({ix}, 8) AS int)"
    block = lambda c, n: F.expr(f"({c} - pmod({c}, {n})) div {n}")
    return (
        cells.where(F.col(class_col).isNotNull() & F.col(ix).isNotNull() & F.col(iy).isNotNull())
        .select(
            block(ix, WIDTH).alias("bx"), block(iy, HEIGHT).alias("by"),
            F.col(class_col).alias("class"), F.expr(f"shiftleft(1L, {place})").alias("bits"),
        )
        .groupBy("bx", "by", "class").agg(F.bit_or("bits").alias("bits"))
    )


def _links(parts: DataFrame, diagonal: bool, columns: int | None) -> DataFrame:
    """Pairs ``a``, ``b`` of parts that touch over the sides and corners of their blocks."""

    def facing(own: str, other: str, dx: int, dy: int, meets: str) -> DataFrame:
        near = parts.selectExpr("node AS a", f"bx + {dx} AS bx", f"by + {dy} AS by", "class", f"{own} AS _own").where("_own <> 0")
        far = parts.selectExpr("node AS b", "bx", "by", "class", f"{other} AS _other").where("_other <> 0")
        return near.join(far, ["bx", "by", "class"]).where(meets).select("a", "b")

    wide = "(_own | shiftleft(_own, 1) | shiftrightunsigned(_own, 1))" if diagonal else "_own"
    touches = f"({wide} & _other) <> 0"
    found = facing(_side_columns(7), _side_columns(0), 1, 0, touches)
    found = found.unionAll(facing("shiftrightunsigned(bits, 48)", f"bits & {_ROW}L", 0, 1, touches))
    corner = [f"shiftrightunsigned(bits, {p}) & 1L" for p in (55, 0, 48, 7)]
    if diagonal:
        found = found.unionAll(facing(corner[0], corner[1], 1, 1, "true")).unionAll(facing(corner[2], corner[3], -1, 1, "true"))
    if columns:
        bx, x = divmod(columns - 1, 8)
        last = f"CASE WHEN bx = {bx} THEN {_side_columns(x)} ELSE 0L END"
        first = f"CASE WHEN bx = 0 THEN {_side_columns(0)} ELSE 0L END"
        found = found.unionAll(facing(last, first, -bx, 0, touches))
        if diagonal:
            for dy, (p, q) in ((1, (48 + x, 0)), (-1, (x, 48))):
                last = f"CASE WHEN bx = {bx} THEN shiftrightunsigned(bits, {p}) & 1L ELSE 0L END"
                first = f"CASE WHEN bx = 0 THEN shiftrightunsigned(bits, {q}) & 1L ELSE 0L END"
                found = found.unionAll(facing(last, first, -bx, dy, "true"))
    return found


def _labelled(cells: DataFrame, class_col: str, ix: str, iy: str, connectivity: int, columns: int | None) -> DataFrame:
    """``bx, by, class, bits, root``: the parts of every block with a node of their region."""
    if connectivity not in (4, 8):
        raise ValueError("connectivity must be 4 or 8")
    parts = _blocks(cells, class_col, ix, iy).withColumn("bits", F.expr(f"explode({_parts(connectivity == 8)})"))
    parts = written(parts.withColumn("node", F.monotonically_increasing_id()), "parts")
    to = roots(_links(parts, connectivity == 8, columns))
    return parts.join(to, "node", "left").select("bx", "by", "class", "bits", F.coalesce("root", "node").alias("root"))


_LOW = "cast(bit_count(({0} & -{0}) - 1) AS int)"
_HIGH = "(length(bin({0})) - 1)"
_OCCUPIED = "(" + " | ".join(f"(shiftrightunsigned(bits, {8 * y}) & {_ROW}L)" for y in range(HEIGHT)) + ")"


def _measured(parts: DataFrame, *keep: str) -> DataFrame:
    low, high, occupied = _LOW.format("bits"), _HIGH.format("bits"), "_occupied"
    return (
        parts.withColumn(occupied, F.expr(_OCCUPIED))
        .selectExpr(
            *keep, "class", "bit_count(bits) AS n",
            f"named_struct('iy', by * {HEIGHT} + {low} div 8, 'ix', bx * 8 + {low} % 8) AS first",
            f"bx * 8 + {_LOW.format(occupied)} AS west", f"bx * 8 + {_HIGH.format(occupied)} AS east",
            f"by * {HEIGHT} + {low} div 8 AS south", f"by * {HEIGHT} + {high} div 8 AS north",
        )
    )


def cell_regions(
    cells: DataFrame, class_col: str = "class", ix: str = "ix", iy: str = "iy", connectivity: int = 4, columns: int | None = None,
) -> DataFrame:
    """One row per connected region of cells of one class: ``region_ix``, ``region_iy``,
    ``class``, ``cells`` and the box ``west``, ``south``, ``east``, ``north`` in cells.

    A region is named by its first cell, row by row from the south-west. Cells touch
    over a side, with ``connectivity`` 8 over a corner too. ``columns`` is the number
    of columns of a grid that closes around the globe, whose last column touches
    the first; boxes do not wrap. A cell counts once however often it stands in the
    table, and once for each of its classes. Rows without a class or an index take
    no part. Classes are compared as they are, and may be of any type that groups.
    """
    parts = _measured(_labelled(cells, class_col, ix, iy, connectivity, columns), "root")
    return (
        parts.groupBy("root", "class").agg(
            F.min("first").alias("_first"), F.sum("n").cast("bigint").alias("cells"), F.min("west").alias("west"),
            F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"),
        )
        .select(F.col("_first.ix").alias("region_ix"), F.col("_first.iy").alias("region_iy"), "class", "cells", "west", "south", "east", "north")
    )


def region_cells(
    cells: DataFrame, class_col: str = "class", ix: str = "ix", iy: str = "iy", connectivity: int = 4, columns: int | None = None,
) -> DataFrame:
    """Every cell of :func:`cell_regions` once with its region: ``ix``, ``iy``, ``class``, ``region_ix``, ``region_iy``, ``cells``."""
    parts = written(_labelled(cells, class_col, ix, iy, connectivity, columns), "labelled")
    named = _measured(parts, "root").groupBy("root").agg(F.min("first").alias("_first"), F.sum("n").cast("bigint").alias("cells"))
    return (
        parts.join(named, "root")
        .withColumn("_p", F.expr("explode(filter(sequence(0, 55), p -> shiftrightunsigned(bits, p) & 1L = 1L))"))
        .selectExpr(
            "bx * 8 + _p % 8 AS ix", f"by * {HEIGHT} + _p div 8 AS iy", "class", "_first.ix AS region_ix", "_first.iy AS region_iy", "cells",
        )
    )
