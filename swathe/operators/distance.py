"""Distance of every cell to the nearest cell of a class, by two one-dimensional passes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathe.plans.sides import join_null_safe


def class_distance(
    cells: DataFrame, target, class_col: str = "class", ix: str = "ix", iy: str = "iy", columns: int | None = None,
) -> DataFrame:
    """``ix``, ``iy``, ``dist2``, ``dist`` for every cell: squared and plain distance, in
    cells and between centres, to the nearest cell whose class is ``target``.

    Exact. First every column with such cells gives, for each row of the grid, how
    far its own nearest one is. Along a row the squared distance is then the least
    of the parabolas that stand on the columns. The column that gives it never
    moves back as one goes along the row, so it is found for the middle cell
    first and then between the columns of cells already known, in as many rounds
    as the row's length has binary digits.

    A cell counts once however often it stands in the table. Cells of the class
    have distance 0; without any the distance is null. Rows without an index give
    no row, a null class is no class. ``columns`` is the number of columns of a
    grid that closes around the globe. Work grows with the rows that hold cells
    times the columns that hold the class; a task holds one row of the grid.
    """
    known = cells.where(F.col(ix).isNotNull() & F.col(iy).isNotNull())
    known = known.select(F.col(ix).cast("bigint").alias("ix"), F.col(iy).cast("bigint").alias("iy"), (F.col(class_col) == target).alias("_is"))
    rows = known.groupBy("iy").agg(F.sort_array(F.collect_set("ix")).alias("_x"))
    sources = known.where("_is").select("ix", "iy")
    if columns:
        turns = F.array(*(F.lit(t * columns).cast("bigint") for t in (-1, 0, 1)))
        sources = sources.select("iy", "ix", F.explode(turns).alias("_turn")).select("iy", (F.col("ix") + F.col("_turn")).alias("ix"))
    span = known.agg(F.min("iy"), F.max("iy")).first()
    if span[0] is None:
        return rows.selectExpr("explode(_x) AS ix", "iy", "cast(null AS bigint) AS dist2", "cast(null AS double) AS dist").limit(0)
    parabolas = _heights(sources, span[0], span[1]).groupBy("iy").agg(F.sort_array(F.collect_list(F.struct("j", "g"))).alias("_f"))
    return _nearest(join_null_safe(rows, parabolas, ["iy"], "left"))


def _heights(sources: DataFrame, south: int, north: int) -> DataFrame:
    """``iy``, ``j``, ``g``: squared distance in column ``j`` from row ``iy`` to the column's nearest source."""
    ys = sources.groupBy(F.col("ix").alias("j")).agg(F.sort_array(F.collect_set("iy")).alias("_y"))
    # From each source up to the next one; the first also reaches down to the lowest row.
    gaps = ys.select("j", F.posexplode("_y").alias("_k", "_a"), F.col("_y")).select(
        "j", "_a", F.expr("CASE WHEN _k + 1 < size(_y) THEN _y[_k + 1] END").alias("_b"),
        F.expr(f"CASE WHEN _k = 0 THEN least({south}L, _a) ELSE _a END").alias("_from"),
        F.expr(f"CASE WHEN _k + 1 < size(_y) THEN _y[_k + 1] - 1 ELSE greatest({north}L, _a) END").alias("_to"),
    )
    every = gaps.withColumn("iy", F.explode(F.sequence("_from", "_to")))
    off = "least(abs(iy - _a), coalesce(_b - iy, abs(iy - _a)))"
    return every.where(f"iy BETWEEN {south} AND {north}").selectExpr("iy", "j", f"{off} * {off} AS g")


def _nearest(rows: DataFrame) -> DataFrame:
    """The least parabola of ``_f`` at every place of ``_x``, row by row."""
    longest = rows.agg(F.max(F.size("_x"))).first()[0] or 1
    strides = [1 << k for k in reversed(range(max(1, math.ceil(math.log2(longest + 1)))))]
    cost = "named_struct('d', (_x[t] - _f[k].j) * (_x[t] - _f[k].j) + _f[k].g, 'k', k)"
    low = "CASE WHEN t >= s THEN o[t - s].k ELSE 0 END"
    high = "CASE WHEN t + s < size(_x) THEN o[t + s].k ELSE size(_f) - 1 END"
    least = f"array_min(transform(sequence({low}, {high}), k -> {cost}))"
    found = (
        f"aggregate(array({', '.join(map(str, strides))}), transform(_x, x -> named_struct('d', 0L, 'k', 0)),"
        f" (o, s) -> transform(sequence(0, size(_x) - 1), t -> CASE WHEN t % (2 * s) = s - 1 THEN {least} ELSE o[t] END))"
    )
    met = rows.withColumn("_o", F.expr(f"CASE WHEN size(_f) > 0 THEN {found} END"))
    each = F.expr("explode(arrays_zip(_x, transform(sequence(0, size(_x) - 1), t -> _o[t].d)))")
    return met.select("iy", each.alias("_one")).selectExpr("_one._x AS ix", "iy", "_one.`1` AS dist2", "sqrt(_one.`1`) AS dist")
