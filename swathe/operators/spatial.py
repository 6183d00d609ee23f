"""Spatial joins by grid cover.

Polygons are turned into a table of the grid cells they touch, so a spatial
join is an equi-join on the cell plus a refinement. A cover is broadcast if its size,
worked out from the outlines beforehand, is small. Otherwise both sides are
shuffled by cell, where adaptive execution splits a cell that holds many points.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathe.functions.grid import cell_xy, chord, haversine_km, unit_xyz
from swathe.functions.polygon import flat_edges, inside, inside_flat, inside_sql, ring_edges
from swathe.functions.seam import halves, on_globe, over_seam, split_at_seam
from swathe.plans.scratch import read_once
from swathe.plans.sides import broadcast_if, has_at_most

# Slack, in degrees or on the unit sphere, by which filters that only prune are
# widened, so that rounding never drops a true match.
SLACK = 1e-9
# The same where distances far below a metre matter; a few roundings wide.
NEAR_SLACK = 1e-13

# A cover up to this size is sent to every executor.
BROADCAST_BYTES = 64 << 20
# Bytes of one edge in a cover row, and of the rest of the row, rounded up.
EDGE_BYTES, ROW_BYTES = 64, 128
# Edges of a cell up to which a join compiles the test of a point. The JVM does not
# compile methods of over 8,000 bytes; six edges take some 6,000.
FEW_EDGES = 6
# Tables up to this many rows may be copied to their neighbour cubes (at most
# 27 each) and then broadcast.
FEW_ROWS = 20_000
# Rows of one cube that meet as a block, and pairs that a task should compare.
BLOCK_ROWS, TASK_PAIRS = 4096, 1 << 25


def _cut(zones: DataFrame, rings: str) -> DataFrame:
    """Zones cut at the antimeridian; one on both sides of it is two rows, west and
    east of the prime meridian."""
    return zones.withColumn(rings, split_at_seam(rings)).withColumn(rings, F.explode_outer(halves(rings)))


def cover_bytes(
    zones: DataFrame, cell_deg: float, rings: str = "rings"
) -> int:
    """Upper bound of the size of a cover: the cells of each zone's box, each
    with every edge. One pass over the outlines, one row back; two where a zone
    meets the antimeridian."""
    return _cover_size(zones, cell_deg, rings)[0]


def _cover_size(zones: DataFrame, cell_deg: float, rings: str, more: str = "0") -> tuple[int, bool, int]:
    """:func:`cover_bytes`, whether any zone has to be cut at the antimeridian, and the
    most edges of a zone. ``more`` is SQL for the bytes that a row holds besides."""
    cells = [
        f"((array_max(_pts.{c}) - array_min(_pts.{c})) / {float(cell_deg)}D + 2)" for c in "xy"
    ]
    size = f"sum({cells[0]} * {cells[1]} * ({ROW_BYTES} + _more + size(_pts) * {EDGE_BYTES}))"
    outlines = "flatten(filter({}, r -> size(r) >= 3)) AS _pts"
    row = zones.selectExpr(outlines.format(rings), f"{over_seam(rings)} AS _over", f"{more} AS _more").selectExpr(size, "max(_over)", "max(size(_pts))").first()
    if not row[1]:
        return int(row[0] or 0), False, row[2] or 0
    cut = _cut(zones.selectExpr(rings, f"{more} AS _more"), rings)
    row = cut.selectExpr(outlines.format(rings), "_more").selectExpr(size, "max(size(_pts))").first()
    return int(row[0] or 0), True, row[1] or 0


def zone_cover(
    zones: DataFrame, cell_deg: float, zone_id: str = "zone_id", rings: str = "rings", seam: bool = True
) -> DataFrame:
    """Grid cells that can hold points of a zone: ``zone_id, cx, cy, edges``.

    ``edges`` is empty for cells wholly inside, which need no further test.
    Other cells keep only the edges that can cross an eastward ray starting in
    the cell, so the cost of the test does not grow with the whole outline.
    Cells wholly outside are left out. A zone over the antimeridian covers cells
    on both sides of it; see :mod:`swathe.functions.seam`. ``seam=False`` spares
    the cutting where no zone is known to meet it.
    """
    step = f"{float(cell_deg)}D"
    south, west = f"(cy * {step} - 90D)", f"(cx * {step} - 180D)"

    def span(edges: str, axis: str, origin: int) -> str:
        low = f"array_min(flatten(array({edges}.{axis}1, {edges}.{axis}2)))"
        high = low.replace("array_min", "array_max")
        cell = lambda c: f"cast(floor(({c} + {origin}D) / {step}) AS int)"
        return f"sequence({cell(low)}, {cell(high)})"

    def meets(axis: str, low: str) -> str:
        a, b = f"e.{axis}1", f"e.{axis}2"
        return f"greatest({a}, {b}) >= {low} - {SLACK}D AND least({a}, {b}) <= {low} + {step} + {SLACK}D"

    # One row per zone and row of cells, spread over tasks before the costly
    # step, so that neither many zones in a small file nor one vast outline
    # keep a single task busy. The outline is exploded as a one-element array,
    # because a plain projection would be evaluated once per use.
    parts = int(zones.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        (_cut(zones, rings) if seam else zones).select(zone_id, F.array(ring_edges(rings)).alias("_one"))
        .select(zone_id, F.explode_outer("_one").alias("_all"))
        .select(zone_id, "_all", F.expr(f"explode({span('_all', 'y', 90)})").alias("cy"))
        .select(zone_id, "cy", F.expr(f"filter(_all, e -> {meets('y', south)})").alias("_row"))
        .repartition(parts, zone_id, "cy")
    )
    middle = inside_sql("_row", f"({west} + {step} / 2)", f"({south} + {step} / 2)")
    to_east = f"filter(_row, e -> greatest(e.x1, e.x2) >= {west} - {SLACK}D)"
    edges = f"""CASE WHEN exists(_row, e -> {meets('x', west)}) THEN {to_east}
        WHEN {middle} THEN slice(_row, 1, 0) END"""
    cells = f"transform({span('_row', 'x', 180)}, cx -> named_struct('cx', cx, 'edges', {edges}))"
    return rows.select(
        zone_id, "cy", F.expr(f"inline(filter({cells}, c -> c.edges IS NOT NULL))")
    ).select(zone_id, "cx", "cy", "edges")


def multi_level_cover(
    zones: DataFrame, cell_deg: float, levels: int, zone_id: str = "zone_id", rings: str = "rings", seam: bool = True
) -> DataFrame:
    """A cover of cells of several sizes: ``zone_id, level, cx, cy, edges``.

    Cells of ``level`` are ``cell_deg`` times 2 to the level wide, ``levels`` being
    the coarsest one. A coarse cell that meets an outline is replaced by those of
    its four quarters that are not outside, down to level 0; one wholly inside
    stays as it is. So the rows grow with the outline of a zone over the cell width
    rather than with its area, and every place of a zone is in one cell of one level.
    """
    if levels < 0:
        raise ValueError("levels must not be below 0")
    cover = zone_cover(zones, cell_deg * 2**levels, zone_id, rings, seam).select(zone_id, F.lit(levels).alias("level"), "cx", "cy", "edges")
    for level in reversed(range(levels)):
        step = f"{float(cell_deg * 2**level)}D"
        west, south = f"(cx * 2 + dx) * {step} - 180D", f"(cy * 2 + dy) * {step} - 90D"

        def meets(axis: str, low: str) -> str:
            a, b = f"e.{axis}1", f"e.{axis}2"
            return f"greatest({a}, {b}) >= low - {SLACK}D AND least({a}, {b}) <= low + {step} + {SLACK}D".replace("low", f"({low})")  # noqa: B023

        # Edges of the quarter's rows, of which those from its west border on matter for a ray towards east.
        near = f"filter(edges, e -> {meets('y', south)} AND greatest(e.x1, e.x2) >= ({west}) - {SLACK}D)"
        middle = inside_sql("_near", f"(({west}) + {step} / 2)", f"(({south}) + {step} / 2)")
        # Of the edges whose box meets the quarter, those that pass it on one side leave all its corners on one side.
        off = f"abs((({west}) + {step} / 2 - e.x1) * (e.y2 - e.y1) - (({south}) + {step} / 2 - e.y1) * (e.x2 - e.x1))"
        passes = f"{off} <= ({step} / 2 + {SLACK}D) * (abs(e.y2 - e.y1) + abs(e.x2 - e.x1))"
        kept = f"CASE WHEN exists(_near, e -> {meets('x', west)} AND {passes}) THEN _near WHEN {middle} THEN slice(_near, 1, 0) END"
        quarter = f"named_struct('level', {level}, 'cx', cx * 2 + dx, 'cy', cy * 2 + dy, 'edges', transform(array({near}), _near -> {kept})[0])"
        quarters = f"filter(flatten(transform(array(0, 1), dy -> transform(array(0, 1), dx -> {quarter}))), c -> c.edges IS NOT NULL)"
        whole = "array(named_struct('level', level, 'cx', cx, 'cy', cy, 'edges', edges))"
        cover = cover.select(zone_id, F.expr(f"inline(CASE WHEN size(edges) = 0 THEN {whole} ELSE {quarters} END)"))
    return cover


def _covered(
    points: DataFrame, zones: DataFrame, how: str, cell_deg: float,
    zone_id: str, rings: str, lon: str, lat: str, levels: int = 0, attributes: Sequence[str] = (),
) -> DataFrame:
    more = "0"
    if attributes:
        # A zone and what comes along with it pass through the cover as one value.
        zones = zones.select(F.struct(zone_id, *attributes).alias(zone_id), rings)
        more = f"octet_length(cast({zone_id} AS string))"
    size, seam, corners = _cover_size(zones, cell_deg, rings, more)
    if levels:
        cover = multi_level_cover(zones, cell_deg, levels, zone_id, rings, seam)
        bytes_ = cover.select(F.sum(F.size("edges") * EDGE_BYTES + ROW_BYTES + F.expr(more))).first()[0]
        few = (bytes_ or 0) <= BROADCAST_BYTES
    else:
        cover = zone_cover(zones, cell_deg, zone_id, rings, seam).withColumn("level", F.lit(0))
        few = size <= BROADCAST_BYTES
    cover = cover.select(
        F.col(zone_id).alias("_zone"), F.col("level").alias("_zlevel"),
        F.col("cx").alias("_zx"), F.col("cy").alias("_zy"), F.col("edges").alias("_edges"),
    )
    cx, cy = cell_xy("_lon", lat, cell_deg, globe=False)  # covers are planar
    keyed = points.withColumn("_lon", on_globe(F.col(lon))).withColumns({"_cx": cx, "_cy": cy})
    same = (F.col("_cx") == F.col("_zx")) & (F.col("_cy") == F.col("_zy"))
    if levels:
        # The cell of each level in which the point lies.
        cells = f"transform(sequence(0, {levels}), l -> named_struct('_level', l, '_cx', shiftright(_cx, l), '_cy', shiftright(_cy, l)))"
        keyed = keyed.withColumn("_cells", F.expr(cells)).drop("_cx", "_cy").selectExpr("*", "inline(_cells)").drop("_cells")
        same = (F.col("_level") == F.col("_zlevel")) & same

    def met(part: DataFrame, test: Column) -> DataFrame:
        held = keyed.join(broadcast_if(part, few), same & ((F.size("_edges") == 0) | test), how)
        return held.drop("_lon", "_level", "_cx", "_cy", "_zlevel", "_zx", "_zy", "_edges")

    # Lambdas are interpreted, and with them the whole join; cells of few edges do without one.
    compiled, interpreted = inside_flat("_edges", FEW_EDGES, "_lon", lat), inside("_edges", "_lon", lat)
    flat = flat_edges("_edges")
    if corners <= FEW_EDGES:
        joined = met(cover.withColumn("_edges", flat), compiled)
    elif how == "inner":
        # A cell of a zone is in one of the two.
        simple, other = (cover.where(F.size("_edges") <= FEW_EDGES), cover.where(F.size("_edges") > FEW_EDGES))
        joined = met(simple.withColumn("_edges", flat), compiled).union(met(other, interpreted))
    else:
        joined = met(cover, interpreted)
    if attributes:
        held = [F.col("_zone")[c].alias(c) for c in attributes]
        return joined.select(*points.columns, F.col("_zone")[zone_id].alias(zone_id), *held)
    return joined.withColumnRenamed("_zone", zone_id) if how in ("inner", "left") else joined


def spatial_join(
    points: DataFrame, zones: DataFrame, how: str = "inner", cell_deg: float = 2.0,
    zone_id: str = "zone_id", rings: str = "rings", lon: str = "lon", lat: str = "lat",
    attributes: Sequence[str] = (), levels: int = 0,
) -> DataFrame:
    """Points with the id of every zone that holds them; ``inner`` or ``left``.
    ``attributes`` are columns of the zones that come along, by the id, which
    must then be unique.

    A point in several zones gives several rows. Longitudes may be beyond 180, and
    zones may span the antimeridian or go around a pole: two corners in a row are
    joined the shorter way. Choose ``cell_deg`` a few
    times smaller than a typical zone: the cover grows with the square of zone
    width over cell width. For zones of very different or of very large size
    choose a small ``cell_deg`` and some ``levels``: cells inside a zone are then
    up to 2 to that power as wide, at the price of looking a point up once for
    each level (``inner`` only).
    """
    if levels and how != "inner":
        raise ValueError("levels need how='inner'")
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'; see clip and outside")
    if any(re.search("map<|variant", kind) for _, kind in zones.select(*attributes).dtypes):
        held = _covered(points, zones, how, cell_deg, zone_id, rings, lon, lat, levels)  # no key to deal zones by
        return held.join(zones.select(zone_id, *attributes), zone_id, how)
    if attributes:
        # Joined to the zones, so that the pairs themselves need no shuffle by zone.
        zones = zones.select(zone_id, rings).join(zones.select(zone_id, *(F.col(a).alias(f"_attribute_{a}") for a in attributes)), zone_id, how)
    held = _covered(points, zones, how, cell_deg, zone_id, rings, lon, lat, levels, [f"_attribute_{a}" for a in attributes])
    return held.select(zone_id, *points.columns, *(F.col(f"_attribute_{a}").alias(a) for a in attributes)) if attributes else held


def clip(
    points: DataFrame, zones: DataFrame, cell_deg: float = 2.0,
    zone_id: str = "zone_id", rings: str = "rings", lon: str = "lon", lat: str = "lat",
) -> DataFrame:
    """Points inside any zone, each once. A semi-join: no pairs are formed."""
    return _covered(points, zones, "left_semi", cell_deg, zone_id, rings, lon, lat)


def outside(
    points: DataFrame, zones: DataFrame, cell_deg: float = 2.0,
    zone_id: str = "zone_id", rings: str = "rings", lon: str = "lon", lat: str = "lat",
) -> DataFrame:
    """Points in no zone, including those without a position."""
    return _covered(points, zones, "left_anti", cell_deg, zone_id, rings, lon, lat)


def within_distance_join(
    a: DataFrame, b: DataFrame, km: float, lon: str = "lon", lat: str = "lat",
    b_prefix: str = "b_",
) -> DataFrame:
    """All pairs not farther apart than ``km`` along the sphere.

    Columns of ``b`` get ``b_prefix``; ``dist_km`` is the distance. Positions
    are placed in cubes around the unit sphere, one radius wide, so the poles
    and the antimeridian need no special care. Each ``b`` row goes to the
    cubes its radius reaches, each ``a`` row to its own: put the smaller table
    second. Unless that is small, cubes with many rows are cut into blocks, every
    block of ``a`` meets every one of ``b``, and the blocks are dealt to as many
    tasks as there are pairs to compare. The result holds all pairs, so within a dense cluster, or for a
    radius near half the globe, it grows with the product of the sides.
    """
    if not km > 0:
        raise ValueError("km must be above 0")
    reach = chord(km)
    few = has_at_most(b, FEW_ROWS)
    cube = lambda c: f"cast(floor(({c}) / {reach!r}D) AS bigint)"
    left = _on_sphere(a, lon, lat, "_a").withColumns(
        {f"_g{d}": F.expr(cube(f"_a{d}")) for d in AXES}
    )
    right = _on_sphere(b, lon, lat, "_b")
    for d in AXES:
        low, high = (cube(f"_b{d} {sign} {reach + SLACK!r}D") for sign in "-+")
        right = right.withColumn(f"_h{d}", F.expr(f"explode(sequence({low}, {high}))"))
    gap, _ = _cube_distance2("_b", "_h", reach, 0.0)
    right = right.where(f"{gap} <= {(reach + SLACK) ** 2!r}D")
    right = right.withColumnsRenamed({c: f"{b_prefix}{c}" for c in b.columns})
    dist = haversine_km(
        F.col(lon), F.col(lat), F.col(f"{b_prefix}{lon}"), F.col(f"{b_prefix}{lat}")
    )
    same = _same_cube("_g", "_h")
    if not few:
        left, right, same = _in_blocks(left, right, a.columns, [f"{b_prefix}{c}" for c in b.columns])
    # The straight line first, as the distance along the sphere costs far more.
    line2 = " + ".join(f"(_a{d} - _b{d}) * (_a{d} - _b{d})" for d in AXES)
    return (
        left.join(broadcast_if(right, few), same & F.expr(f"{line2} <= {(reach + SLACK) ** 2!r}D"))
        .withColumn("dist_km", dist)
        .where(F.col("dist_km") <= F.lit(float(km)))
        .select(*a.columns, *[f"{b_prefix}{c}" for c in b.columns], "dist_km")
    )


AXES = "xyz"


def _in_blocks(left: DataFrame, right: DataFrame, own: Sequence[str], other: Sequence[str]) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides dealt by cube and block, and the condition under which their rows meet.

    A row is in one block of its side and is copied for each block of the other
    side. ``own`` and ``other`` are the columns whose hash chooses the block.
    """
    cubes = [
        df.groupBy(*(F.col(f"{p}{d}").alias(f"_q{d}") for d in AXES)).agg(F.count("*").alias(n))
        for df, p, n in ((left, "_g", "_na"), (right, "_h", "_nb"))
    ]
    met = read_once(cubes[0].join(cubes[1], [f"_q{d}" for d in AXES]), "cubes")
    pairs = met.agg(F.sum(F.col("_na").cast("double") * F.col("_nb"))).first()[0] or 0
    parts = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(pairs / TASK_PAIRS))
    crowded = met.where(f"_na > {BLOCK_ROWS} OR _nb > {BLOCK_ROWS}").select(
        *(f"_q{d}" for d in AXES), *(F.ceil(F.col(n) / BLOCK_ROWS).cast("int").alias(n) for n in ("_na", "_nb"))
    )

    def dealt(df: DataFrame, p: str, columns: Sequence[str], mine: str, theirs: str, names: tuple[str, str]) -> DataFrame:
        kinds = dict(df.select(*(F.col(f"`{c}`") for c in columns)).dtypes)
        hashed = F.xxhash64(*(F.col(f"`{c}`") for c in columns if not re.search("map<|variant", kinds[c])))
        # There are at most as many crowded cubes as blocks of rows.
        known = df.join(F.broadcast(crowded), _same_cube(p, "_q"), "left").withColumn(names[0], F.when(F.col(mine) > 1, F.pmod(hashed, F.col(mine))).otherwise(0).cast("int"))
        each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(theirs), F.lit(1)) - 1))
        copied = known.withColumn(names[1], each).drop(*(f"_q{d}" for d in AXES), "_na", "_nb")
        return copied.repartition(parts, *(f"{p}{d}" for d in AXES), *sorted(names))

    left = dealt(left, "_g", own, "_na", "_nb", ("_ai", "_aj"))
    right = dealt(right, "_h", other, "_nb", "_na", ("_bj", "_bi"))
    return left, right, _same_cube("_g", "_h") & F.expr("_ai = _bi AND _aj = _bj")


def _on_sphere(df: DataFrame, lon: str, lat: str, p: str) -> DataFrame:
    """Rows with a position, with its unit-sphere coordinates."""
    known = df.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    return known.withColumns({f"{p}{d}": c for d, c in zip(AXES, unit_xyz(lon, lat))})


def _same_cube(a: str, b: str) -> Column:
    return F.expr(" AND ".join(f"{a}{d} = {b}{d}" for d in AXES))


def _cube_distance2(p: str, g: str, side: float, origin: float) -> tuple[str, str]:
    """Squared least and greatest distance from a position to a cube, as SQL."""
    near, far = [], []
    for d in AXES:
        low = f"({g}{d} * {side!r}D + {origin!r}D)"
        gap = f"greatest({low} - {p}{d}, {p}{d} - {low} - {side!r}D, 0D)"
        corner = f"greatest(abs({low} - {p}{d}), abs({low} + {side!r}D - {p}{d}))"
        near.append(f"{gap} * {gap}")
        far.append(f"{corner} * {corner}")
    return f"({' + '.join(near)})", f"({' + '.join(far)})"


def nearest_join(
    a: DataFrame, b: DataFrame, k: int, b_id: str, lon: str = "lon", lat: str = "lat",
    b_prefix: str = "b_", leaf: int = 32, max_level: int = 40,
) -> DataFrame:
    """The ``k`` nearest ``b`` rows of each ``a`` row, ties to the lower
    ``b_id``; columns of ``b`` get ``b_prefix``, plus ``dist_km``, ``rank``.

    Exact, and without a search radius: cubes around the unit sphere are
    halved twice per round. Each ``a`` position keeps only the cubes that can
    still hold one of its nearest, judged from the cubes' counts and their
    least and greatest distance, so a dense cluster of ``b`` is narrowed down
    before any of its rows is paired. The number of rounds is found by one
    counting job over ``b``: halving stops when no cube holds more than
    ``leaf`` positions, or at ``max_level`` (about 0.01 mm). Equal positions are
    searched once per side. ``a`` rows without a position give no row.
    """
    places = a.select(F.col(lon).alias("_lon"), F.col(lat).alias("_lat")).distinct()
    seekers = _on_sphere(places, "_lon", "_lat", "_a")

    # At one position only the k lowest ids can ever be wanted.
    same_spot = Window.partitionBy(lon, lat).orderBy(b_id)
    wanted = b.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    wanted = wanted.withColumn("_n", F.row_number().over(same_spot)).where(F.col("_n") <= k).drop("_n")
    spots = _on_sphere(
        wanted.groupBy(F.col(lon).alias("_blon"), F.col(lat).alias("_blat")).agg(F.count("*").alias("_w")),
        "_blon", "_blat", "_b",
    )
    levels = list(range(2, max_level + 1, 2))

    def cube(c: str, level: int | str) -> str:
        # A coordinate of exactly 1 belongs to the last cube.
        return f"cast(least(floor(({c} + 1D) * pow(2D, {level} - 1)), pow(2D, {level}) - 1) AS bigint)"

    crowd = (
        spots.withColumn("_l", F.explode(F.array(*map(F.lit, levels))))
        .selectExpr("_l", *[f"{cube(f'_b{d}', '_l')} AS _c{d}" for d in AXES])
        .groupBy("_l", *[f"_c{d}" for d in AXES]).count()
        .groupBy("_l").agg(F.max("count").alias("most"))
        .collect()  # one row per level
    )
    depth = min([r["_l"] for r in crowd if r["most"] <= leaf], default=max_level)

    who = ["_lon", "_lat", "_ax", "_ay", "_az"]
    # Round one starts from every cube of the first level: four each way.
    frontier = seekers.selectExpr(*who)
    for d in AXES:
        frontier = frontier.withColumn(f"_p{d}", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    nearest_first = "PARTITION BY _lon, _lat ORDER BY _far ROWS UNBOUNDED PRECEDING"
    for level in range(2, depth + 1, 2):
        cubes = (
            spots.selectExpr("_w", *[f"{cube(f'_b{d}', level)} AS _c{d}" for d in AXES])
            .groupBy(*[f"_c{d}" for d in AXES])
            .agg(F.expr(f"least(sum(_w), {k}) AS _n"))
            .selectExpr("*", *[f"{f'shiftright(_c{d}, 2)' if level > 2 else f'_c{d}'} AS _q{d}" for d in AXES])
        )
        # The first level has at most 64 cubes; below it every parent has at
        # most 64 children, whatever the size of b.
        near, far = _cube_distance2("_a", "_c", 2.0 / 2**level, -1.0)
        frontier = (
            frontier.join(F.broadcast(cubes) if level == 2 else cubes, _same_cube("_p", "_q"))
            .selectExpr(*who, *[f"_c{d} AS _p{d}" for d in AXES], "_n", f"sqrt({near}) AS _near", f"sqrt({far}) AS _far")
            .selectExpr("*", f"sum(_n) OVER ({nearest_first}) AS _filled")
            .selectExpr("*", f"min(CASE WHEN _filled >= {k} THEN _far END) OVER (PARTITION BY _lon, _lat) AS _bound")
            .where(f"_bound IS NULL OR _near <= _bound + {NEAR_SLACK}D")
            .select(*who, *[f"_p{d}" for d in AXES])
        )

    leaves = (
        _on_sphere(wanted, lon, lat, "_b")
        .withColumns({f"_q{d}": F.expr(cube(f"_b{d}", depth)) for d in AXES})
        .drop(*[f"_b{d}" for d in AXES])
        .withColumnsRenamed({c: f"{b_prefix}{c}" for c in b.columns})
    )
    dist = haversine_km(
        F.col("_lon"), F.col("_lat"), F.col(f"{b_prefix}{lon}"), F.col(f"{b_prefix}{lat}")
    )
    order = Window.partitionBy("_lon", "_lat").orderBy("dist_km", f"{b_prefix}{b_id}")
    found = (
        frontier.join(leaves, _same_cube("_p", "_q"))
        .withColumn("dist_km", dist)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("_lon", "_lat", *[f"{b_prefix}{c}" for c in b.columns], "dist_km", "rank")
    )
    # Null-safe on purpose: a plain equality would keep the partitioning that
    # the ranking left, and adaptive execution only splits what a join shuffles.
    same = F.col(lon).eqNullSafe(F.col("_lon")) & F.col(lat).eqNullSafe(F.col("_lat"))
    few = has_at_most(places, max(FEW_ROWS // k, 1))
    return a.join(broadcast_if(found, few), same).drop("_lon", "_lat")


def sample_at_points(
    points: DataFrame, cells: DataFrame, res: float, values: list[str],
    how: str = "left", lon: str = "lon", lat: str = "lat", ix: str = "ix", iy: str = "iy",
) -> DataFrame:
    """Columns of the cell under each point.

    ``cells`` has integer cell indices as :func:`cell_xy` gives them. Points
    outside every cell get nulls, or drop with ``how='inner'``.
    """
    px, py = cell_xy(lon, lat, res)
    under = cells.select(F.col(ix).alias("_ix"), F.col(iy).alias("_iy"), *values)
    keyed = points.withColumn("_px", px).withColumn("_py", py)
    on = (F.col("_px") == F.col("_ix")) & (F.col("_py") == F.col("_iy"))
    return keyed.join(under, on, how).drop("_px", "_py", "_ix", "_iy")
