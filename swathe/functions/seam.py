"""Outlines over the antimeridian, in array expressions.

Two corners in a row are joined the shorter way: an edge more than 180 degrees
wide, but less than 360, runs over the seam at longitude 180. Corners beyond 180
or -180 are taken as they are drawn. What comes out lies between -180 and 180.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _point(x: str, y: str) -> str:
    return f"named_struct('x', {x}, 'y', {y})"


def _turns(ring: str) -> str:
    """Corners after which the ring runs over the seam: number and +1 towards east, -1 towards west."""
    step = f"({ring}[(i + 1) % size({ring})].x - {ring}[i].x)"
    turn = f"CASE WHEN {step} > 180 AND {step} < 360 THEN -1 WHEN {step} < -180 AND {step} > -360 THEN 1 ELSE 0 END"
    every = f"transform(sequence(0, size({ring}) - 1), i -> named_struct('i', i, 'turn', {turn}))"
    return f"filter({every}, t -> t.turn != 0)"


def _unrolled(ring: str) -> str:
    """The ring with longitudes that go on over the seam. One that goes around a
    pole is closed along the meridian of its first corner, through the pole on
    the side where its corners lie on average."""
    total = "aggregate(_turns, 0, (n, t) -> n + t.turn)"
    moved = f"transform({ring}, (p, i) -> {_point('p.x + 360D * aggregate(filter(_turns, t -> t.i < i), 0, (n, t) -> n + t.turn)', 'p.y')})"
    pole = f"CASE WHEN aggregate({ring}, 0D, (s, p) -> s + p.y) >= 0 THEN 90D ELSE -90D END"
    end = f"(_moved[0].x + 360D * {total})"
    back = f"array({_point(end, '_moved[0].y')}, {_point(end, pole)}, {_point('_moved[0].x', pole)})"
    closed = _let("_moved", moved, f"CASE WHEN {total} = 0 THEN _moved ELSE concat(_moved, {back}) END")
    return _let("_turns", _turns(ring), f"CASE WHEN size(_turns) = 0 THEN {ring} ELSE {closed} END")


def _half(ring: str, side: str, at: str) -> str:
    """The part of a ring with ``x {side} at``, closed along that line."""
    p, q = f"{ring}[i]", f"{ring}[(i + 1) % size({ring})]"
    inside, next_inside = f"{p}.x {side} {at}", f"{q}.x {side} {at}"
    crossing = _point(at, f"{p}.y + ({q}.y - {p}.y) * ({at} - {p}.x) / ({q}.x - {p}.x)")
    none = f"slice({ring}, 1, 0)"
    corner = (
        f"concat(CASE WHEN {inside} THEN array({p}) ELSE {none} END,"
        f" CASE WHEN ({inside}) != ({next_inside}) THEN array({crossing}) ELSE {none} END)"
    )
    return f"CASE WHEN size({ring}) = 0 THEN {ring} ELSE flatten(transform(sequence(0, size({ring}) - 1), i -> {corner})) END"


def _strips(ring: str) -> str:
    """The parts of an unrolled ring in each turn of the globe, moved onto it."""
    low, high = f"array_min({ring}.x)", f"array_max({ring}.x)"
    west, east = "(360D * k - 180D)", "(360D * k + 180D)"
    part = _let("_east_of", _half(ring, ">=", west), _half("_east_of", "<=", east))
    back = f"transform({part}, p -> {_point('p.x - 360D * k', 'p.y')})"
    turns = f"sequence(cast(floor(({low} + 180) / 360) AS int), cast(floor(({high} + 180) / 360) AS int))"
    parts = f"filter(transform({turns}, k -> {back}), r -> size(r) >= 3 AND array_max(r.x) > array_min(r.x))"
    return f"CASE WHEN {low} >= -180 AND {high} <= 180 THEN array({ring}) ELSE {parts} END"


def split_at_seam(rings: str = "rings") -> Column:
    """``rings`` cut where they run over the seam, so that all corners lie on the
    globe once. Rings of fewer than three corners go."""
    whole = f"filter({rings}, r -> size(r) >= 3)"
    return F.expr(f"flatten(transform({whole}, r -> {_let('_ring', _unrolled('r'), _strips('_ring'))}))")


def over_seam(rings: str = "rings") -> str:
    """SQL for whether :func:`split_at_seam` would cut any of the rings."""
    beyond = "exists(r, p -> p.x > 180 OR p.x < -180)"
    return f"exists({rings}, r -> size(r) >= 3 AND ({beyond} OR size({_turns('r')}) > 0))"


def halves(rings: str = "rings") -> Column:
    """``rings`` of :func:`split_at_seam` as an array of one outline, or of a western
    and an eastern one for an outline that touches the seam on both sides, so that
    no outline spans the globe only because it lies on both sides of the seam."""
    both = f"array_min(flatten({rings}).x) <= -180 AND array_max(flatten({rings}).x) >= 180"
    west, east = (f"filter(transform({rings}, r -> {_half('r', side, '0D')}), r -> size(r) >= 3)" for side in ("<=", ">="))
    return F.expr(f"CASE WHEN {both} THEN array({west}, {east}) ELSE array({rings}) END")


def unrolled(rings: str = "rings") -> Column:
    """``rings`` with longitudes that go on over the seam, all rings of an outline
    on the turn of the globe on which the first one starts."""
    rolled = f"transform({rings}, r -> CASE WHEN size(r) < 3 THEN r ELSE {_unrolled('r')} END)"
    near = "360D * round((_all[0][0].x - r[0].x) / 360)"
    moved = f"transform(_all, r -> transform(r, p -> {_point(f'p.x + {near}', 'p.y')}))"
    over = f"exists({rings}, r -> size(r) >= 3 AND size({_turns('r')}) > 0)"
    return F.expr(f"CASE WHEN {over} THEN {_let('_all', rolled, moved)} ELSE {rings} END")


def on_globe(lon: Column) -> Column:
    """A longitude from -180 up to but not including 180."""
    turned = lon - 360.0 * F.floor((lon + 180.0) / 360.0)
    return F.when((lon >= 180.0) | (lon < -180.0), turned).otherwise(lon)
