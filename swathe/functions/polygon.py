"""Polygon expressions on plain arrays.

A polygon is ``rings ARRAY<ARRAY<STRUCT<x DOUBLE, y DOUBLE>>>``. Rings may be
open or closed. Parity decides what is inside, so holes and the parts of a
multipolygon are simply further rings. Arguments are SQL expressions, usually
column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"


def ring_edges(rings: str = "rings") -> Column:
    """All edges of all rings as ``ARRAY<STRUCT<x1,y1,x2,y2>>``."""
    return F.expr(f"""
        flatten(transform(filter({rings}, r -> size(r) >= 3),
          r -> zip_with(r, concat(slice(r, 2, size(r)), slice(r, 1, 1)),
            (p, q) -> named_struct('x1', p.x, 'y1', p.y, 'x2', q.x, 'y2', q.y))))""")


def sum_over(items: str, term: str) -> Column:
    """Sum of ``term``, an expression of the item ``e``."""
    return F.expr(f"aggregate({items}, 0D, (acc, e) -> acc + {term})")


def inside_sql(edges: str, px: str, py: str) -> str:
    """Even-odd test as SQL: does a ray towards east cross an odd number of
    edges? Points exactly on an edge may fall on either side."""
    return f"""
        aggregate({edges}, false, (odd, e) -> odd != CASE
          WHEN (e.y1 > {py}) != (e.y2 > {py})
          THEN {px} < (e.x2 - e.x1) * ({py} - e.y1) / (e.y2 - e.y1) + e.x1
          ELSE false END)"""


def inside(edges: str, px: str, py: str) -> Column:
    """:func:`inside_sql` as a Column."""
    return F.expr(inside_sql(edges, px, py))


# Numbers of an edge in :func:`flat_edges`.
FLAT = 5


def flat_edges(edges: str) -> Column:
    """``edges`` as ``ARRAY<DOUBLE>`` for :func:`inside_flat`, ``FLAT`` numbers each."""
    return F.expr(f"flatten(transform({edges}, e -> array(e.y1, e.y2, e.x1, e.x2 - e.x1, e.y2 - e.y1)))")


def inside_flat(flat: str, most: int, px: str, py: str) -> Column:
    """:func:`inside` for at most ``most`` edges, as :func:`flat_edges` gives them.

    Written out without a lambda, so that a join compiles the test instead of
    interpreting it for every pair.
    """
    odd = "false"
    for i in reversed(range(most)):
        y1, y2, x1, dx, dy = (f"get({flat}, {FLAT * i + j})" for j in range(FLAT))
        crossed = f"""CASE WHEN ({y1} > {py}) != ({y2} > {py})
          THEN {px} < {dx} * ({py} - {y1}) / {dy} + {x1} ELSE false END"""
        odd = f"(CASE WHEN size({flat}) > {FLAT * i} THEN ({crossed}) != {odd} ELSE false END)"
    return F.expr(odd)


def box_ring(west: str, south: str, east: str, north: str) -> Column:
    """A rectangle as a ``rings`` value."""
    corners = [(west, south), (east, south), (east, north), (west, north)]
    points = ", ".join(f"named_struct('x', {x}, 'y', {y})" for x, y in corners)
    return F.expr(f"array(array({points}))").cast(RINGS_TYPE)
