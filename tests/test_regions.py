"""Connected regions of cells and distances to a class, against brute force."""

import math
import random

import pytest
from swathe.operators import distance, regions
from swathe.plans.regions import roots

CELLS = "ix bigint, iy bigint, class string"


def brute_regions(cells, connectivity=4, columns=None):
    """``{first cell and class: cells}`` by flooding."""
    left, out = set(cells), {}
    steps = [(0, 1), (1, 0), (0, -1), (-1, 0)] + [(1, 1), (1, -1), (-1, 1), (-1, -1)] * (connectivity == 8)
    while left:
        todo = [left.pop()]
        region = set(todo)
        while todo:
            x, y, c = todo.pop()
            for dx, dy in steps:
                near = ((x + dx) % columns if columns else x + dx, y + dy, c)
                if near in left:
                    left.remove(near)
                    region.add(near)
                    todo.append(near)
        y, x = min((y, x) for x, y, _ in region)
        out[x, y, c] = region
    return out


def grid(seed, width, height, share, classes="ab"):
    draw = random.Random(seed)
    return {(x, y, draw.choice(classes)) for x in range(width) for y in range(height) if draw.random() < share}


@pytest.mark.parametrize("seed,connectivity,columns", [(0, 4, None), (1, 8, None), (2, 4, 37), (3, 8, 40), (4, 8, 41)])
def test_regions_equal_flooding(spark, seed, connectivity, columns):
    cells = grid(seed, columns or 45, 39, 0.9 if connectivity == 4 else 0.6)
    rows = [*cells, *list(cells)[:50], (None, 1, "a"), (1, None, "a"), (3, 3, None)]
    df = spark.createDataFrame(rows, CELLS)
    want = brute_regions(cells, connectivity, columns)
    got = {(r["region_ix"], r["region_iy"], r["class"]): r for r in regions.cell_regions(df, connectivity=connectivity, columns=columns).collect()}
    assert got.keys() == want.keys()
    for key, region in want.items():
        xs, ys, row = [c[0] for c in region], [c[1] for c in region], got[key]
        assert (row["cells"], row["west"], row["south"], row["east"], row["north"]) == (len(region), min(xs), min(ys), max(xs), max(ys))
    labelled = regions.region_cells(df, connectivity=connectivity, columns=columns).collect()
    assert {tuple(r) for r in labelled} == {(*c, *key[:2], len(region)) for key, region in want.items() for c in region}
    assert len(labelled) == len(cells)


def test_one_region_winds_through_all_blocks(spark):
    snake = {(x, y, "s") for y in range(0, 60, 2) for x in range(60)} | {(59 if y % 4 == 1 else 0, y, "s") for y in range(1, 59, 2)}
    shifted = {(x - 31, y - 27, c) for x, y, c in snake}
    df = spark.createDataFrame(sorted(shifted), CELLS)
    assert [r["cells"] for r in regions.cell_regions(df).collect()] == [len(snake)]
    assert regions.cell_regions(df.limit(0)).count() == 0
    full = spark.range(120 * 90).selectExpr("id % 120 AS ix", "id div 120 AS iy", "CASE WHEN id % 3 = 0 THEN NULL ELSE 1.5D END AS class")
    assert regions.cell_regions(full, connectivity=8).selectExpr("sum(cells)").first()[0] == 7200
    with pytest.raises(ValueError):
        regions.cell_regions(df, connectivity=6)


def test_roots(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(330)] + [(1000 + k, 1001 + k) for k in range(90)] + [(5, 5), (None, 3)]
    label = {}
    for a, b in edges:
        if a is not None and a != b:
            x, y = label.setdefault(a, a), label.setdefault(b, b)
            label = {k: (min(x, y) if v in (x, y) else v) for k, v in label.items()}
    got = {r["node"]: r["root"] for r in roots(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    found = {k: got.get(k, k) for k in label}
    assert len(set(zip(found.values(), label.values()))) == len(set(label.values())) == len(set(found.values()))


def brute_distance(cells, target, columns=None):
    there = [(x, y) for x, y, c in cells if c == target]
    turns = (-columns, 0, columns) if columns else (0,)
    return {
        (x, y): min(((x - u + t) ** 2 + (y - v) ** 2 for u, v in there for t in turns), default=None) for x, y, _ in cells
    }


@pytest.mark.parametrize("seed,columns", [(0, None), (1, 40), (2, None), (3, 33)])
def test_distance_equals_brute_force(spark, seed, columns):
    cells = {c for c in grid(seed, columns or 50, 30, 0.5, "aaaaaaab") if c[1] % 7 and c[0] % 5}
    cells = {(x if columns else x - 25, y - 11, c) for x, y, c in cells}
    rows = [*cells, *list(cells)[:30], (None, 1, "b"), (1, None, "b")]
    df = spark.createDataFrame(rows, CELLS)
    got = distance.class_distance(df, "b", columns=columns).collect()
    want = brute_distance(cells, "b", columns)
    assert {(r["ix"], r["iy"]): r["dist2"] for r in got} == want and len(got) == len(want)
    assert all(r["dist"] == math.sqrt(r["dist2"]) for r in got)


def test_distance_edges(spark):
    df = spark.createDataFrame([(0, 0, "a"), (7, 0, None), (-3, 900, "a")], CELLS)
    assert {r["dist2"] for r in distance.class_distance(df, "b").collect()} == {None}
    assert distance.class_distance(df.limit(0), "b").count() == 0
    got = {(r["ix"], r["iy"]): r["dist2"] for r in distance.class_distance(df, "a").collect()}
    assert got == {(0, 0): 0, (7, 0): 49, (-3, 900): 0}
    ties = spark.createDataFrame([(x, 0, "a" if x % 10 == 0 else "c") for x in range(41)], CELLS)
    assert all(r["dist"] == min(r["ix"] % 10, 10 - r["ix"] % 10) for r in distance.class_distance(ties, "a").collect())
