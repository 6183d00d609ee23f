"""Connected components by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathe.plans.scratch import written


def roots(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every end of an edge ``a``, ``b`` that is not a root itself.

    In each round every root hooks onto the smallest root next to it, if that is
    smaller; the trees that come of it are flattened by pointer jumping; and edges
    are contracted to the roots, so that later rounds see only what is left. A
    node hooks once, so the tables of all rounds make one forest, flattened from
    the last round to the first. The root is a node of the component, not always
    the smallest one.
    """
    loops = edges.where("a <> b")
    left = written(loops.selectExpr("a", "b").unionAll(loops.selectExpr("b", "a")).distinct(), "edges")
    hooked = []
    while not left.isEmpty():
        parent = left.groupBy("a").agg(F.min("b").alias("p")).where("p < a").selectExpr("a AS node", "p AS root")
        flat = _flattened(written(parent, "hooks"))
        hooked.append(flat)
        moved = left
        for end in ("a", "b"):
            to = flat.selectExpr(f"node AS {end}", f"root AS _{end}")
            moved = moved.join(to, end, "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
        left = written(moved.where("a <> b").select("a", "b").distinct(), "edges")
    if not hooked:
        return left.selectExpr("a AS node", "b AS root")
    final = hooked.pop()
    while hooked:
        earlier = hooked.pop()
        onward = final.selectExpr("node AS root", "root AS _to")
        final = final.unionAll(earlier.join(onward, "root", "left").select("node", F.coalesce("_to", "root").alias("root")))
        final = written(final, "roots")
    return final


def _flattened(hooks: DataFrame) -> DataFrame:
    """Every node with the root of its tree; the paths halve in each round."""
    while True:
        onward = hooks.selectExpr("node AS root", "root AS _to")
        jumped = hooks.join(onward, "root", "left").select("node", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("_on"))
        jumped = written(jumped, "hooks")
        if jumped.where("_on").isEmpty():
            return jumped.drop("_on")
        hooks = jumped.drop("_on")
