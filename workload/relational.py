"""Plain relational work: built-in DataFrame operations on the star schema."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from workload.fixtures import table


def select_filter(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .where((F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") > 45))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey",
            F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
        )
    )


SELECT_FILTER = """SELECT l_orderkey, l_linenumber, l_partkey,
  round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem
WHERE l_shipdate < TIMESTAMP '1997-01-01' AND l_quantity > 45"""


def equi_join(how):
    def query(spark, sf):
        # Keys are shifted so that every kind of join has unmatched rows on both sides.
        left = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
        right = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") + 50).alias("c_custkey"))
        return left.join(right, "c_custkey", how)

    return query


JOIN_SIDES = """WITH l AS (SELECT c_custkey, c_mktsegment FROM customer),
  r AS (SELECT o_orderkey, o_custkey + 50 AS c_custkey FROM orders)"""


def group_distinct(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("orders"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
    )


GROUP_DISTINCT = """SELECT l_returnflag, l_linestatus, count(*) AS n,
  count(DISTINCT l_orderkey) AS orders, round(sum(l_quantity), 2) AS quantity
FROM lineitem GROUP BY 1, 2"""


def group_approx_distinct(spark, sf):
    """The sketch stays within 10% of the exact count, which is given too.

    Both are of the distinct pairs: beside a distinct count, Spark would keep a
    sketch for every order of a flag.
    """
    return (
        table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey").distinct().groupBy("l_returnflag")
        .agg(
            F.approx_count_distinct("l_orderkey", 0.02).alias("about"),
            F.count("l_orderkey").alias("exact"),
        )
        .select("l_returnflag", "exact", (F.abs(F.col("about") / F.col("exact") - 1) < 0.1).alias("near"))
    )


GROUP_APPROX = "SELECT l_returnflag, count(DISTINCT l_orderkey) AS exact, true AS near FROM lineitem GROUP BY 1"


def top_orders(spark, sf):
    return (
        table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
        .select("o_orderkey", "o_totalprice")
    )


TOP_ORDERS = """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"""


def top_per_group(spark, sf):
    order = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return (
        table(spark, sf, "orders").withColumn("rank", F.row_number().over(order)).where("rank <= 3")
        .select("o_custkey", "rank", "o_orderkey", "o_totalprice")
    )


TOP_PER_GROUP = """SELECT o_custkey, CAST(rank AS INT) AS rank, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank
  FROM orders) WHERE rank <= 3"""


def concat_dedupe(spark, sf):
    a = table(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("F").alias("o_orderstatus"))
    return a.unionByName(b).dropDuplicates()


CONCAT_DEDUPE = """SELECT o_custkey, o_orderstatus FROM orders
UNION SELECT c_custkey, 'F' FROM customer"""


def pivot(spark, sf):
    return (
        table(spark, sf, "orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"])
        .agg(F.round(F.sum("o_totalprice"), 2))
    )


PIVOT = """SELECT o_custkey, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS F,
  round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS O,
  round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) AS P FROM orders GROUP BY 1"""


def unpivot(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price")
    ).unpivot("p_partkey", ["size", "price"], "measure", "amount")


UNPIVOT = """SELECT p_partkey, 'size' AS measure, CAST(p_size AS DOUBLE) AS amount FROM part
UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part"""


def missing_values(spark, sf):
    holes = table(spark, sf, "customer").selectExpr(
        "c_custkey", "nullif(c_mktsegment, 'BUILDING') AS segment",
        "CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance", "c_nationkey",
    )
    return holes.na.fill({"segment": "unknown"}).na.drop(subset=["balance"]).withColumn(
        "nation", F.coalesce(F.nullif(F.col("c_nationkey"), F.lit(0)), F.lit(-1))
    ).drop("c_nationkey")


MISSING_VALUES = """SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'unknown') AS segment,
  c_acctbal AS balance, coalesce(nullif(c_nationkey, 0), -1) AS nation FROM customer WHERE c_acctbal > 0"""

QUERIES = {
    "select_filter": (select_filter, SELECT_FILTER),
    "equi_join_inner": (
        equi_join("inner"), JOIN_SIDES + " SELECT c_custkey, c_mktsegment, o_orderkey FROM l JOIN r USING (c_custkey)"
    ),
    "equi_join_left": (
        equi_join("left"), JOIN_SIDES + " SELECT c_custkey, c_mktsegment, o_orderkey FROM l LEFT JOIN r USING (c_custkey)"
    ),
    "equi_join_right": (
        equi_join("right"), JOIN_SIDES + " SELECT c_custkey, c_mktsegment, o_orderkey FROM l RIGHT JOIN r USING (c_custkey)"
    ),
    "equi_join_full": (
        equi_join("full"), JOIN_SIDES + " SELECT c_custkey, c_mktsegment, o_orderkey FROM l FULL JOIN r USING (c_custkey)"
    ),
    "equi_join_semi": (
        equi_join("left_semi"), JOIN_SIDES + " SELECT c_custkey, c_mktsegment FROM l SEMI JOIN r USING (c_custkey)"
    ),
    "equi_join_anti": (
        equi_join("left_anti"), JOIN_SIDES + " SELECT c_custkey, c_mktsegment FROM l ANTI JOIN r USING (c_custkey)"
    ),
    "group_distinct": (group_distinct, GROUP_DISTINCT),
    "group_approx_distinct": (group_approx_distinct, GROUP_APPROX),
    "top_orders": (top_orders, TOP_ORDERS),
    "top_per_group": (top_per_group, TOP_PER_GROUP),
    "concat_dedupe": (concat_dedupe, CONCAT_DEDUPE),
    "pivot": (pivot, PIVOT),
    "unpivot": (unpivot, UNPIVOT),
    "missing_values": (missing_values, MISSING_VALUES),
}
