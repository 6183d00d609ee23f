"""Plain relational queries at the edges and by their plans."""

import re

from workload import relational


def test_sketch_is_kept_per_flag_not_per_order(spark, tmp_path):
    rows = [("A", k // 2) for k in range(600)] + [("N", None), ("N", 1), (None, 1), (None, 2), (None, 2)]
    spark.createDataFrame(rows, "l_returnflag string, l_orderkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = relational.group_approx_distinct(spark, str(tmp_path))
    assert {tuple(r) for r in got.collect()} == {("A", 300, True), ("N", 1, True), (None, 2, True)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"Aggregate\(keys=\[([^\]]*)\], functions=\[([^\n]*)", plan)
    assert found and not any("l_orderkey" in keys and "approx_count_distinct" in functions for keys, functions in found)
