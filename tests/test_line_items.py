"""The joins below the sales that the checks read."""

from __future__ import annotations

from almacen.checks import mapping


def test_customers_join_orders_and_not_line_items(spark):
    rows = mapping.line_items(spark, "/root/testdata/sf0.001")
    tree = rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
    place = next(i for i, line in enumerate(tree) if "Join" in line and "(o_custkey" in line)
    depth = tree[place].index("Join")
    below = []
    for line in tree[place + 1 :]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        below.append(line)
    assert any("c_custkey" in line for line in below)
    assert not any("l_orderkey" in line for line in below)
