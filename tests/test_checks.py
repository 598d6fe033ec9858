"""Every registered query against its DuckDB equivalent."""

from __future__ import annotations

import pytest
from compare import difference, duck

import __spark_entry__ as entry_points
from almacen.checks.catalog import CHECKS

SF_DIR = "/root/testdata/sf0.001"
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", CHECKS)
def test_query_matches_sql(spark, connection, key):
    result = entry_points.queries()[key](spark, SF_DIR)
    assert difference(result, connection, ORACLE[key]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_line_of_the_inventory_has_a_query():
    wanted = [f"s{i:02}" for i in range(1, 6)] + [f"t{i:02}" for i in range(1, 13)]
    wanted += [f"f{i:02}" for i in range(1, 5)] + [f"l{i:02}" for i in range(1, 4)]
    wanted += [f"d{i:02}" for i in range(1, 15)] + [f"m{i:02}" for i in range(1, 7)]
    wanted += [f"q{i:02}" for i in range(1, 15)] + [f"b{i:02}" for i in range(1, 25)]
    wanted += [f"e{i:02}" for i in range(1, 7)] + [f"k{i:02}" for i in range(1, 6)]
    keys = [key.split("_")[0] for key in entry_points.queries()]
    assert [w for w in wanted if w not in keys] == []
