"""How the checks build their input, which must not pass through one task."""

from __future__ import annotations

import glob

from almacen.checks.catalog import CHECKS
from almacen.checks.derived import derived


def test_malformed_lines_are_written_by_all_tasks(spark, tmp_path):
    rows = [(i, f'text "{i}", of\nlines') for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task for each file
    try:
        found = CHECKS["s01b_malformed_lines"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r.doc_id for r in found) == [i for i in range(90) if i % 3 == 1]
    folder = derived(spark, str(tmp_path)).folder
    texts = [open(f).read().split("\n") for f in glob.glob(f"{folder}/malformed_csv/part-*")]
    assert len([lines for lines in texts if len(lines) > 2]) > 1
    assert all(lines[0] == "a,b,c" for lines in texts if lines != [""])
    assert sum(len(lines) - 2 for lines in texts if lines != [""]) == 90
