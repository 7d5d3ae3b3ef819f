"""What queries write on their way is small beside the text they make."""

import glob
import os

import __spark_entry__ as entry
import sievelog as sl

SF = "/root/testdata/sf0.001"


def test_long_lines_are_stored_compressed(spark):
    with sl.scratch_scope(spark):
        rows = entry.queries()["csv_long_lines"](spark, SF)
        chars = sum(r.chars for r in rows.collect())
        path = os.path.dirname(rows.inputFiles()[0]).removeprefix("file://")
        stored = sum(os.path.getsize(f) for f in glob.glob(f"{path}/part-*"))
    assert 0 < stored < chars / 10
