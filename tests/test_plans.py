"""Plan shape of every batch query: the scale rules SURVEY §7.2 asks to check."""

import re

import pytest

from tickforge.plans import catalog

# Streaming and incremental queries run their writes while building the
# DataFrame; their operators are the batch ones checked here.
BATCH = sorted(n for n in catalog.QUERIES if not n.startswith(("stream_", "incremental_")))


@pytest.mark.parametrize("name", BATCH)
def test_plan_has_no_nested_loop_cross_or_global_window(spark, small_dir, name):
    df = catalog.QUERIES[name](spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    for spec in re.findall(r"windowspecdefinition\(([^,]+),", plan):
        # a window whose first argument is an ORDER BY term has no PARTITION BY
        assert not re.search(r"\b(ASC|DESC)\b", spec), f"global window in {name}: {spec}"


def test_scans_are_pruned(spark, small_dir):
    df = catalog.QUERIES["futures_term_structure"](spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for read_schema in schemas:
        assert "props" not in read_schema and "event_type" not in read_schema


def test_global_window_would_be_caught(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("c", F.sum("id").over(Window.orderBy("id")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    specs = re.findall(r"windowspecdefinition\(([^,]+),", plan)
    assert specs and re.search(r"\b(ASC|DESC)\b", specs[0])
