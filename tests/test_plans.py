"""Physical-plan properties that matter at scale."""
import re

import pytest

from conftest import SF001
from duelframe.plans.catalog import QUERIES
from duelframe.plans.pipeline import ContestPipeline
from duelframe.sources.fixtures import bouts

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_in_any_query(spark, name):
    text = plan(QUERIES[name](spark, SF001))
    assert not any(n in text for n in PY_NODES), name


def test_topk_ranks_are_partial_before_the_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = bouts(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # a WindowGroupLimit below the exchange keeps k rows per group per map task
    assert text.count("WindowGroupLimit") >= 4


def test_split_labels_without_shuffle_or_window(spark):
    p = ContestPipeline.for_input(spark, SF001)
    text = plan(p.split())
    assert "Exchange" not in text and "Window" not in text and "Sort" not in text


def _scans(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"ReadSchema: struct<([^>]*)>", text) or \
        re.findall(r"FileScan parquet \[([^\]]*)\]", text)


@pytest.mark.parametrize("name", ["missing_profile", "dtype_census", "column_audit",
                                  "leakage_census", "feature_groups", "feature_checks",
                                  "rank_coverage", "class_balance"])
def test_profiles_read_the_stage_once(spark, name):
    scans = _scans(QUERIES[name](spark, SF001))
    assert len(scans) == 1, (name, scans)


def test_scan_prunes_columns(spark):
    scans = _scans(QUERIES["yearly_trend"](spark, SF001))
    assert len(scans) == 1
    cols = {c.split(":")[0].split("#")[0].strip() for c in scans[0].split(",")}
    assert cols == {"Date", "Winner"}


SKIP = {"Project", "Filter", "Sort", "InputAdapter", "WholeStageCodegen", "ColumnarToRow",
        "AQEShuffleRead", "ShuffleQueryStage", "Window", "Exchange"}
BOUNDED = ("TakeOrderedAndProject", "GlobalLimit", "LocalLimit", "BroadcastNestedLoopJoin", "LocalTableScan")
#: Columns whose distinct values don't grow with the rows: dates, classes, sides, categories, buckets.
SMALL_KEYS = {"Date", "target", "class", "split", "_side", "_cls", "value", "feature", "bin", "_b", "dtype", "year",
              "majority_class", "Winner", "WeightClass", "stance_matchup", "i", "lo", "hi"}


def _below_single_partition(text):
    """(operator name, its line) directly under each SinglePartition exchange."""
    lines = text.splitlines()
    found = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        for nxt in lines[i + 1:]:
            name = re.sub(r"^[\s:+\-*()\d]*", "", nxt).split(" ")[0].split("(")[0]
            if name and name not in SKIP:
                found.append((name, nxt))
                break
    return found


def _bounded(name, line):
    """A limit or one-row input, or an aggregate whose keys are all small."""
    if name.startswith(BOUNDED):
        return True
    keys = re.search(r"keys?=\[([^\]]*)\]", line)
    if "Aggregate" not in name or keys is None:
        return False
    return all(re.sub(r"#\d+L?$", "", k.strip()) in SMALL_KEYS for k in re.findall(r"[A-Za-z_]\w*#\d+L?", keys[1]))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_single_partition_only_over_bounded_inputs(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for op, line in _below_single_partition(text):
        assert _bounded(op, line), (name, line)


def test_the_plan_test_can_fail(spark):
    """A single-task window over scores grouped by value must be refused."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    scored = ContestPipeline.for_input(spark, SF001).rule_scored()
    bad = (scored.groupBy("score").agg(F.sum("target").alias("n"))
           .withColumn("below", F.sum("n").over(Window.orderBy("score"))))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = bad._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert not all(_bounded(op, line) for op, line in _below_single_partition(text))


def test_split_bound_reaches_the_scan(spark):
    p = ContestPipeline.for_input(spark, SF001)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(Date", plan(p.test()))
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(Date", plan(p.train()))
    assert p.train().count() + p.test().count() == p.split().count()


def test_wide_plans_are_split_and_stages_take_smaller_tasks(spark):
    from duelframe.session import SMALLER_TASKS, apply_defaults, smaller_tasks
    apply_defaults(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    was = [spark.conf.get(k) for k, _, _ in SMALLER_TASKS]
    with smaller_tasks(spark):
        assert [spark.conf.get(k) for k, _, _ in SMALLER_TASKS] == ["32m", "16m"]
    assert [spark.conf.get(k) for k, _, _ in SMALLER_TASKS] == was
    spark.conf.set(SMALLER_TASKS[0][0], "1000000")
    try:
        with smaller_tasks(spark):
            assert spark.conf.get(SMALLER_TASKS[0][0]) == "1000000"
        assert spark.conf.get(SMALLER_TASKS[0][0]) == "1000000"
    finally:
        spark.conf.unset(SMALLER_TASKS[0][0])


def test_bouts_are_sorted_before_they_widen(spark):
    """The sort of the raw stage holds the joined columns, not the hundred derived ones; the rows are the same."""
    from conftest import SF0001
    from duelframe.sources import fixtures
    df = fixtures.bouts(spark, SF0001, by_date=True)
    sort = df._jdf.queryExecution().optimizedPlan()
    while sort.getClass().getSimpleName() != "Sort":
        sort = sort.children().head()
    assert sort.output().size() < 30 < len(df.columns)
    parts = df.select("Date", "bout_id").rdd.glom().collect()
    assert all(p == sorted(p) for p in parts)
    assert df.exceptAll(fixtures.bouts(spark, SF0001)).count() == 0
