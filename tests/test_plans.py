"""Plan guards: the properties that matter at scale, checked on the
physical plans of every registered query."""

import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cabmetrics.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def _explain(df, mode: str = "formatted") -> str:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def _plan(df) -> str:
    return _explain(df) + df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cross_join_or_python_udf(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_cleaning_filters_reach_parquet(spark):
    plan = _explain(entry.queries()["scan_parquet"](spark, SF))
    assert "PushedFilters" in plan
    box = [f"{op}({end}_{axis}," for op in ("GreaterThanOrEqual", "LessThanOrEqual") for end in ("pickup", "dropoff") for axis in ("longitude", "latitude")]
    for pred in ("GreaterThanOrEqual(passenger_count,1)", "LessThanOrEqual(passenger_count,6)", "IsNotNull(pickup_datetime)", "GreaterThanOrEqual(fare_amount,1.0)", "LessThanOrEqual(fare_amount,500.0)", *box):
        assert pred in plan


def test_column_pruning(spark):
    plan = _explain(entry.queries()["sample_to_size"](spark, SF))
    assert "ReadSchema: struct<key:string,fare_amount:double>" in plan


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _explain(entry.queries()["head_n"](spark, SF))


def test_temporal_panels_single_scan(spark):
    plan = _explain(entry.queries()["temporal_profile"](spark, SF))
    scans = [ln for ln in plan.splitlines() if ln.startswith("(") and "Scan parquet" in ln]
    assert "Expand" not in plan and len(scans) == 1


def test_large_source_of_one_row_group_is_spread_over_the_table(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    from cabmetrics.plans import common

    pq.write_table(pq.read_table(f"{SF}/events.parquet"), tmp_path / "events.parquet")
    shutil.copy(f"{SF}/orders.parquet", tmp_path / "orders.parquet")
    monkeypatch.setattr(common, "ROWS_PER_PARTITION", 50)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # many splits, of which one holds the row group
    try:
        table = common.raw_trips(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = table.count()
    held = [r["n"] for r in table.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert rows > 8 * 50 and sum(held) == rows
    assert len(held) == common.table_partitions(rows) == -(-rows // 50) and max(held) <= 2 * 50
