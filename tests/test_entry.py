import __spark_entry__ as entry


def test_entry_runs_and_catalog_consistent(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"driver", "lap_number", "mean_speed_kmh", "brake_fraction"} <= set(df.columns)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_lap_summary_plan_has_no_python_and_pushes_filters(spark):
    df = entry.queries()["lap_telemetry_summary"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
