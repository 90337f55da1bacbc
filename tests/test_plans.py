"""Plan shape: what must not appear at scale."""

from __future__ import annotations

from tests.conftest import SF_SMALL
from tidemark import catalog
from tidemark.sources import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_correlation_has_no_nested_loop_or_cartesian(spark):
    for name in ("trading_vs_security", "cross_domain"):
        plan = _plan(catalog.REGISTRY[name](spark, SF_SMALL))
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name


def test_running_totals_move_rows_once(spark):
    from tidemark.plans import marts

    plan = _plan(marts.trading_summary(fx.trades(spark, SF_SMALL)))
    main = plan.split("Subquery")[0] if plan.lstrip().startswith("Subquery") else plan
    assert main.count("Exchange shufflepartitionidpassthrough") == 1
    assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan
    lines = plan.splitlines()
    for i, ln in enumerate(lines):        # every other exchange carries aggregated rows: the sketch or range totals
        if "Exchange SinglePartition" in ln or "Exchange hashpartitioning" in ln:
            below = next(x for x in lines[i + 1:] if "Sort [" not in x and "InputAdapter" not in x)
            assert "Aggregate" in below, below


def test_dimensions_and_loads_use_hash_aggregates(spark):
    from tidemark.operators import keyed_load

    rows = spark.range(10).selectExpr("id AS k", "'x' AS v", "id AS __pos")
    assert "SortAggregate" not in _plan(keyed_load.first_per_key(rows, ("k",)))
    assert "SortAggregate" not in _plan(catalog.REGISTRY["dim_rule"](spark, SF_SMALL))


def test_cross_domain_reads_wide_columns_once(spark):
    """The sketch of the sweep, its range totals and the bucket sizes read times and keys again, nothing else."""
    schemas = [x.split("\n")[0] for x in _plan(catalog.REGISTRY["cross_domain"](spark, SF_SMALL)).split("ReadSchema: ")[1:]]
    assert sum("rule_description" in x for x in schemas) == 1
    assert len(schemas) <= 20


def test_scans_are_pruned_and_filtered(spark):
    from tidemark.plans import marts

    df = marts.daily_pnl(fx.trades(spark, SF_SMALL))
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,error))]" in plan
    assert "props" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_no_cross_join_in_kpi(spark):
    plan = _plan(catalog.REGISTRY["kpi"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_keyed_alert_lookup_prunes_partitions(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import keyed_load
    from tidemark.plans import scenarios
    from tidemark.session import scratch_path
    from tidemark.sources import alert_json

    alerts = scenarios.alert_ingest(spark, SF_SMALL).withColumn("day", alert_json.alert_day())
    path = scratch_path(spark, "keyed_alerts")
    keyed_load.keyed_append(spark, path, alerts.where(F.dayofmonth("timestamp") <= 20), ("alert_id",),
                            prune_col="day")
    look = ["day", "alert_id"]
    hits = spark.read.parquet(path).select(*look).join(
        alerts.where(F.dayofmonth("timestamp") > 20).select(*look), look, "left_semi")
    assert "dynamicpruningexpression(day" in _plan(hits)
