"""The model build: every model written in dependency order, and the column tests declared on the models."""

from __future__ import annotations

from tests.conftest import SF_SMALL
from tidemark.plans import pipeline
from tidemark.session import scratch_path
from tidemark.sources import fixtures as fx


def test_models_build_and_pass_their_tests(spark):
    paths = pipeline.build_models(
        spark, fx.trades(spark, SF_SMALL), fx.alerts(spark, SF_SMALL), fx.benchmark_prices(spark, SF_SMALL),
        fx.ip_geo(spark, SF_SMALL), scratch_path(spark, "warehouse"),
    )
    assert list(paths) == list(pipeline.TABLE_MODELS)
    rows = {r.model: r.rows for r in pipeline.model_rows(spark, paths).collect()}
    assert rows["fct_trades"] == fx.trades(spark, SF_SMALL).count()
    assert rows["mart_kpi"] == 1
    results = pipeline.model_tests(spark, paths).collect()
    assert results and all(r.success for r in results)


def test_daily_run_twice(spark):
    import datetime as dt

    from tidemark.operators import keyed_load
    from tidemark.plans import daily, scenarios

    inputs = daily.Inputs(scenarios.write_broker_files(spark, SF_SMALL), scenarios.write_alert_lines(spark, SF_SMALL),
                          fx.benchmark_prices(spark, SF_SMALL), fx.ip_geo(spark, SF_SMALL))
    base = scratch_path(spark, "daily")
    first = daily.run(spark, inputs, base, dt.date(2024, 2, 1), raise_on_failure=False)
    again = daily.run(spark, inputs, base, dt.date(2024, 2, 2), raise_on_failure=False)
    n = fx.trades(spark, SF_SMALL).count()
    assert first.loads["trades"].inserted == n and again.loads["trades"].inserted == 0
    assert first.versions["trades"] == 1 and "trades" not in again.versions
    table = keyed_load.read_table(spark, f"{base}/raw/trades")
    assert table.select("id").distinct().count() == n and "loaded_at" in table.columns
    # some alerts have no time: the checks fail, and nothing is published
    assert not first.published and first.checks.where("NOT success").count() == 1
    assert "loaded_at" in spark.read.parquet(again.models["fct_trades"]).columns
