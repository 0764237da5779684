"""The physical plans the operators are meant to have."""

import re

import pytest
from pyspark.sql import functions as F

from checks.tables import EVENTS, PANEL, SERIES, Tables
from tests.conftest import SF
from tidepanel.operators import aggregates as A
from tidepanel.operators import filters as FL
from tidepanel.operators import ranking as R
from tidepanel.operators import windows as W
from tidepanel.panel import over_rows
from tidepanel.plans import features as P


@pytest.fixture(scope="module")
def t(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return Tables(spark, SF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern, text):
    return len(re.findall(pattern, text))


def test_feature_windows_share_one_exchange_and_sort(spark, t, tmp_path):
    t.daily.write.parquet(str(tmp_path / "daily"))
    daily = spark.read.parquet(str(tmp_path / "daily"))
    text = plan(P.feature_frame(daily, PANEL, normalization=False))
    assert count(r"Exchange hashpartitioning", text) == 1
    assert count(r"\bSort \[", text) == 1
    assert "Python" not in text


def test_aggregates_combine_before_the_shuffle(t):
    text = plan(A.entity_summary(t.lines, PANEL))
    assert "partial_avg" in text and "Python" not in text
    scan = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(c.split(":")[0] for c in scan.split(",")) == {"l_extendedprice", "l_returnflag"}


@pytest.mark.parametrize("make", [
    lambda t: FL.in_year(t.lines, "date", 2000),
    lambda t: FL.since(t.lines, "date", "2001-01-01"),
    lambda t: A.recent_entities(t.lines, PANEL, "2001-06-01"),
    lambda t: FL.outside(t.lines, "date", "1996-01-01", "2001-01-01"),
])
def test_time_filters_reach_the_scan(t, make):
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan(make(t))).group(1)
    assert "l_shipdate" in pushed


def test_tail_is_limited_before_the_shuffle(t):
    text = plan(R.tail_rows(t.series, SERIES, 60))
    assert count("WindowGroupLimit", text) >= 1


def test_top_n_needs_no_global_sort(t):
    assert "TakeOrderedAndProject" in plan(R.top_entities(t.lines, PANEL, 2))


def test_blocked_windows_never_partition_by_entity_alone(t):
    spec = EVENTS.with_(block_seconds=3600, block_rows=500)
    text = plan(W.add_rolling(t.readings, spec, ["pm2_5"], [7]))
    specs = re.findall(r"windowspecdefinition\(([^)]*)", text)
    assert specs and all("_run" in s or "_slot" in s for s in specs), specs


# Flows that solve or fit small systems in Python, or save a fitted model.
FITTED = {
    "model_gbt", "model_rf", "model_trend_seasonal", "model_trend_logistic", "model_with_regressors",
    "model_registry", "regressor_compare", "regressor_effects", "forecast_entity", "forecast_batch",
    "forecast_batch_summary", "forecast_report", "forecast_report_points", "forecast_naive_future",
    "forecast_service", "validate_entity", "validation_report", "cross_validation", "training_variants",
    "expected_horizon_range", "evaluate_models", "feature_importance_top20", "sink_model", "bucket_classes",
}


def test_no_operator_uses_python_rows(spark, t):
    from checks import QUERIES

    for name, make in QUERIES.items():
        if name not in FITTED and not name.startswith("line_"):
            text = plan(make(spark, SF))
            assert "PythonUDF" not in text and "MapInPandas" not in text, name
            assert "CartesianProduct" not in text, name


def test_over_rows_keeps_all_columns(t):
    rows = t.readings.select("city", "datetime", "event_id", "pm2_5")
    out = over_rows(rows, EVENTS.with_(block_seconds=3600), 1, 0,
                    lambda w: {"prev": F.lag("pm2_5", 1).over(w)})
    assert out.columns == ["city", "datetime", "event_id", "pm2_5", "prev"]
