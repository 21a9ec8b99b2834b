"""Plan shape: pushdown and pruning reach the scan, top-k is TakeOrderedAndProject, per-key windows are
partitioned by (key, slice), folds run as one mapInPandas."""

from pulsegrid.operators import store
from pulsegrid.plans import catalog
from pulsegrid.sources import fixtures, tables

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    ev = tables.events(spark, SF).filter("user_id = 3").select("event_id")
    p = _plan(ev)
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,3)]" in p
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in p


def test_list_is_take_ordered(spark):
    p = _plan(store.list_telemetry(fixtures.telemetry_table(spark, SF), store.ListFilter(limit=5)))
    assert "TakeOrderedAndProject" in p


def test_detect_window_partitioned_by_slice(spark):
    p = _plan(catalog.detect_sustained(spark, SF))
    assert "hashpartitioning(patient_id" in p and "_slice" in p


def test_fold_is_streaming_map(spark):
    p = _plan(catalog.rate_limit_decisions(spark, SF))
    assert "MapInPandas" in p and "FlatMapGroupsInPandas" not in p
