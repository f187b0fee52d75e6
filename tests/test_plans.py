"""Plan properties that matter at scale, checked on the physical plan."""

import __spark_entry__ as E
from touchline.plans.registry import QUERIES
from helpers import SF_SMALL
from touchline.plans import dashboards as D
from touchline.streaming.sinks import latest_from_history, read_history, write_history


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_metrics_are_hash_aggregated_with_pruned_scan(spark):
    df = E.queries()["player_metrics"](spark, SF_SMALL)
    p = _plan(df)
    assert "SortAggregate" not in p and p.count("HashAggregate") >= 2
    assert "partial_max_by" in p
    phys = df._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in phys


def test_top_k_windows_use_group_limit(spark):
    for name in ("squad_draft", "stamina_top5_other"):
        assert "WindowGroupLimit" in _plan(E.queries()[name](spark, SF_SMALL)), name


def test_top_scorers_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(E.queries()["top_scorers"](spark, SF_SMALL))


def test_prefix_scan_shuffles_its_narrow_table_once(spark):
    for name, exchanges in (("stamina_monotone", 1), ("stamina_audit", 2)):  # the audit groups by player after it
        df = E.queries()[name](spark, SF_SMALL)
        p = df._jdf.queryExecution().sparkPlan().toString()
        assert "Join" not in p and p.count("FileScan") == 1 and "touchline/scan-" in p, name
        assert _plan(df).count("Exchange hashpartitioning") <= exchanges, name


def test_history_reads_prune_and_push_down(spark, tmp_out):
    m = E.queries()["player_metrics"](spark, SF_SMALL)
    write_history(m, f"{tmp_out}/h", "r1", 0)
    write_history(m, f"{tmp_out}/h", "r2", 0)
    latest = latest_from_history(read_history(spark, f"{tmp_out}/h", "r1"))
    df = D.filtered_kpis(latest, team="A")
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in p and "EqualTo(player_equipo,A)" in p
    assert "SortAggregate" not in _plan(latest)


def test_no_python_execution_in_any_plan(spark):
    python_ops = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                  "PythonMapInArrow", "FlatMapCoGroupsInPandas", "AggregateInPandas")
    for name, fn in QUERIES.items():
        p = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(op in p for op in python_ops), name
