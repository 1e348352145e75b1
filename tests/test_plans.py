"""What the physical plans must and must not have."""

import pytest

from creaseline.catalog import QUERIES
from creaseline.plans.reports import REPORTS
from tests.conftest import SF_SMALL

REPORT_KEYS = [f"kpi{n:02d}_{name}" for n, name in enumerate(REPORTS, start=1)]


def plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", REPORT_KEYS)
def test_reports_use_hash_aggregates_and_no_expansion(spark, name):
    text = plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "SortAggregate", "ObjectHashAggregate", "Python", "BroadcastExchange"):
        assert node not in text, node
    assert "SinglePartition" not in text
    assert "TakeOrderedAndProject" in text or not REPORTS[name[6:]].order == ()


def test_reports_read_only_their_columns(spark):
    text = plan(spark, "kpi08_most_sixes")
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double,l_linestatus:string>" in text


def test_filter_on_match_type_prunes_partitions(spark, folder):
    from creaseline.plans.match_data import MatchData
    from creaseline.plans.reports import report
    from creaseline.sinks.tables import write_clean_balls
    from creaseline.sources import bridge
    write_clean_balls(spark, bridge.balls(spark, SF_SMALL), folder + "/t")
    late = report("death_over_economy", MatchData(spark.read.parquet(folder + "/t")))
    text = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(match_type" in text and "GreaterThanOrEqual(over_num,15)" in text


def test_last_windows_are_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(spark, "serve_rr_trend")


@pytest.mark.parametrize("name", ["jn_first_innings", "win_first_per_group", "kpi13_win_batting_first__frame", "kpi16_lowest_successful_chases__frame", "jn_player_team", "st_live_kpis_batch"])
def test_balls_are_added_up_by_hash_before_anything_is_sorted(spark, name):
    """Below each sorted aggregate stands a hash aggregate, nearer to the scan."""
    lines = plan(spark, name).splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    for at, line in enumerate(lines):
        if "SortAggregate" in line:
            below = [other for k, other in enumerate(lines[at + 1:], at + 1) if depth[k] > depth[at]]
            assert any("HashAggregate" in other and "Object" not in other for other in below), line
