"""Shape of the physical plans."""

import pytest

import __spark_entry__ as entry_module

PLANNED = [
    "c02_broadcast_calendar", "c04_time_bucket_join", "c07_cross_join_grid", "c09_left_join_grid", "c13_point_in_polygon",
    "c14_points_per_area", "c15_nearest_join", "c16_distance_to_lines", "c17_knn_join", "d05_mode_per_group", "d13_rank_thresholds",
    "e01_lag_demand", "e04_last_known_fill", "e06_forward_fill", "h04_hour_band", "j06_scale_fit_apply", "j13_demand_dataset",
    "j14_preprocess",
]


def plan(spark, sf_dir, key):
    return entry_module.queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PLANNED)
def test_no_cross_join_and_no_python(spark, sf_dir, key):
    text = plan(spark, sf_dir, key)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert node not in text, node


def test_ranks_are_limited_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(spark, sf_dir, "e07_last_n_per_key")
    assert "WindowGroupLimit" in plan(spark, sf_dir, "c05_argmax_self_join")


def test_top_k_needs_no_global_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(spark, sf_dir, "f01_top_k")


def test_only_needed_columns_are_read(spark, sf_dir):
    assert "ReadSchema: struct<c_custkey:bigint>" in plan(spark, sf_dir, "b26_drop_noise").replace(",c_nationkey:int", "")
    text = plan(spark, sf_dir, "a16_nested_column_prune")
    assert "capacity" not in text and "place:struct<lon:double>" in text


def test_range_filters_reach_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "b27_distance_filters")
    assert "PushedFilters" in text and "LessThan(value,60" in text


def test_density_layers_take_one_spatial_join(spark, sf_dir):
    text = entry_module.queries()["d14_density_layers"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.split("\n") if "Window [" in line]
    assert windows and all("windowspecdefinition(_layer" in w for w in windows)
    # the areas' levels and the spatial join, each with the three layers, and the areas' bands of edges
    assert text.count("scalar-subquery") <= 2 and text.count("Relation [") <= 15


def test_demand_reads_the_status_once(spark, sf_dir):
    text = entry_module.queries()["j13_demand_dataset"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    # status and weather come from one table, calendar and stations from one each
    assert text.count("Relation [") <= 5


def test_hours_of_the_completed_table_are_not_shuffled(spark, sf_dir):
    # the hours are made after the last join, so only days and facts travel
    above = plan(spark, sf_dir, "j14_preprocess").split("Join")[0]
    assert "inline(" in above and "Exchange" not in above
