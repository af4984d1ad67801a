"""Physical-plan checks: no cartesian products, no row-at-a-time Python, filters and
column pruning reach the parquet scans."""

import pytest

from tests.conftest import SF_SMALL

PLANNED = ["cold_start_genres", "popularity", "user_segment_matrix", "content_neighbours",
           "content_neighbours_all_users", "co_rating_scores", "user_ensemble", "segment_recommend",
           "watched_segments_all_users", "eval_rbo", "similarity_bands", "closest_by_genres", "silhouette_sample"]


def _plan(entry, spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_cartesian_or_row_python(spark, entry, name):
    plan = _plan(entry, spark, name)
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan  # only Arrow-batched pandas functions are allowed


def test_positive_filter_reaches_scan(spark, entry):
    plan = _plan(entry, spark, "positive_ratings")
    assert "GreaterThan(l_quantity,35.0)" in plan


def test_scan_reads_only_needed_columns(spark, entry):
    plan = _plan(entry, spark, "popularity")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans
    for s in scans:
        assert "l_extendedprice" not in s and "l_shipdate" not in s


def test_per_request_topk_uses_group_limit(spark, entry):
    df = entry.queries()["segment_recommend"](spark, SF_SMALL)
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["content_neighbours", "nearest_in_cluster", "peer_selection", "genre_subset", "silhouette",
                                  "assign_centroid", "watched_segments_all_users"])
def test_no_pair_products_without_broadcasts(spark, entry, name):
    """With automatic broadcasts off, nothing falls back to a product of two tables (scans without clusters
    still meet their one-row grid that way)."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "CartesianProduct" not in _plan(entry, spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_switches_on_size_are_left():
    import marquee.operators.neighbours as N

    assert not any(hasattr(N, n) for n in ("SMALL_SEED_ROWS", "MAX_BROADCAST_ROWS", "broadcast_if_small"))
