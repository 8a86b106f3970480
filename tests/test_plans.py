"""Plan invariants of every registered query (planned, not run): the shapes that do not scale never appear."""

import pytest

import __spark_entry__ as E
from conftest import SMALL

WRITERS = {"scan_movies", "scan_ratings", "scan_tags", "sink_csv_roundtrip", "save_tables", "export_summaries", "snapshot_tables", "interactions_upserted", "quarantine_counts", "sketched_users_per_year", "report_one_pass", "indexed_title_contains", "indexed_genre_contains", "indexed_movies_by_year", "saved_user_ratings"}
MODEL = {"als_predictions", "als_predicted_records", "als_metrics", "recommendations", "recommendation_ranks", "recommend_all_users", "recommend_all_ranks", "top_inner_products", "cold_start_predictions"}
CORE = {k for k in E.queries() if not (k == "pipeline" or k.startswith("op") and k[2].isdigit())}
FORBIDDEN = ("SortAggregate", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "Exchange SinglePartition, ENSURE_REQUIREMENTS")


def _plan(spark, key):
    return E.queries()[key](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(CORE - WRITERS - MODEL))
def test_no_unscalable_operator(spark, key):
    plan = _plan(spark, key)
    for bad in FORBIDDEN:
        if bad.startswith("Exchange SinglePartition") and key in {"dataset_totals", "genre_detail_totals", "mean_predictor_metrics"}:
            continue  # one-row global totals: only their partial results meet in one partition
        assert bad not in plan, f"{key}: {bad}"


def test_top_k_has_no_global_sort(spark):
    for key in ("top_rated", "top_watched"):
        plan = _plan(spark, key)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_samples_per_group_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in _plan(spark, "genre_counts_samples")


def test_windows_never_run_over_raw_ratings(spark):
    # favourites and thresholds window over per-(user, genre) aggregates: each Window sits above an aggregate
    for key in ("favourite_genres", "liked_genres", "taste_pairs"):
        plan = _plan(spark, key)
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if line.lstrip(" :+-").startswith("Window "):
                below = "\n".join(lines[i + 1 :])
                assert "HashAggregate" in below, key


@pytest.fixture
def large_sides(spark):
    """No side is small enough to be broadcast, as with tables far beyond these."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n in names:
        spark.conf.unset(n)


@pytest.mark.parametrize("key", sorted(CORE - WRITERS - MODEL))
def test_no_unscalable_operator_without_broadcasts(spark, large_sides, key):
    plan = _plan(spark, key)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{key}: {bad}"


ON_SOURCE_COLUMN = {
    "user_ratings": "o_custkey", "users_ratings": "o_custkey", "movie_by_id": "p_partkey", "titles_by_users": "o_custkey",
    "user_detail_totals": "o_custkey", "user_history": "o_custkey", "user_movie_count": "o_custkey",
    "user_genre_count": "o_custkey", "movie_summary_by_id": "l_partkey", "user_genre_profile": "o_custkey",
    "favourite_genre_of_user": "o_custkey", "user_genre_ratings": "o_custkey", "user_genre_watches": "o_custkey",
    "taste_shared": "o_custkey", "taste_only_first": "o_custkey", "taste_only_second": "o_custkey",
    "taste_both_like": "o_custkey", "taste_pairs": "o_custkey",
}


@pytest.mark.parametrize("key", sorted(ON_SOURCE_COLUMN))
def test_id_filters_reach_the_reader(spark, key):
    plan = _plan(spark, key)
    pushed = " ".join(line for line in plan.splitlines() if "PushedFilters" in line)
    column = ON_SOURCE_COLUMN[key]
    assert f"EqualTo({column}," in pushed or f"In({column}," in pushed, key


def test_interactions_take_one_shuffle_beyond_the_join(spark, large_sides):
    plan = _plan(spark, "interactions")
    assert plan.count("Exchange hashpartitioning(userId") == 1 and "SortAggregate" not in plan


def test_top_lists_join_titles_after_the_limit(spark, large_sides):
    for key in ("top_rated", "top_watched"):
        plan = _plan(spark, key)
        assert "LeftSemi" in plan and plan.count("TakeOrderedAndProject") == 2


def test_a_hot_movie_is_summed_before_it_is_joined(spark, large_sides):
    from marquee.operators.profile import movie_watch_summary
    from marquee.plans.registry import tables

    t = tables(spark, SMALL)
    plan = movie_watch_summary(t.interactions, t.movies)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert any("HashAggregate(keys=[movieId" in line for line in lines[join:]) and not any("HashAggregate" in line for line in lines[:join])
