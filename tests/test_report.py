"""The report from one pass against the single summaries."""

import pytest

from conftest import SMALL, rows
from marquee.operators import summary
from marquee.plans.report import summary_report
from marquee.plans.tables import MovieTables

SINGLE = {
    "yearly_movies": lambda t: summary.movies_per_year(t.movies),
    "yearly_genres_movies": lambda t: summary.genre_movies_per_year(t.movies),
    "genres_movies": lambda t: summary.movies_per_genre(t.movies),
    "yearly_watchings": lambda t: summary.ratings_per_year(t.ratings),
    "yearly_active_users": lambda t: summary.active_user_days_per_year(t.ratings),
    "genres_watchings": lambda t: summary.ratings_per_genre(t.ratings, t.movies),
    "totals": lambda t: summary.dataset_totals(t.ratings, t.movies),
}


def odd_tables(spark):
    """Nulls in every column, repeated records, movies without genres or year, ratings of unknown movies."""
    t = MovieTables(None, None, None)
    t.__dict__["ratings"] = spark.createDataFrame(
        [(1, 1, 4.0, "0", "1970-01-01"), (1, 1, 4.0, "0", "1970-01-01"), (1, 2, None, None, None), (2, 99, 3.5, "x", "1971-05-05"), (None, 1, 1.0, "0", "1970-01-01"), (3, None, 2.0, "0", None), (2, 3, 0.5, "0", "1971-05-05")],
        "userId int, movieId int, rating float, timestamp string, watching_date string",
    )
    t.__dict__["movies"] = spark.createDataFrame(
        [(1, "A (1990)", "x|y|x", "1990"), (2, "B", None, None), (3, "", "", ""), (3, "C (1990)", "y", "1990"), (None, "D", "z", "1991")],
        "movieId int, title string, genres string, production_year string",
    )
    return t


@pytest.mark.parametrize("kind", ["clean", "dirty", "odd", "empty"])
def test_every_part_equals_its_own_summary(spark, small, kind):
    t = {"clean": lambda: small, "dirty": lambda: MovieTables.from_driver_tables(spark, SMALL, dirty=True), "odd": lambda: odd_tables(spark), "empty": lambda: odd_tables(spark)}[kind]()
    if kind == "empty":
        t.__dict__.update(ratings=t.ratings.limit(0), movies=t.movies.limit(0))
    report = summary_report(t)
    assert report.keys() == SINGLE.keys()
    for name, single in SINGLE.items():
        want = single(t)
        assert report[name].columns == want.columns
        assert rows(report[name]) == rows(want), name


def test_the_ratings_are_scanned_once(spark, small):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    scans = lambda df: sum("FileScan" in line and "lineitem" in line for line in plan(df).splitlines())
    assert scans(summary.rating_sets(small.ratings)) == 1
    assert all(scans(df) == 0 for df in summary_report(small).values())
