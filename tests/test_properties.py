"""Counts of FIXTURES.md section 3 and properties that tie operators together, on the sf0.001 tables."""

import math

from pyspark.sql import functions as F

from conftest import SMALL, rows
from marquee.operators import distribution, lookup, profile, summary, taste
from marquee.plans.tables import MovieTables


def test_fixture_counts(small):
    assert small.movies.count() == 200
    assert small.movie_genres.count() == 800
    assert small.ratings.count() == 6000
    assert small.interactions.count() == 6014
    assert small.interactions.where(F.col("rating").isNull()).count() == 632
    assert small.wide.count() == 24056
    assert small.ratings.select("userId").distinct().count() == 150


def test_dirty_counts(spark):
    dirty = MovieTables.from_driver_tables(spark, SMALL, dirty=True)
    assert dirty.ratings.count() == 5933
    assert dirty.ratings.where(F.col("rating").isNull()).count() == 49
    assert dirty.movies.count() == 194
    assert dirty.movies.where(~F.col("production_year").rlike("^[0-9]{4}$")).count() == 4


def test_interaction_sum_rule(small):
    rated = small.ratings.select("userId", "movieId").distinct()
    tagged = small.tags.select("userId", "movieId").distinct()
    both = rated.intersect(tagged).count()
    assert small.interactions.count() == rated.count() + tagged.count() - both


def test_liked_and_disliked_are_disjoint(small):
    prof = profile.user_genre_profile(small.ratings, small.movies)
    liked = profile.liked_genres(prof).select("userId", "genre")
    disliked = profile.disliked_genres(prof).select("userId", "genre")
    assert liked.intersect(disliked).count() == 0
    assert liked.count() == 1237 and disliked.count() == 1765


def test_only_first_plus_shared_is_the_whole_profile(small):
    prof = taste.pair_profile(small.ratings, small.movies, [1, 5])
    only = {r.genre for r in taste.taste_only_first(prof, 1, 5).collect()}
    shared = {r.genre for r in taste.taste_shared(prof, 1, 5).collect()}
    mine = {r.genre for r in prof.where("userId = 1").collect()}
    assert only | shared == mine and not (only & shared)
    assert {r.genre for r in taste.genre_set_except(prof, 1, 5).collect()} == only


def test_pair_frames_have_documented_sizes(small):
    prof = taste.pair_profile(small.ratings, small.movies, [1, 5])
    assert taste.taste_shared(prof, 1, 5).count() == 27
    assert taste.taste_both_like(prof, 1, 5).count() == 2
    assert taste.taste_both_dislike(prof, 1, 5).count() == 2
    assert taste.taste_like_dislike(prof, 1, 5).count() == 2
    assert taste.taste_dislike_like(prof, 1, 5).count() == 2


def test_self_comparison_has_distinct_columns(small):
    prof = taste.pair_profile(small.ratings, small.movies, [1])
    shared = taste.taste_shared(prof, 1, 1)
    assert len(set(shared.columns)) == len(shared.columns)
    assert shared.count() == prof.count()


def test_yearly_counts_sum_to_dated_ratings(small):
    total = summary.ratings_per_year(small.ratings).agg(F.sum("num_of_watchings")).first()[0]
    assert total == small.ratings.where(F.col("watching_date").isNotNull()).count()
    assert summary.ratings_per_year(small.ratings).count() == 7


def test_strict_favourites_within_coded(small):
    strict = profile.favourite_genres_strict(small.wide).select("userId", "genre")
    coded = profile.favourite_genres(small.wide).select("userId", "genre")
    assert strict.subtract(coded).count() == 0


def test_histogram_counts_sum_to_users_with_a_mean(small):
    hist = distribution.genre_rating_histogram(small.wide)
    stats = profile.genre_stats(small.wide).where(F.col("avgRating").isNotNull())
    per_genre = dict(rows(stats.groupBy("genre").count()))
    sums = dict(rows(hist.groupBy("genre").agg(F.sum("num_users"))))
    assert sums == per_genre
    assert set(rows(hist.groupBy("genre").count(), "count")) == {(10,)}


def test_histogram_of_equal_values_uses_middle_bin(spark):
    values = spark.createDataFrame([("g", 3.0), ("g", 3.0), ("h", 1.0), ("h", 2.0)], "k string, v double")
    hist = distribution.equal_width_histogram(values, "k", "v")
    g = {r.bin: r.num_users for r in hist.where("k = 'g'").collect()}
    assert g[5] == 2 and sum(g.values()) == 2
    h = {r.bin: (r.bin_start, r.num_users) for r in hist.where("k = 'h'").collect()}
    assert h[0] == (1.0, 1) and h[9][1] == 1 and math.isclose(h[9][0], 1.9)


def test_unknown_user_gives_empty_frames(small):
    assert lookup.user_ratings(small.ratings, small.movies, 99999999).count() == 0
    totals, history = lookup.user_detail(small.ratings, small.movies, [99999999])
    assert rows(totals) == [(99999999, 0, 0)] and history.count() == 0
    assert profile.favourite_genre_of_user(small.wide, 99999999).count() == 0


def test_dataset_totals_one_row(small):
    (row,) = summary.dataset_totals(small.ratings, small.movies).collect()
    assert row.num_movies == 200 and row.num_ratings == 6000 and row.num_users == 150
    approx = summary.dataset_totals(small.ratings, small.movies, approximate=True).first()
    assert abs(approx.num_users - 150) <= 10


def test_genre_samples_are_first_by_id(small):
    got = lookup.genre_counts_samples(small.movies, ["ring"], 5)
    ids = [r.movieId for r in got.orderBy("sample_rank").collect()]
    expected = [r.movieId for r in lookup.genre_contains(small.movies, "ring").orderBy("movieId").limit(5).collect()]
    assert ids == expected
    assert {r.num_movies for r in got.collect()} == {20}


def test_reuse_keeps_rows_and_spreads_sources(spark):
    t = MovieTables.from_driver_tables(spark, SMALL).reuse("checkpoint", ("movies", "ratings"), spread_to=4)
    assert t.ratings.rdd.getNumPartitions() == 4
    assert t.ratings.count() == 6000 and t.movies.count() == 200
    kept = MovieTables.from_driver_tables(spark, SMALL).reuse("persist", ("ratings", "wide"))
    assert kept.wide.count() == 24056
    kept.release()


def test_pairs_given_as_a_frame(spark, small):
    pairs = spark.createDataFrame([(1, 5), (1, 3), (3, 5)], "first_user int, second_user int")
    from_frame = taste.taste_pairs(taste.pair_profile(small.ratings, small.movies, taste.pair_users(pairs)), pairs)
    from_list = taste.taste_pairs(taste.pair_profile(small.ratings, small.movies, [1, 3, 5]), [(1, 5), (1, 3), (3, 5)])
    assert rows(from_frame) == rows(from_list) and from_frame.count() > 0
    ids = spark.createDataFrame([(1,), (3,)], "userId int")
    assert rows(lookup.users_ratings(small.ratings, small.movies, ids)) == rows(
        lookup.users_ratings(small.ratings, small.movies, [1, 3])
    )
