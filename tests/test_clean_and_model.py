"""Literal frames for the cases the driver's tables lack (FIXTURES.md section 5)."""

from pyspark.sql import functions as F

from conftest import rows
from marquee import schemas
from marquee.operators import clean, model, profile
from marquee.operators.lookup import movie_title_contains, movie_title_exact


def raw_movies(spark, data):
    return spark.createDataFrame(data, schemas.RAW_MOVIES)


def raw_ratings(spark, data):
    return spark.createDataFrame(data, schemas.RAW_RATINGS)


def raw_tags(spark, data):
    return spark.createDataFrame([(u, m, t, None) for u, m, t in data], schemas.RAW_TAGS)


def test_production_year_rule(spark):
    movies = clean.clean_movies(
        raw_movies(
            spark,
            [("1", "Heat (1995)  ", "Action"), ("2", "Up", "Animation"), ("3", "small ring", "A"), ("4", "X (2001)", "B")],
        )
    )
    got = dict(rows(movies, "movieId", "production_year"))
    assert got == {1: "1995", 2: "U", 3: " rin", 4: "2001"}
    strict = dict(rows(clean.clean_movies(raw_movies(spark, [("3", "small ring", "A"), ("4", "X (2001) ", "B")]), "strict"), "movieId", "production_year"))
    assert strict == {3: None, 4: "2001"}


def test_null_rows_dropped_and_bad_rating_kept_as_null(spark):
    ratings = clean.clean_ratings(
        raw_ratings(
            spark,
            [("1", "10", "4.5", "0"), ("1", "11", None, "0"), ("1", "12", "n/a", "0"), ("x", "13", "3.0", "0")],
        )
    )
    assert rows(ratings, "movieId", "rating") == [(10, 4.5), (12, None)]
    strict = clean.clean_ratings(raw_ratings(spark, [("1", "12", "n/a", "0")]), drop_malformed=True)
    assert strict.count() == 0


def test_watching_date_is_utc_day_whatever_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        ratings = clean.clean_ratings(raw_ratings(spark, [("1", "1", "1.0", "86399"), ("1", "2", "1.0", "86400")]))
        assert rows(ratings, "movieId", "watching_date") == [(1, "1970-01-01"), (2, "1970-01-02")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_genre_parts_keep_empty_and_repeated(spark):
    movies = clean.clean_movies(raw_movies(spark, [("1", "A (2000)", "A||B"), ("2", "B (2000)", "A|A")]))
    assert rows(clean.movie_genres(movies)) == [(1, ""), (1, "A"), (1, "B"), (2, "A"), (2, "A")]


def test_malformed_tag_ids_are_dropped(spark):
    tags = clean.clean_tags(raw_tags(spark, [("1", "7", "funny"), ("1", "seven", "sad"), (None, "7", "x")]))
    assert rows(tags) == [(1, 7, "funny")]


def _tables(spark):
    movies = clean.clean_movies(raw_movies(spark, [("1", "Alpha (1990)", "Drama|Comedy"), ("2", "Beta (1991)", "Drama")]))
    ratings = clean.clean_ratings(
        raw_ratings(
            spark,
            [
                ("1", "1", "2.0", "100"),
                ("1", "1", "4.0", "200"),  # later wins
                ("2", "1", "1.0", "300"),
                ("2", "1", "3.0", "300"),  # same second: higher wins
                ("1", "99", "5.0", "100"),  # movie absent from movies
            ],
        )
    )
    tags = clean.clean_tags(raw_tags(spark, [("3", "2", "tagged only"), ("1", "1", "also rated"), ("1", "98", "absent")]))
    return movies, ratings, tags


def test_latest_rating_rule_and_tag_only_pairs(spark):
    movies, ratings, tags = _tables(spark)
    inter = model.interactions(ratings, tags)
    assert rows(inter) == [(1, 1, 4.0), (1, 98, None), (1, 99, 5.0), (2, 1, 3.0), (3, 2, None)]
    wide = model.interactions_wide(inter, movies)
    # absent movies leave the wide table; one row per genre part
    assert rows(wide, "userId", "movieId", "genre") == [
        (1, 1, "Comedy"), (1, 1, "Drama"), (2, 1, "Comedy"), (2, 1, "Drama"), (3, 2, "Drama"),
    ]


def test_interaction_and_rating_meanings_differ(spark):
    movies, ratings, tags = _tables(spark)
    wide = model.interactions_wide(model.interactions(ratings, tags), movies)
    # user 3 only tagged: watched in the interaction meaning, absent in the rating meaning
    assert rows(profile.count_watched_movies(wide, 3)) == [(3, 1)]
    assert profile.user_genre_profile(ratings, movies, [3]).count() == 0
    # rating meaning keeps every record: user 1 rated movie 1 twice
    assert rows(profile.user_genre_profile(ratings, movies, [1]), "genre", "watchings") == [("Comedy", 2), ("Drama", 2)]


def test_user_with_one_genre_likes_it(spark):
    movies = clean.clean_movies(raw_movies(spark, [("1", "Solo (1990)", "Drama")]))
    ratings = clean.clean_ratings(raw_ratings(spark, [("7", "1", "3.5", "0")]))
    prof = profile.user_genre_profile(ratings, movies)
    assert rows(profile.liked_genres(prof), "genre") == [("Drama",)]
    assert profile.disliked_genres(prof).count() == 0


def test_threshold_equality_is_exact(spark):
    # three genres with means 3.33, 3.33, 3.33: float averaging can put the threshold above 3.33
    movies = clean.clean_movies(raw_movies(spark, [(str(i), f"M{i} (1990)", g) for i, g in [(1, "A"), (2, "B"), (3, "C")]]))
    data = []
    for m in ("1", "2", "3"):
        data += [("5", m, "3.0", "0"), ("5", m, "3.5", "1"), ("5", m, "3.5", "2")]
    ratings = clean.clean_ratings(raw_ratings(spark, data))
    prof = profile.user_genre_profile(ratings, movies)
    assert {r.Average_Rating for r in prof.collect()} == {3.33}
    assert profile.liked_genres(prof).count() == 3


def test_literal_text_in_lookups(spark):
    movies = clean.clean_movies(
        raw_movies(spark, [("1", "Schindler's List (1993)", "Drama"), ("2", "100% Wolf (2020)", "Kids"), ("3", "1000 Wolf (2020)", "Kids")])
    )
    assert rows(movie_title_contains(movies, "'s"), "movieId") == [(1,)]
    assert rows(movie_title_contains(movies, "100%"), "movieId") == [(2,)]
    assert rows(movie_title_exact(movies, "Schindler's List (1993)"), "movieId") == [(1,)]
    assert rows(movie_title_exact(movies, F.lit("100% Wolf (2020)")), "movieId") == [(2,)]


def test_folded_genre_rows_give_the_wide_results(spark):
    movies = clean.clean_movies(raw_movies(spark, [("1", "Twice (1990)", "A|A|B"), ("2", "Once (1991)", "A")]))
    ratings = clean.clean_ratings(raw_ratings(spark, [("1", "1", "5.0", "0"), ("1", "2", "2.0", "0"), ("2", "2", "1.0", "0")]))
    tags = clean.clean_tags(raw_tags(spark, [("2", "1", "t")]))
    inter = model.interactions(ratings, tags)
    wide, folded = model.interactions_wide(inter, movies), model.interaction_genres(inter, movies)
    assert folded.count() == 6 and wide.count() == 8
    assert rows(profile.genre_stats(wide)) == rows(profile.genre_stats(folded))
    # user 1, genre A: movie 1 counts twice in the mean (4 rows: 5, 5, 2), once in the distinct count
    stats = {(r.userId, r.genre): (r.avgRating, r.watchCount) for r in profile.genre_stats(folded).collect()}
    assert stats[(1, "A")] == (4.0, 2) and stats[(2, "A")] == (1.0, 2)
    from marquee.operators.lookup import titles_in_genres
    assert rows(titles_in_genres(wide, ["A"])) == rows(titles_in_genres(folded, ["A"]))


def test_adapter_epoch_seconds_ignore_the_session_zone(spark):
    from marquee.functions.columns import epoch_seconds_of_ntz

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'1997-07-01 00:00:00' AS t UNION ALL SELECT timestamp_ntz'1969-12-31 23:59:59.9'")
        assert rows(df.select(epoch_seconds_of_ntz("t"))) == [(-1,), (867715200,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_packed_order_key_holds_at_its_edges(spark):
    """Latest second first, then the rating: at both ends of bigint seconds and of the rating range."""
    from marquee.operators.model import interactions

    top, low = str(2**63 - 1), str(-(2**63) + 1)
    cases = {
        1: [("5", 1.0), ("6", 0.5)], 2: [("5", 1.0), ("5", 4.5), ("5", None)], 3: [(top, -999999.0), (str(2**63 - 2), 999999.0)],
        4: [(low, 3.0), ("n/a", 5.0)], 5: [("n/a", 2.0), ("n/a", 3.0)], 6: [("7", None), ("6", 4.0)], 7: [("-5", 0.0), ("-6", 5.0)],
    }
    ratings = spark.createDataFrame([(1, m, r, t, None) for m, rs in cases.items() for t, r in rs], "userId int, movieId int, rating float, timestamp string, watching_date string")
    tags = spark.createDataFrame([(1, 1, "x"), (1, 9, "y")], "userId int, movieId int, tag string")
    found = {r.movieId: r.rating for r in interactions(ratings, tags).collect()}
    assert found == {1: 0.5, 2: 4.5, 3: -999999.0, 4: 3.0, 5: 3.0, 6: None, 7: 0.0, 9: None}


def test_folded_means_do_not_depend_on_ansi(spark):
    from marquee.operators import profile
    from marquee.operators.model import interaction_genres, interactions_wide

    movies = spark.createDataFrame([(1, "t", "A|A|A", None), (2, "u", "A", None)], "movieId int, title string, genres string, production_year string")
    pairs = spark.createDataFrame([(1, 1, 3.7), (1, 2, 2.1)], "userId int, movieId int, rating float")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            folded = profile.genre_stats(interaction_genres(pairs, movies)).collect()
            wide = profile.genre_stats(interactions_wide(pairs, movies)).collect()
            assert [tuple(r) for r in folded] == [tuple(r) for r in wide]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_profile_is_ordered_by_its_means(small):
    from marquee.operators.profile import user_profile_by_rating

    found = [(-r.Average_Rating, r.genre) for r in user_profile_by_rating(small.ratings, small.movies, 1).collect()]
    assert found == sorted(found) and len(found) > 5


def test_counts_and_titles_without_the_explode(small):
    from marquee.operators import lookup, profile

    assert rows(profile.count_rated_or_tagged(small.interactions, small.movies)) == rows(profile.count_watched_movies(small.wide))
    assert rows(lookup.titles_rated_or_tagged(small.interactions, small.movies, [1, 3])) == rows(lookup.titles_by_users(small.wide, [1, 3]))


def test_a_fragment_without_a_match_counts_zero(small):
    from marquee.operators import lookup

    found = {r.fragment: (r.num_movies, r.sample_rank) for r in lookup.genre_counts_samples(small.movies, ["no such"]).collect()}
    assert found == {"no such": (0, None)}
