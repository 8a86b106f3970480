"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame`` over the driver's tables.

Each query builds its frames lazily from the Parquet files of ``sf_dir`` through the adapter and the cleaning
step, so its work grows with the tables; constants come from ``params``. Queries that write (scans of CSV
copies, sinks) write under the session's checkpoint folder and return a lazy read of what they wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.operators import (
    clean,
    distribution,
    fold_in,
    inner_product,
    leaderboard,
    lookup,
    profile,
    quarantine,
    recommend,
    sketches,
    summary,
    taste,
    text_index,
)
from marquee.operators.model import interaction_genres, interactions, interactions_wide
from marquee.plans import params as P
from marquee.plans.report import EXPORTED, export_report, report_rows
from marquee.plans.tables import MovieTables
from marquee.session import scratch_dir
from marquee.sinks import read_csv, read_snapshot, save_as_csv, save_snapshot, save_tables
from marquee.sources import adapter
from marquee.sources.files import scan_csv
from marquee.streaming.upsert import InteractionStore

Query = Callable[[SparkSession, str], DataFrame]


_PINNED: dict[tuple[int, str], tuple[SparkSession, MovieTables]] = {}


def pin_tables(spark: SparkSession, sf_dir: str, t: MovieTables | None) -> None:
    """Serve the clean (non-dirty) tables of ``sf_dir`` from a prepared bundle, such as one kept by
    ``MovieTables.reuse()``; ``None`` unpins."""
    key = (id(spark), sf_dir)
    if t is None:
        _PINNED.pop(key, None)
    else:
        _PINNED[key] = (spark, t)


def tables(spark: SparkSession, sf_dir: str, dirty: bool = False, users=None, movies=None) -> MovieTables:
    """The tables of a folder; ``users`` and ``movies`` name the ids that a lookup is about, for the file scans."""
    owner, pinned = _PINNED.get((id(spark), sf_dir), (None, None))
    if pinned is not None and owner is spark and not dirty:
        return pinned
    return MovieTables.from_driver_tables(spark, sf_dir, dirty=dirty, user_ids=users, movie_ids=movies)


def _title_of_movie(t: MovieTables, movie_id: int) -> Column:
    """Scalar subquery: the title of one movie (titles differ per scale, so no literal)."""
    return t.movies.where(F.col("movieId") == F.lit(movie_id)).select("title").scalar()


# sources and sinks -----------------------------------------------------------------------------------


def _csv_copy(spark: SparkSession, raw: DataFrame, table: str) -> DataFrame:
    path = scratch_dir(spark, f"raw-{table}")
    save_as_csv(raw, path)
    return scan_csv(spark, path, table)


def _scan_movies(spark, sf_dir):
    return _csv_copy(spark, adapter.raw_movies(spark, sf_dir, dirty=True), "movies")


def _scan_ratings(spark, sf_dir):
    return _csv_copy(spark, adapter.raw_ratings(spark, sf_dir, dirty=True), "ratings")


def _scan_tags(spark, sf_dir):
    return _csv_copy(spark, adapter.raw_tags(spark, sf_dir), "tags")


def _sink_csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "movies-csv")
    save_as_csv(tables(spark, sf_dir).movies, path)
    return read_csv(spark, path, schemas.MOVIES)


def _save_tables(spark, sf_dir):
    """Every row of the three written tables, in one shape."""
    t = tables(spark, sf_dir)
    paths = save_tables(
        {"movies": t.movies, "ratings": t.ratings, "movie_genres": t.movie_genres}, scratch_dir(spark, "tables")
    )
    return _table_rows({name: spark.read.parquet(path) for name, path in paths.items()})


def _table_rows(saved):
    movies, ratings, genres = (saved[n] for n in ("movies", "ratings", "movie_genres"))
    none = lambda kind: F.lit(None).cast(kind)
    shape = lambda df, name, user, text, day, rating: df.select(
        F.lit(name).alias("table_name"), "movieId", user.alias("userId"), text.alias("text"), day.alias("day"), rating.alias("rating")
    )
    return (
        shape(movies, "movies", none("int"), F.concat_ws("#", "title", "genres"), F.col("production_year"), none("float"))
        .unionByName(shape(ratings, "ratings", F.col("userId"), F.col("timestamp"), F.col("watching_date"), F.col("rating")))
        .unionByName(shape(genres, "movie_genres", none("int"), F.col("genre"), none("string"), none("float")))
    )


def _export_summaries(spark, sf_dir):
    """Every row of the exported CSV files: the summary's name, its key columns as text and its number."""
    paths = export_report(tables(spark, sf_dir), scratch_dir(spark, "report"))
    out = None
    for name in EXPORTED:
        df = spark.read.options(**schemas.CSV_OPTIONS).csv(paths[name])
        rows = df.select(
            F.lit(name).alias("summary"), F.concat_ws("#", *df.columns[:-1]).alias("row_key"), F.col(df.columns[-1]).cast("double").alias("row_value")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _snapshot_tables(spark, sf_dir):
    """Every row of the newest version of three tables that are saved together; an older version lies beside it."""
    t, base = tables(spark, sf_dir), scratch_dir(spark, "snapshots")
    save_snapshot({"movies": t.movies}, base)
    save_snapshot({"movies": t.movies, "ratings": t.ratings, "movie_genres": t.movie_genres}, base)
    return _table_rows(read_snapshot(spark, base))


def _quarantine_counts(spark, sf_dir):
    """Rows by problem of the three raw tables, from what was sorted out while writing them."""
    raw = {"ratings": adapter.raw_ratings(spark, sf_dir, dirty=True), "movies": adapter.raw_movies(spark, sf_dir, dirty=True), "tags": adapter.raw_tags(spark, sf_dir)}
    out = None
    for name, rows in raw.items():
        kept, set_aside = quarantine.sort_out(rows, name, scratch_dir(spark, f"sorted-{name}"))
        counts = set_aside.groupBy("reason").agg(F.count(F.lit(1)).alias("num_rows"), F.count_if(~F.col("kept")).alias("num_dropped"))
        whole = kept.agg(F.count(F.lit(1)).alias("num_rows"), F.lit(0).cast("long").alias("num_dropped")).select(F.lit("kept").alias("reason"), "num_rows", "num_dropped")
        counts = counts.unionByName(whole).select(F.lit(name).alias("table_name"), "reason", "num_rows", "num_dropped")
        out = counts if out is None else out.unionByName(counts)
    return out


def _sketched_users_per_year(spark, sf_dir):
    """Users of each year from stored daily sketches, appended in three parts, beside the exact count: estimates lie within
    four standard errors."""
    path, read_once = scratch_dir(spark, "daily-sketches"), scratch_dir(spark, "user-days")
    # one join of the source tables, whatever the number of parts
    tables(spark, sf_dir).ratings.select("userId", "watching_date").write.parquet(read_once)
    ratings = spark.read.parquet(read_once)
    for part in range(3):
        sketches.append_days(ratings.where(F.pmod("userId", F.lit(3)) == part), path)
    found = sketches.users_per_year(spark.read.parquet(path))
    exact = summary.active_users_per_year(ratings).withColumnRenamed("num_of_users", "exact_users")
    close = F.abs(F.col("num_users") - F.col("exact_users")) <= 4 * 1.04 / 2 ** (sketches.LOG_K / 2) * F.col("exact_users") + 1
    both = found.join(exact, found["watching_year"].eqNullSafe(exact["watching_year"]))
    return both.select(found["watching_year"], "exact_users", "num_ratings", close.alias("within_bound"))


# cleaning and model ----------------------------------------------------------------------------------


def _clean_ratings(spark, sf_dir):
    return clean.clean_ratings(adapter.raw_ratings(spark, sf_dir, dirty=True))


def _clean_movies(spark, sf_dir):
    return clean.clean_movies(adapter.raw_movies(spark, sf_dir, dirty=True))


def _clean_tags(spark, sf_dir):
    return tables(spark, sf_dir).tags


def _movie_genres(spark, sf_dir):
    return tables(spark, sf_dir).movie_genres


def _interactions(spark, sf_dir):
    t = tables(spark, sf_dir)
    return interactions(t.ratings, t.tags)


def _interactions_upserted(spark, sf_dir):
    """The interactions after three batches of ratings and one of tags were merged into a store, one of them twice."""
    t = tables(spark, sf_dir)
    store = InteractionStore(spark, scratch_dir(spark, "interaction-store"), buckets=8)
    store.apply("tags", 0, tags=t.tags)
    for batch_id, part in ((0, 2), (1, 0), (1, 0), (2, 1)):
        store.apply("ratings", batch_id, ratings=t.ratings.where(F.pmod("movieId", F.lit(3)) == part))
    return store.interactions()


def _interactions_wide(spark, sf_dir):
    t = tables(spark, sf_dir)
    return interactions_wide(t.interactions, t.movies)


# lookups ---------------------------------------------------------------------------------------------


def _user_ratings(spark, sf_dir):
    t = tables(spark, sf_dir, users=[P.USER])
    return lookup.user_ratings(t.ratings, t.movies, P.USER)


def _user_ratings_unknown(spark, sf_dir):
    t = tables(spark, sf_dir, users=[P.UNKNOWN_USER])
    return lookup.user_ratings(t.ratings, t.movies, P.UNKNOWN_USER)


def _users_ratings(spark, sf_dir):
    t = tables(spark, sf_dir, users=P.USER_LIST)
    return lookup.users_ratings(t.ratings, t.movies, P.USER_LIST)


def _movie_by_id(spark, sf_dir):
    return lookup.movie_by_id(tables(spark, sf_dir, movies=[P.MOVIE_ID]).movies, P.MOVIE_ID)


def _movie_title_contains(spark, sf_dir):
    return lookup.movie_title_contains(tables(spark, sf_dir).movies, P.TITLE_FRAGMENT)


def _movie_title_exact(spark, sf_dir):
    t = tables(spark, sf_dir)
    return lookup.movie_title_exact(t.movies, _title_of_movie(t, P.MOVIE_ID))


def _genre_contains(spark, sf_dir):
    return lookup.genre_contains(tables(spark, sf_dir).movies, P.GENRE_FRAGMENT)


def _saved_tables(spark, sf_dir, *indexes):
    """The tables saved for lookups and read again, and the folders of all that was written."""
    base = scratch_dir(spark, "lookup-tables")
    paths = tables(spark, sf_dir).save_for_lookups(base, indexes=indexes)
    return MovieTables.from_clean_tables(spark, base), paths


def _indexed_title_contains(spark, sf_dir):
    t, paths = _saved_tables(spark, sf_dir, "title")
    return text_index.contains(t.movies, "movieId", "title", paths["title_index"], P.TITLE_FRAGMENT)


def _indexed_genre_contains(spark, sf_dir):
    t, paths = _saved_tables(spark, sf_dir, "genres")
    return text_index.contains(t.movies, "movieId", "genres", paths["genres_index"], P.GENRE_FRAGMENT)


def _indexed_movies_by_year(spark, sf_dir):
    t, paths = _saved_tables(spark, sf_dir, "title")
    return text_index.ends_with(t.movies, "movieId", "title", paths["title_index"], f"({P.YEAR})")


def _saved_user_ratings(spark, sf_dir):
    t, _ = _saved_tables(spark, sf_dir)
    return lookup.user_ratings(t.ratings, t.movies, P.USER)


def _movies_in_genre_list(spark, sf_dir):
    return lookup.movies_in_genre_list(tables(spark, sf_dir).movies, P.GENRE_LIST)


def _genre_counts_samples(spark, sf_dir):
    return lookup.genre_counts_samples(tables(spark, sf_dir).movies, P.FRAGMENT_LIST, P.SAMPLES_PER_GENRE)


def _movies_by_year(spark, sf_dir):
    return lookup.movies_by_year(tables(spark, sf_dir).movies, P.YEAR)


def _titles_by_users(spark, sf_dir):
    t = tables(spark, sf_dir, users=P.USER_LIST)
    return lookup.titles_rated_or_tagged(t.interactions, t.movies, P.USER_LIST)


def _titles_in_genres(spark, sf_dir):
    return lookup.titles_in_genres(tables(spark, sf_dir).genre_rows, P.GENRE_LIST)


def _titles_in_genres_distinct(spark, sf_dir):
    return lookup.titles_in_genres(tables(spark, sf_dir).genre_rows, P.GENRE_LIST, distinct=True)


def _user_detail_totals(spark, sf_dir):
    t = tables(spark, sf_dir, users=P.DETAIL_USERS)
    return lookup.user_detail(t.ratings, t.movies, P.DETAIL_USERS)[0]


def _user_history(spark, sf_dir):
    t = tables(spark, sf_dir, users=[P.USER])
    return lookup.user_detail(t.ratings, t.movies, [P.USER])[1]


def _genre_detail_totals(spark, sf_dir):
    return lookup.genre_detail(tables(spark, sf_dir).movies, P.GENRE_FRAGMENT)[0]


# aggregations: interaction meaning -------------------------------------------------------------------


def _user_movie_count(spark, sf_dir):
    t = tables(spark, sf_dir, users=[P.USER])
    return profile.count_rated_or_tagged(t.interactions, t.movies, P.USER)


def _user_movie_count_all(spark, sf_dir):
    t = tables(spark, sf_dir)
    return profile.count_rated_or_tagged(t.interactions, t.movies)


def _user_genre_count(spark, sf_dir):
    return profile.count_watched_genres(tables(spark, sf_dir, users=[P.USER]).genre_rows, P.USER)


def _user_genre_count_all(spark, sf_dir):
    return profile.count_watched_genres(tables(spark, sf_dir).spread_genre_rows)


def _movie_summary_by_id(spark, sf_dir):
    t = tables(spark, sf_dir, movies=[P.MOVIE_ID])
    return profile.movie_watch_summary(t.interactions, t.movies, movie_id=P.MOVIE_ID)


def _movie_summary_by_title(spark, sf_dir):
    t = tables(spark, sf_dir)
    return profile.movie_watch_summary(t.interactions, t.movies, title_fragment=P.TITLE_FRAGMENT)


def _user_genre_stats(spark, sf_dir):
    return profile.genre_stats(tables(spark, sf_dir).spread_genre_rows)


def _user_watch_cutoff(spark, sf_dir):
    return profile.with_cutoff(profile.genre_stats(tables(spark, sf_dir).spread_genre_rows))


def _favourite_genres(spark, sf_dir):
    return profile.favourite_genres(tables(spark, sf_dir).spread_genre_rows)


def _favourite_genres_strict(spark, sf_dir):
    return profile.favourite_genres_strict(tables(spark, sf_dir).spread_genre_rows)


def _favourite_genre_of_user(spark, sf_dir):
    return profile.favourite_genre_of_user(tables(spark, sf_dir, users=[P.USER]).genre_rows, P.USER)


def _favourite_genre_all_users(spark, sf_dir):
    return profile.favourite_genre_per_user(tables(spark, sf_dir).spread_genre_rows)


def _favourite_genre_counts(spark, sf_dir):
    return profile.favourite_genre_counts(tables(spark, sf_dir).spread_genre_rows)


def _genre_user_counts(spark, sf_dir):
    return profile.genre_user_counts(tables(spark, sf_dir).spread_genre_rows)


def _user_genre_ratings(spark, sf_dir):
    return profile.user_genre_ratings(tables(spark, sf_dir, users=[P.USER]).genre_rows, P.USER)


def _user_genre_watches(spark, sf_dir):
    return profile.user_genre_watches(tables(spark, sf_dir, users=[P.USER]).genre_rows, P.USER)


def _genre_rating_histogram(spark, sf_dir):
    return distribution.genre_rating_histogram(tables(spark, sf_dir).genre_rows, P.HISTOGRAM_GENRE, P.HISTOGRAM_BINS)


def _genre_rating_histogram_all(spark, sf_dir):
    return distribution.genre_rating_histogram(tables(spark, sf_dir).spread_genre_rows, None, P.HISTOGRAM_BINS)


def _movie_rating_histogram(spark, sf_dir):
    t = tables(spark, sf_dir)
    title = _title_of_movie(t, P.MOVIE_ID)
    if (id(spark), sf_dir) in _PINNED:
        return distribution.movie_rating_histogram(t.genre_rows, title, P.HISTOGRAM_BINS)
    # the few movies of the title first, then only their interactions
    named = t.movies.where(F.col("title") == title)
    picked = interaction_genres(t.interactions.join(named.select("movieId"), "movieId", "left_semi"), named)
    return distribution.movie_rating_histogram(picked, None, P.HISTOGRAM_BINS)


# aggregations: rating meaning ------------------------------------------------------------------------


def _movie_summary(spark, sf_dir):
    t = tables(spark, sf_dir)
    return summary.movie_summary(t.ratings, t.movies)


def _movie_summary_detail(spark, sf_dir):
    t = tables(spark, sf_dir)
    return summary.movie_summary_detail(t.ratings, t.movies)


def _genre_summary(spark, sf_dir):
    t = tables(spark, sf_dir)
    return summary.genre_summary(t.ratings, t.movies)


def _user_genre_profile(spark, sf_dir):
    t = tables(spark, sf_dir, users=[P.USER])
    return profile.user_profile_by_rating(t.ratings, t.movies, P.USER)


def _user_genre_profile_all(spark, sf_dir):
    t = tables(spark, sf_dir)
    return profile.user_genre_profile(t.ratings, t.movies, tasks=t.tasks)


def _user_taste_thresholds(spark, sf_dir):
    t = tables(spark, sf_dir)
    return profile.user_taste_thresholds(profile.user_genre_profile(t.ratings, t.movies, tasks=t.tasks))


def _movies_per_year(spark, sf_dir):
    return summary.movies_per_year(tables(spark, sf_dir).movies)


def _genre_movies_per_year(spark, sf_dir):
    return summary.genre_movies_per_year(tables(spark, sf_dir).movies)


def _movies_per_genre(spark, sf_dir):
    return summary.movies_per_genre(tables(spark, sf_dir).movies)


def _ratings_per_year(spark, sf_dir):
    return summary.ratings_per_year(tables(spark, sf_dir).ratings)


def _active_user_days_per_year(spark, sf_dir):
    return summary.active_user_days_per_year(tables(spark, sf_dir).ratings)


def _active_users_per_year(spark, sf_dir):
    return summary.active_users_per_year(tables(spark, sf_dir).ratings)


def _ratings_per_genre(spark, sf_dir):
    t = tables(spark, sf_dir)
    return summary.ratings_per_genre(t.ratings, t.movies)


def _report_one_pass(spark, sf_dir):
    """Every row of every part of the report, from one pass over the ratings and one over the movies."""
    return report_rows(tables(spark, sf_dir))


def _dataset_totals(spark, sf_dir):
    t = tables(spark, sf_dir)
    return summary.dataset_totals(t.ratings, t.movies)


# top-k -----------------------------------------------------------------------------------------------


def _top_watched(spark, sf_dir):
    t = tables(spark, sf_dir)
    return leaderboard.top_watched(t.ratings, t.movies, n=P.TOP_N)


def _top_rated(spark, sf_dir):
    t = tables(spark, sf_dir)
    return leaderboard.top_rated(t.ratings, t.movies, n=P.TOP_N)


# taste -----------------------------------------------------------------------------------------------


def _all_profile(spark, sf_dir):
    t = tables(spark, sf_dir)
    return profile.user_genre_profile(t.ratings, t.movies, tasks=t.tasks)


def _pair_profile(spark, sf_dir, users=P.PAIR):
    t = tables(spark, sf_dir, users=users)
    return taste.pair_profile(t.ratings, t.movies, users)


def _liked_genres(spark, sf_dir):
    return profile.liked_genres(_all_profile(spark, sf_dir))


def _disliked_genres(spark, sf_dir):
    return profile.disliked_genres(_all_profile(spark, sf_dir))


def _pair_query(fn):
    def run(spark, sf_dir):
        return fn(_pair_profile(spark, sf_dir), *P.PAIR)

    return run


def _taste_pairs(spark, sf_dir):
    users = sorted({u for pair in P.TASTE_PAIRS for u in pair})
    return taste.taste_pairs(_pair_profile(spark, sf_dir, users), P.TASTE_PAIRS)


# recommender -----------------------------------------------------------------------------------------

_MODELS: dict[tuple[int, str], tuple[SparkSession, object, DataFrame, DataFrame]] = {}


def _trained(spark: SparkSession, sf_dir: str):
    """The model, its held-out side and the rated records that both come from."""
    key = (id(spark), sf_dir)
    hit = _MODELS.get(key)
    if hit is None or hit[0] is not spark:
        for old in [k for k, v in _MODELS.items() if v[0] is not spark]:
            del _MODELS[old]  # models of sessions that are gone
        rated = recommend.rated_once(tables(spark, sf_dir).ratings)
        hit = _MODELS[key] = (spark, *recommend.train_als(rated, seed=P.ALS_SEED), rated)
    return hit[1:]


def _model(spark: SparkSession, sf_dir: str):
    return _trained(spark, sf_dir)[:2]


def forget_models() -> None:
    """The next query that needs the model trains it."""
    _MODELS.clear()


def _als_split_counts(spark, sf_dir):
    return recommend.split_counts(tables(spark, sf_dir).ratings, seed=P.ALS_SEED)


def _als_predictions(spark, sf_dir):
    model, test = _model(spark, sf_dir)
    return recommend.predictions(model, test)


def _als_predicted_records(spark, sf_dir):
    """Which held-out records the model predicts, without the predicted numbers."""
    return _als_predictions(spark, sf_dir).drop("prediction")


def _als_metrics(spark, sf_dir):
    model, test = _model(spark, sf_dir)
    return recommend.evaluation(recommend.predictions(model, test))


def _mean_predictor_metrics(spark, sf_dir):
    """The error measure on a fixed predictor, the mean train rating of the movie."""
    train, test = recommend.train_and_test(recommend.rated_once(tables(spark, sf_dir).ratings), seed=P.ALS_SEED)
    e = recommend.evaluation(recommend.mean_predictions(train, test))
    return e.select("num_predictions", F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"))


def _recommendations(spark, sf_dir):
    # the asked users are looked up in the written records (a user without a rating is in no model): no second join of the sources
    model, _, rated = _trained(spark, sf_dir)
    users = rated.where(F.col("userId").isin(list(P.USER_LIST) + [P.UNKNOWN_USER])).select("userId").distinct()
    return recommend.recommend_for_users(model, users, tables(spark, sf_dir).movies, P.RECOMMENDATIONS_PER_USER)


def _recommendation_ranks(spark, sf_dir):
    """Rows and ranks per asked user; every one has a title."""
    return _ranks(_recommendations(spark, sf_dir))


def _ranks(rows):
    return rows.groupBy("userId").agg(
        F.count("title").alias("num_rows"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"), F.countDistinct("movieId").alias("num_movies")
    )


def _recommend_all_users(spark, sf_dir):
    """Top lists of every user of the model."""
    model, _ = _model(spark, sf_dir)
    return recommend.recommend_for_all_users(model, tables(spark, sf_dir).movies, P.RECOMMENDATIONS_PER_USER)


def _recommend_all_ranks(spark, sf_dir):
    """Rows and ranks of every user of the model; every movie has a title."""
    return _ranks(_recommend_all_users(spark, sf_dir))


def _top_inner_products(spark, sf_dir):
    """The search behind the top lists, on vectors that SQL can build: sums of ratings by a class of the other side."""
    ratings = tables(spark, sf_dir).ratings

    def vectors(key, other):
        sums = [F.sum(F.when(F.col(other) % 4 == k, 2 * F.col("rating").cast("double")).otherwise(0.0)) for k in range(4)]
        return ratings.groupBy(F.col(key).alias("id")).agg(F.array(*sums).alias("features"))

    found = inner_product.search(vectors("userId", "movieId"), vectors("movieId", "userId"), P.RECOMMENDATIONS_PER_USER)
    return inner_product.ranked(found).select(F.col("user").cast("int").alias("userId"), "rank", F.col("item").cast("int").alias("movieId"), "score")


def _fold_in_vectors(spark, sf_dir):
    """Factors of every user from all its ratings, on item vectors of two numbers that SQL can build."""
    t = tables(spark, sf_dir)
    items = t.movies.select(F.col("movieId").alias("id"), F.array(F.lit(1.0), (F.col("movieId") % 7) / F.lit(8.0)).alias("features"))
    found = fold_in.fold_in(t.ratings, items, 2, P.FOLD_IN_REG)
    return found.select("userId", "num_ratings", *[F.round(F.col("features")[k], 6).alias(f"factor_{k}") for k in range(2)])


def _cold_start_predictions(spark, sf_dir):
    """A model that a fifth of the users is kept from predicts held-out records of just those users."""
    old, known, asked = recommend.split_new_users(recommend.rated_once(tables(spark, sf_dir).ratings), seed=P.ALS_SEED)
    model, _ = recommend.train_als(old, seed=P.ALS_SEED, train_percent=100)
    return recommend.predict_new_users(model, known, asked)


def queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "scan_movies": _scan_movies,
        "scan_ratings": _scan_ratings,
        "scan_tags": _scan_tags,
        "sink_csv_roundtrip": _sink_csv_roundtrip,
        "save_tables": _save_tables,
        "export_summaries": _export_summaries,
        "snapshot_tables": _snapshot_tables,
        "quarantine_counts": _quarantine_counts,
        # cleaning and model
        "clean_ratings": _clean_ratings,
        "clean_movies": _clean_movies,
        "clean_tags": _clean_tags,
        "movie_genres": _movie_genres,
        "interactions": _interactions,
        "interactions_wide": _interactions_wide,
        "interactions_upserted": _interactions_upserted,
        # lookups
        "user_ratings": _user_ratings,
        "user_ratings_unknown": _user_ratings_unknown,
        "users_ratings": _users_ratings,
        "movie_by_id": _movie_by_id,
        "movie_title_contains": _movie_title_contains,
        "movie_title_exact": _movie_title_exact,
        "genre_contains": _genre_contains,
        "movies_in_genre_list": _movies_in_genre_list,
        "genre_counts_samples": _genre_counts_samples,
        "movies_by_year": _movies_by_year,
        "indexed_title_contains": _indexed_title_contains,
        "indexed_genre_contains": _indexed_genre_contains,
        "indexed_movies_by_year": _indexed_movies_by_year,
        "saved_user_ratings": _saved_user_ratings,
        "titles_by_users": _titles_by_users,
        "titles_in_genres": _titles_in_genres,
        "titles_in_genres_distinct": _titles_in_genres_distinct,
        "user_detail_totals": _user_detail_totals,
        "user_history": _user_history,
        "genre_detail_totals": _genre_detail_totals,
        # aggregations, interaction meaning
        "user_movie_count": _user_movie_count,
        "user_movie_count_all": _user_movie_count_all,
        "user_genre_count": _user_genre_count,
        "user_genre_count_all": _user_genre_count_all,
        "movie_summary_by_id": _movie_summary_by_id,
        "movie_summary_by_title": _movie_summary_by_title,
        "user_genre_stats": _user_genre_stats,
        "user_watch_cutoff": _user_watch_cutoff,
        "favourite_genres": _favourite_genres,
        "favourite_genres_strict": _favourite_genres_strict,
        "favourite_genre_of_user": _favourite_genre_of_user,
        "favourite_genre_all_users": _favourite_genre_all_users,
        "favourite_genre_counts": _favourite_genre_counts,
        "genre_user_counts": _genre_user_counts,
        "user_genre_ratings": _user_genre_ratings,
        "user_genre_watches": _user_genre_watches,
        "genre_rating_histogram": _genre_rating_histogram,
        "genre_rating_histogram_all": _genre_rating_histogram_all,
        "movie_rating_histogram": _movie_rating_histogram,
        # aggregations, rating meaning
        "movie_summary": _movie_summary,
        "movie_summary_detail": _movie_summary_detail,
        "genre_summary": _genre_summary,
        "user_genre_profile": _user_genre_profile,
        "user_genre_profile_all": _user_genre_profile_all,
        "user_taste_thresholds": _user_taste_thresholds,
        "movies_per_year": _movies_per_year,
        "genre_movies_per_year": _genre_movies_per_year,
        "movies_per_genre": _movies_per_genre,
        "ratings_per_year": _ratings_per_year,
        "active_user_days_per_year": _active_user_days_per_year,
        "active_users_per_year": _active_users_per_year,
        "ratings_per_genre": _ratings_per_genre,
        "dataset_totals": _dataset_totals,
        "report_one_pass": _report_one_pass,
        "sketched_users_per_year": _sketched_users_per_year,
        # top-k
        "top_rated": _top_rated,
        "top_watched": _top_watched,
        # taste
        "liked_genres": _liked_genres,
        "disliked_genres": _disliked_genres,
        "taste_shared": _pair_query(taste.taste_shared),
        "taste_only_first": _pair_query(taste.taste_only_first),
        "taste_only_second": _pair_query(taste.taste_only_second),
        "genre_set_except": _pair_query(taste.genre_set_except),
        "taste_both_like": _pair_query(taste.taste_both_like),
        "taste_both_dislike": _pair_query(taste.taste_both_dislike),
        "taste_like_dislike": _pair_query(taste.taste_like_dislike),
        "taste_dislike_like": _pair_query(taste.taste_dislike_like),
        "taste_pairs": _taste_pairs,
        # recommender (rows-only checks)
        "als_split_counts": _als_split_counts,
        "als_predictions": _als_predictions,
        "als_predicted_records": _als_predicted_records,
        "als_metrics": _als_metrics,
        "mean_predictor_metrics": _mean_predictor_metrics,
        "recommendations": _recommendations,
        "recommendation_ranks": _recommendation_ranks,
        "recommend_all_users": _recommend_all_users,
        "recommend_all_ranks": _recommend_all_ranks,
        "top_inner_products": _top_inner_products,
        "fold_in_vectors": _fold_in_vectors,
        "cold_start_predictions": _cold_start_predictions,
    }
