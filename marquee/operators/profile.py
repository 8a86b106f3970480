"""Per-user and per-genre profiles.

Two meanings of "watched" are kept apart by their inputs:

* interaction meaning (``wide``: rated or tagged, one row per distinct (user, movie) and genre part; or the
  folded ``model.interaction_genres`` rows, which carry a repeated genre part as a ``weight``);
* rating meaning (``ratings``: every rating record, tags ignored).

Per-user thresholds and favourites are window columns over ``partitionBy("userId")`` on per-(user, genre)
rows, so a window partition holds one user's genres (bounded by the number of genres), never a user's
ratings; all the per-row work before it is partial aggregation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import as_cents, round2
from marquee.operators.model import rated_genres


def _by_user() -> Window:
    return Window.partitionBy("userId")


def _one_user(df: DataFrame, user_id: int | None) -> DataFrame:
    return df if user_id is None else df.where(F.col("userId") == F.lit(int(user_id)))


# interaction meaning ---------------------------------------------------------------------------------


def count_watched_movies(wide: DataFrame, user_id: int | None = None) -> DataFrame:
    """``userId, moviesWatched``: distinct movies a user rated or tagged."""
    return _one_user(wide, user_id).groupBy("userId").agg(F.countDistinct("movieId").alias("moviesWatched"))


def count_rated_or_tagged(interactions: DataFrame, movies: DataFrame, user_id: int | None = None) -> DataFrame:
    """``count_watched_movies`` from the interactions themselves: they are distinct per (user, movie), so it is a plain
    count over those of movies with genres, without the explode and the distinct count."""
    known = movies.where(F.col("genres").isNotNull()).select("movieId")
    return (
        _one_user(interactions, user_id).join(known, "movieId", "left_semi")
        .groupBy("userId").agg(F.count(F.lit(1)).alias("moviesWatched"))
    )


def count_watched_genres(wide: DataFrame, user_id: int | None = None) -> DataFrame:
    """``userId, genresWatched``: distinct genres over the movies a user rated or tagged."""
    return _one_user(wide, user_id).groupBy("userId").agg(F.countDistinct("genre").alias("genresWatched"))


def movie_watch_summary(
    interactions: DataFrame, movies: DataFrame, movie_id: int | None = None, title_fragment: str | None = None
) -> DataFrame:
    """``movieId, title, usersWatchedMovie, averageRating``: users who rated or tagged a movie and their mean
    rating, for movies picked by id or by a title fragment.

    The wide table repeats each interaction once per genre part of its movie, which changes neither the
    distinct users nor the mean, so this reads interactions without the explode. Interactions are distinct per (user,
    movie), so the distinct user count is a plain count. They are summed per movie before they meet the movies: a hot
    movie is combined on the map side and no join key is hot. A pick semi-joins the interactions first.
    """
    picked = movies.where(F.col("genres").isNotNull())
    if movie_id is not None:
        picked = picked.where(F.col("movieId") == F.lit(int(movie_id)))
    if title_fragment is not None:
        picked = picked.where(F.col("title").contains(F.lit(title_fragment)))
    if movie_id is not None or title_fragment is not None:
        interactions = interactions.join(picked.select("movieId"), "movieId", "left_semi")
    per_movie = interactions.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("usersWatchedMovie"), F.avg("rating").alias("averageRating")
    )
    return per_movie.join(picked.select("movieId", "title"), "movieId", "inner").select(
        "movieId", "title", "usersWatchedMovie", "averageRating"
    )


def weighted_mean(value: str, weight: Column) -> Column:
    """Mean of ``value`` over rows repeated ``weight`` times; nulls take no part. Exact sums for half-star
    ratings, so it equals ``avg`` over the repeated rows."""
    rated = F.col(value).isNotNull()
    # in double, whatever the session: a float times a weight would be a float where ANSI is off
    return F.try_divide(F.sum(F.col(value).cast("double") * weight), F.sum(F.when(rated, weight)))


def genre_stats(wide: DataFrame) -> DataFrame:
    """``userId, genre, avgRating, watchCount`` per (user, genre): mean rating (tag-only rows have none) and
    distinct movies.

    On the folded table (``model.interaction_genres``) rows are distinct per (user, movie, genre), so the
    distinct count is a plain count and the mean is weighted: one partial aggregate and one shuffle. On the
    plain wide table a repeated genre part repeats a row, so it takes a distinct count (two levels)."""
    if "weight" in wide.columns:
        return wide.groupBy("userId", "genre").agg(
            weighted_mean("rating", F.col("weight")).alias("avgRating"), F.count(F.lit(1)).alias("watchCount")
        )
    return wide.groupBy("userId", "genre").agg(
        F.avg("rating").alias("avgRating"), F.countDistinct("movieId").alias("watchCount")
    )


def with_cutoff(stats: DataFrame) -> DataFrame:
    """Adds ``avgWatchCount``, the user's mean over genres of ``watchCount``: the favourite cut-off."""
    return stats.withColumn("avgWatchCount", F.avg("watchCount").over(_by_user()))


def _above_cutoff(wide: DataFrame) -> DataFrame:
    return with_cutoff(genre_stats(wide)).where(F.col("watchCount") >= F.col("avgWatchCount"))


def favourite_genres(wide: DataFrame) -> DataFrame:
    """Favourite genres as the source code computes them: genres watched at or above the user's cut-off whose
    mean is at most the highest such mean, i.e. every such genre that has a mean.

    ``userId, genre, avgRating, watchCount, avgWatchCount, maxAvgRating``.
    """
    above = _above_cutoff(wide)
    return above.withColumn("maxAvgRating", F.max("avgRating").over(_by_user())).where(
        F.col("maxAvgRating") >= F.col("avgRating")
    )


def favourite_genres_strict(wide: DataFrame) -> DataFrame:
    """Favourite genres as documented: among genres at or above the cut-off, those with the highest mean (ties
    all kept). ``userId, genre, avgRating, watchCount, avgWatchCount``."""
    above = _above_cutoff(wide).where(F.col("avgRating").isNotNull())
    top = F.rank().over(_by_user().orderBy(F.col("avgRating").desc()))
    return above.withColumn("_rank", top).where(F.col("_rank") == 1).drop("_rank")


def favourite_genre_per_user(wide: DataFrame) -> DataFrame:
    """``userId, favouriteGenre``: the most watched of each user's favourite genres; ties go to the first genre
    by name."""
    pick = F.row_number().over(_by_user().orderBy(F.col("watchCount").desc(), F.col("genre").asc()))
    return (
        favourite_genres(wide)
        .withColumn("_pick", pick)
        .where(F.col("_pick") == 1)
        .select("userId", F.col("genre").alias("favouriteGenre"))
    )


def favourite_genre_of_user(wide: DataFrame, user_id: int) -> DataFrame:
    """One row for one user (none for an unknown user). The filter on the user reaches below the windows,
    which partition by user, so only that user's rows are aggregated."""
    return favourite_genre_per_user(_one_user(wide, user_id))


def favourite_genre_counts(wide: DataFrame) -> DataFrame:
    """``genre, favouriteGenreCount``: users having the genre among their favourites, most first."""
    return (
        favourite_genres(wide)
        .groupBy("genre")
        .agg(F.count("userId").alias("favouriteGenreCount"))
        .orderBy(F.col("favouriteGenreCount").desc(), F.col("genre").asc())
    )


def genre_user_counts(wide: DataFrame) -> DataFrame:
    """``genre, Count``: distinct users who rated or tagged a movie of the genre, most first."""
    return (
        wide.groupBy("genre")
        .agg(F.countDistinct("userId").alias("Count"))
        .orderBy(F.col("Count").desc(), F.col("genre").asc())
    )


def user_genre_ratings(wide: DataFrame, user_id: int) -> DataFrame:
    """``userId, genre, avgRating`` of one user, genre descending (the bar chart's input)."""
    return (
        genre_stats(_one_user(wide, user_id)).select("userId", "genre", "avgRating").orderBy(F.col("genre").desc())
    )


def user_genre_watches(wide: DataFrame, user_id: int) -> DataFrame:
    """``userId, genre, watchCount`` of one user, genre descending."""
    return (
        genre_stats(_one_user(wide, user_id)).select("userId", "genre", "watchCount").orderBy(F.col("genre").desc())
    )


# rating meaning --------------------------------------------------------------------------------------


def pick_users(df: DataFrame, user_ids: Iterable[int] | DataFrame | None) -> DataFrame:
    """Rows of the given users: an ``IN`` list for a short list, a left-semi join for a frame of ``userId``."""
    if user_ids is None:
        return df
    if isinstance(user_ids, DataFrame):
        return df.join(user_ids.select("userId").distinct(), "userId", "left_semi")
    return df.where(F.col("userId").isin([int(u) for u in user_ids]))


def user_genre_profile(
    ratings: DataFrame, movies: DataFrame, user_ids: Iterable[int] | DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """``userId, genre, Average_Rating, watchings`` per (user, genre) over rating records of known movies:
    mean rounded half up to 2 decimals, and the number of records. ``user_ids`` limits it to some users (a list,
    or a frame with ``userId``); the limit applies before the join, so only their records are read on. ``tasks`` as in
    ``model.interaction_genres``."""
    picked = pick_users(ratings, user_ids)
    return (
        rated_genres(picked, movies, tasks)
        .groupBy("userId", "genre")
        .agg(round2(F.avg("rating")).alias("Average_Rating"), F.count("userId").alias("watchings"))
    )


def user_profile_by_rating(ratings: DataFrame, movies: DataFrame, user_id: int) -> DataFrame:
    """One user's genre profile, best mean first (ties by genre)."""
    return user_genre_profile(ratings, movies, [user_id]).orderBy(F.col("Average_Rating").desc_nulls_last(), F.col("genre").asc())


def user_taste_thresholds(profile: DataFrame) -> DataFrame:
    """``userId, num_genres, avg_rating_threshold, avg_watchings_threshold``: a user's mean over genres of the
    rounded mean rating (genres with a mean) and of the record count.

    Sums run in exact decimals, and each mean is one division of the exact sum, so every engine gets the same
    double.
    """
    n_rated = F.count("Average_Rating")
    return profile.groupBy("userId").agg(
        F.count(F.lit(1)).alias("num_genres"),
        F.when(n_rated > 0, F.sum(as_cents("Average_Rating")).cast("double") / n_rated).alias("avg_rating_threshold"),
        (F.sum("watchings").cast("double") / F.count(F.lit(1))).alias("avg_watchings_threshold"),
    )


def with_taste_flags(profile: DataFrame) -> DataFrame:
    """Adds ``likes`` and ``dislikes`` to each (user, genre) row.

    Liked: mean at or above the user's mean over genres **and** count at or above the mean count. Disliked:
    both strictly below; a genre without a mean is neither. The comparisons are exact: ``x >= S / n`` is tested as ``x * n >= S`` in decimals
    (ratings) and integers (counts), so a genre equal to the mean is never lost to rounding.
    """
    cents = as_cents("Average_Rating")
    n_rated = F.count("Average_Rating").over(_by_user())
    n_all = F.count(F.lit(1)).over(_by_user())
    rating_sum = F.sum(cents).over(_by_user())
    watch_sum = F.sum("watchings").over(_by_user())
    rating_x_n = cents * n_rated
    watch_x_n = F.col("watchings") * n_all
    likes = F.coalesce((rating_x_n >= rating_sum) & (watch_x_n >= watch_sum), F.lit(False))
    dislikes = F.coalesce((rating_x_n < rating_sum) & (watch_x_n < watch_sum), F.lit(False))
    return profile.withColumn("likes", likes).withColumn("dislikes", dislikes)


def liked_genres(profile: DataFrame) -> DataFrame:
    return with_taste_flags(profile).where(F.col("likes")).select("userId", "genre", "Average_Rating", "watchings")


def disliked_genres(profile: DataFrame) -> DataFrame:
    return with_taste_flags(profile).where(F.col("dislikes")).select("userId", "genre", "Average_Rating", "watchings")
