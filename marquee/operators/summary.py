"""Summaries: per movie, per genre, per year, and data-set totals (rating meaning).

Plans aggregate before they join: ratings are reduced to one row per movie (count, rated count, rating sum) by a
partial aggregate, and only those rows meet the movie or genre rows. A genre's mean is the sum of its movies'
sums over the sum of their rated counts: with half-star ratings every sum is exact, so the result is the same
double as averaging the joined rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import round2, split_genres, year_of_date_text


def _per_movie(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("rating").alias("_rated"), F.sum("rating").alias("_sum")
    )


def _genres(movies: DataFrame) -> DataFrame:
    return movies.select("movieId", F.explode(split_genres("genres")).alias("genre"))


def _mean(sum_col: str, count_col: str):
    return F.try_divide(F.sum(sum_col), F.sum(count_col))


def movie_summary(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``movieId, Average_Rating, Number_OF_Watchings`` for movies present in movies."""
    per_movie = ratings.groupBy("movieId").agg(
        F.avg("rating").alias("Average_Rating"), F.count("movieId").alias("Number_OF_Watchings")
    )
    return per_movie.join(movies.select("movieId"), "movieId", "left_semi")


def movie_summary_detail(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``movieId, title, genres, Average_Rating, Number_OF_Watchings``; mean rounded half up to 2 decimals."""
    per_movie = ratings.groupBy("movieId").agg(
        round2(F.avg("rating")).alias("Average_Rating"), F.count("movieId").alias("Number_OF_Watchings")
    )
    return per_movie.join(movies.select("movieId", "title", "genres"), "movieId", "inner").select(
        "movieId", "title", "genres", "Average_Rating", "Number_OF_Watchings"
    )


def genre_summary(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``genre, Number_OF_Watchings, Average_Rating``: rating records per genre and their mean."""
    return (
        _per_movie(ratings)
        .join(_genres(movies), "movieId", "inner")
        .groupBy("genre")
        .agg(F.sum("_rows").alias("Number_OF_Watchings"), _mean("_sum", "_rated").alias("Average_Rating"))
    )


def ratings_per_genre(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """``genre, num_of_watchings, average_rating`` (mean rounded half up to 2 decimals)."""
    return (
        _per_movie(ratings)
        .join(_genres(movies), "movieId", "inner")
        .groupBy("genre")
        .agg(F.sum("_rows").alias("num_of_watchings"), round2(_mean("_sum", "_rated")).alias("average_rating"))
    )


def movies_per_year(movies: DataFrame) -> DataFrame:
    """``production_year, num_of_movies``, most first; a null year counts 0 (count of the year column)."""
    return (
        movies.groupBy("production_year")
        .agg(F.count("production_year").alias("num_of_movies"))
        .orderBy(F.col("num_of_movies").desc(), F.col("production_year").asc())
    )


def genre_movies_per_year(movies: DataFrame) -> DataFrame:
    """``production_year, genre, num_of_movies``, most first. The (movie, genre) table is the explode of
    movies, so the source's join of the two is the explode itself."""
    return (
        movies.select("production_year", F.explode(split_genres("genres")).alias("genre"))
        .groupBy("production_year", "genre")
        .agg(F.count("production_year").alias("num_of_movies"))
        .orderBy(F.col("num_of_movies").desc(), F.col("production_year").asc(), F.col("genre").asc())
    )


def movies_per_genre(movies: DataFrame) -> DataFrame:
    """``genre, num_of_movies`` (genre parts, so ``A|A`` counts twice), by genre."""
    return (
        _genres(movies).groupBy("genre").agg(F.count("genre").alias("num_of_movies")).orderBy(F.col("genre").asc())
    )


def ratings_per_year(ratings: DataFrame) -> DataFrame:
    """``watching_year, num_of_watchings``, by year."""
    return (
        ratings.select(year_of_date_text("watching_date").alias("watching_year"))
        .groupBy("watching_year")
        .agg(F.count("watching_year").alias("num_of_watchings"))
        .orderBy(F.col("watching_year").asc())
    )


def active_user_days_per_year(ratings: DataFrame) -> DataFrame:
    """``watching_year, num_of_users`` where the count is of distinct (user, day) pairs, as the source computes
    it; latest year first."""
    return (
        ratings.select("userId", "watching_date")
        .distinct()
        .select("userId", year_of_date_text("watching_date").alias("watching_year"))
        .groupBy("watching_year")
        .agg(F.count("userId").alias("num_of_users"))
        .orderBy(F.col("watching_year").desc())
    )


def active_users_per_year(ratings: DataFrame) -> DataFrame:
    """``watching_year, num_of_users`` with distinct users per year; latest year first."""
    return (
        ratings.select("userId", year_of_date_text("watching_date").alias("watching_year"))
        .groupBy("watching_year")
        .agg(F.countDistinct("userId").alias("num_of_users"))
        .orderBy(F.col("watching_year").desc())
    )


def dataset_totals(ratings: DataFrame, movies: DataFrame, approximate: bool = False) -> DataFrame:
    """One row ``num_users, num_movies, num_genres, num_ratings``.

    Each count is its own aggregate; the one-row results are stacked by a union and folded by one more tiny
    aggregate, so no join is needed. ``approximate`` uses HyperLogLog distinct counts.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    parts = [
        ratings.agg(distinct("userId").alias("num_users"), F.count(F.lit(1)).alias("num_ratings")),
        movies.agg(distinct("movieId").alias("num_movies")),
        _genres(movies).agg(distinct("genre").alias("num_genres")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = ["num_users", "num_movies", "num_genres", "num_ratings"]
    return stacked.agg(*[F.max(n).alias(n) for n in names])


# all of the above from one pass ------------------------------------------------------------------------


def rating_sets(ratings: DataFrame) -> DataFrame:
    """Grouping sets of the ratings, in one pass: by year, by movie and by (user, day).

    ``part`` (year, movie, day), ``watching_year``, ``movieId``, ``userId``, ``watching_date`` (null where not grouped by),
    ``num_rows``, ``num_rated``, ``rating_sum``. A partial hash aggregate comes before the one shuffle.
    """
    rows = ratings.select("userId", "movieId", "watching_date", year_of_date_text("watching_date").alias("watching_year"), "rating")
    year, movie, user, day = (F.col(c) for c in ("watching_year", "movieId", "userId", "watching_date"))
    sets = rows.groupingSets([[year], [movie], [user, day]], year, movie, user, day).agg(
        F.grouping("watching_year").alias("_no_year"),
        F.grouping("movieId").alias("_no_movie"),
        F.count(F.lit(1)).alias("num_rows"),
        F.count("rating").alias("num_rated"),
        F.sum("rating").alias("rating_sum"),
    )
    part = F.when(F.col("_no_year") == 0, "year").when(F.col("_no_movie") == 0, "movie").otherwise("day")
    return sets.select(part.alias("part"), "watching_year", "movieId", "userId", "watching_date", "num_rows", "num_rated", "rating_sum")


def movie_sets(movies: DataFrame) -> DataFrame:
    """Grouping sets of the movies, in one pass: by year, by genre and by (year, genre).

    ``part`` (year, genre, both), ``production_year``, ``genre``, ``num_movies``, ``num_parts`` (genre parts). A movie counts once in its year however many genre parts it has, also none.
    """
    rows = movies.select("movieId", "production_year", F.posexplode_outer(split_genres("genres")).alias("pos", "genre"))
    year, genre = F.col("production_year"), F.col("genre")
    sets = rows.groupingSets([[year], [genre], [year, genre]], year, genre).agg(
        F.grouping("production_year").alias("_no_year"),
        F.grouping("genre").alias("_no_genre"),
        F.count(F.when(F.coalesce("pos", F.lit(0)) == 0, 1)).alias("num_movies"),
        F.count("pos").alias("num_parts"),
    )
    part = F.when(F.col("_no_year") == 1, "genre").when(F.col("_no_genre") == 1, "year").otherwise("both")
    return sets.select(part.alias("part"), "production_year", "genre", "num_movies", "num_parts")


def summaries_of(rating_groups: DataFrame, movie_groups: DataFrame, movies: DataFrame) -> dict[str, DataFrame]:
    """The summaries above (``ratings_per_year``, ``active_user_days_per_year``, ``ratings_per_genre``, ``movies_per_year``,
    ``genre_movies_per_year``, ``movies_per_genre``, ``dataset_totals``) from ``rating_sets`` and ``movie_sets``, which
    should be kept or written first: none of these reads the ratings again."""
    by_year, by_movie, by_day = (rating_groups.where(F.col("part") == p) for p in ("year", "movie", "day"))
    movie_year, movie_genre, both = (movie_groups.where(F.col("part") == p) for p in ("year", "genre", "both"))
    counted = lambda key, n: F.when(F.col(key).isNotNull(), F.col(n)).otherwise(0).alias("num_of_movies")
    # a movie without genre parts (null genres) has no genre row
    real = lambda df: df.where("num_parts > 0")
    totals = [
        by_day.agg(F.countDistinct("userId").alias("num_users"), F.coalesce(F.sum("num_rows"), F.lit(0)).alias("num_ratings")),
        movies.agg(F.countDistinct("movieId").alias("num_movies")),
        real(movie_genre).agg(F.countDistinct("genre").alias("num_genres")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), totals)
    return {
        "totals": stacked.agg(*[F.max(n).alias(n) for n in ("num_users", "num_movies", "num_genres", "num_ratings")]),
        "yearly_movies": movie_year.select("production_year", counted("production_year", "num_movies")).orderBy(F.col("num_of_movies").desc(), F.col("production_year").asc()),
        "yearly_genres_movies": real(both).select("production_year", "genre", counted("production_year", "num_parts")).orderBy(F.col("num_of_movies").desc(), F.col("production_year").asc(), F.col("genre").asc()),
        "genres_movies": real(movie_genre).select("genre", F.col("num_parts").alias("num_of_movies")).orderBy(F.col("genre").asc()),
        "yearly_watchings": by_year.select("watching_year", F.when(F.col("watching_year").isNotNull(), F.col("num_rows")).otherwise(0).alias("num_of_watchings")).orderBy(F.col("watching_year").asc()),
        "yearly_active_users": (
            by_day.select("userId", year_of_date_text("watching_date").alias("watching_year")).groupBy("watching_year")
            .agg(F.count("userId").alias("num_of_users")).orderBy(F.col("watching_year").desc())
        ),
        "genres_watchings": (
            by_movie.join(_genres(movies), "movieId", "inner").groupBy("genre")
            .agg(F.sum("num_rows").alias("num_of_watchings"), round2(_mean("rating_sum", "num_rated")).alias("average_rating"))
        ),
    }
