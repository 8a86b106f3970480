"""Leaderboards: top rated and most watched movies (rating meaning).

Plan: aggregate ratings per movie first (partial aggregation, so a hot movie is combined map-side), keep the ids
present in movies (a semi-join on ids alone), take the first n (a per-partition top-n and a merge), and only then
join the movie columns, so titles and genres of n movies move, not of all. Ties break on ``movieId``, so the n rows
are always the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_ROWS = 20


def _per_movie_top(per_movie: DataFrame, movies: DataFrame, metric: str, n: int | None) -> DataFrame:
    order = (F.col(metric).desc(), F.col("movieId").asc())
    if n is None:
        return per_movie.join(movies, "movieId", "inner").orderBy(*order)
    top = per_movie.join(movies.select("movieId"), "movieId", "left_semi").orderBy(*order).limit(n)
    return top.join(movies, "movieId", "inner").orderBy(*order).limit(n)


def top_rated(ratings: DataFrame, movies: DataFrame, n: int | None = DEFAULT_ROWS) -> DataFrame:
    """``movieId, Average_Rating, title, genres, production_year`` by mean rating, highest first; no minimum
    count (a movie with one 5.0 ranks first). Movies whose ratings are all null have a null mean and sort last."""
    per_movie = ratings.groupBy("movieId").agg(F.avg("rating").alias("Average_Rating"))
    return _per_movie_top(per_movie, movies, "Average_Rating", n)


def top_watched(ratings: DataFrame, movies: DataFrame, n: int | None = DEFAULT_ROWS) -> DataFrame:
    """``movieId, Number_OF_Watchings, title, genres, production_year`` by number of rating records."""
    per_movie = ratings.groupBy("movieId").agg(F.count("movieId").alias("Number_OF_Watchings"))
    return _per_movie_top(per_movie, movies, "Number_OF_Watchings", n)
