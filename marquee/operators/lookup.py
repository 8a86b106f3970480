"""Filters and lookups. User text is always a literal in a Column expression, never pasted into SQL text, so
an apostrophe is just a character and ``%`` / ``_`` are not wildcards."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import split_genres
from marquee.operators.model import with_movies


def _ids(values: Iterable[int]) -> list[int]:
    return [int(v) for v in values]


def user_ratings(ratings: DataFrame, movies: DataFrame, user_id: int) -> DataFrame:
    """One user's rating records with the movie columns (records of unknown movies drop out)."""
    return ratings.where(F.col("userId") == F.lit(int(user_id))).join(movies, "movieId", "inner")


def users_ratings(ratings: DataFrame, movies: DataFrame, user_ids: Iterable[int] | DataFrame) -> DataFrame:
    """Several users' rating records. A long id list is best given as a frame with a ``userId`` column, which is
    applied as a left-semi join instead of an ``IN`` list."""
    if isinstance(user_ids, DataFrame):
        picked = ratings.join(user_ids.select("userId").distinct(), "userId", "left_semi")
    else:
        picked = ratings.where(F.col("userId").isin(_ids(user_ids)))
    return picked.join(movies, "movieId", "inner")


def movie_by_id(frame: DataFrame, movie_id: int) -> DataFrame:
    """Rows of any frame with a ``movieId`` column for one movie."""
    return frame.where(F.col("movieId") == F.lit(int(movie_id)))


def movie_title_contains(frame: DataFrame, fragment: str) -> DataFrame:
    return frame.where(F.col("title").contains(F.lit(fragment)))


def movie_title_exact(frame: DataFrame, title: str | Column) -> DataFrame:
    """Exact title match; ``title`` may be a Column, such as a scalar subquery."""
    return frame.where(F.col("title") == (title if isinstance(title, Column) else F.lit(title)))


def genre_contains(movies: DataFrame, fragment: str) -> DataFrame:
    """Movies whose genre text contains a fragment (``ring`` matches ``ring`` and ``string``)."""
    return movies.where(F.col("genres").contains(F.lit(fragment)))


def movies_in_genre_list(movies: DataFrame, genres: Iterable[str]) -> DataFrame:
    """One row per (movie, genre part) whose genre is in the list: ``movieId, genre, title, genres,
    production_year``. The (movie, genre) table is the explode of movies, so no join is needed."""
    exploded = movies.select("movieId", F.explode(split_genres("genres")).alias("genre"), "title", "genres", "production_year")
    return exploded.where(F.col("genre").isin(list(genres)))


def genre_counts_samples(movies: DataFrame, fragments: Iterable[str], samples: int = 5) -> DataFrame:
    """Per genre fragment: the number of movies whose genres contain it, and its first ``samples`` movies by id.

    ``fragment, num_movies, sample_rank, movieId, title, genres, production_year``. Each movie lists the fragments its
    genres contain, so one scan serves all of them without a join. Counting is a partial aggregate; the samples are
    a ``row_number() <= k`` filter, which Spark plans as a per-partition group limit before the shuffle, so a
    fragment matching most movies still moves only k rows per partition. A fragment without a match has one row with
    count 0 and no sample.
    """
    spark = movies.sparkSession
    asked = list(dict.fromkeys(fragments))
    frags = spark.createDataFrame([(f,) for f in asked], "fragment string")
    listed = F.filter(F.array(*map(F.lit, asked)), lambda f: F.col("genres").contains(f))
    matches = movies.select("*", F.explode(listed).alias("fragment"))
    counts = matches.groupBy("fragment").agg(F.count(F.lit(1)).alias("num_movies"))
    first = Window.partitionBy("fragment").orderBy(F.col("movieId").asc())
    picked = matches.withColumn("sample_rank", F.row_number().over(first)).where(F.col("sample_rank") <= samples)
    return (
        frags.join(counts, "fragment", "left").join(picked, "fragment", "left")
        .withColumn("num_movies", F.coalesce("num_movies", F.lit(0)))
        .select("fragment", "num_movies", "sample_rank", "movieId", "title", "genres", "production_year")
    )


def movies_by_year(movies: DataFrame, year: int | str) -> DataFrame:
    """Titles ending in ``(year)`` exactly; no trim, unlike the production-year column."""
    return movies.where(F.col("title").endswith(F.lit(f"({year})")))


def titles_rated_or_tagged(interactions: DataFrame, movies: DataFrame, user_ids: Iterable[int]) -> DataFrame:
    """``titles_by_users`` from the interactions themselves: the genres play no part, so nothing is exploded."""
    return with_movies(interactions.where(F.col("userId").isin(_ids(user_ids))), movies).select("title").distinct()


def titles_by_users(wide: DataFrame, user_ids: Iterable[int]) -> DataFrame:
    """Distinct titles that any of the users rated or tagged (interaction meaning)."""
    return wide.where(F.col("userId").isin(_ids(user_ids))).select("title").distinct()


def titles_in_genres(wide: DataFrame, genres: Iterable[str], distinct: bool = False) -> DataFrame:
    """Titles of interactions in any of the genres: one row per (user, movie, matching genre) unless distinct."""
    picked = wide.where(F.col("genre").isin(list(genres)))
    if distinct:
        return picked.select("title").distinct()
    if "weight" in wide.columns:  # a folded table: give each row back its repeats
        return picked.select(F.explode(F.array_repeat(F.col("title"), F.col("weight").cast("int"))).alias("title"))
    return picked.select("title")


def user_detail(ratings: DataFrame, movies: DataFrame, user_ids: Iterable[int]) -> tuple[DataFrame, DataFrame]:
    """``(totals, history)`` for users: ``userId, num_genres, num_movies`` (genres rated, rating records of known
    movies) and ``userId, title, watching_date, rating``. Every asked user has a totals row, with zeros if unknown.

    One read of the ratings: the first genre part of a record stands for the record."""
    ids = list(dict.fromkeys(_ids(user_ids)))
    history = ratings.where(F.col("userId").isin(ids)).join(movies, "movieId", "inner")
    parts = history.select("userId", F.posexplode(split_genres("genres")).alias("pos", "genre"))
    counted = parts.groupBy("userId").agg(
        F.countDistinct("genre").alias("num_genres"), F.sum(F.when(F.col("pos") == 0, 1).otherwise(0)).alias("num_movies")
    )
    asked = ratings.sparkSession.createDataFrame([(i,) for i in ids], "userId int")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    totals = asked.join(counted, "userId", "left").select("userId", zero("num_genres"), zero("num_movies"))
    return totals, history.select("userId", "title", "watching_date", "rating")


def genre_detail(movies: DataFrame, fragment: str) -> tuple[DataFrame, DataFrame]:
    """``(totals, movies)`` of a genre fragment: one row ``genre, num_movies`` (0 when nothing matches) and the
    matching movies."""
    matching = genre_contains(movies, fragment)
    totals = matching.agg(F.count(F.lit(1)).alias("num_movies")).select(F.lit(fragment).alias("genre"), "num_movies")
    return totals, matching
