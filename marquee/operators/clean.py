"""Cleaning: raw string tables to typed tables, and the (movie, genre) table.

* rows with a null in any raw column are dropped (as the source rule does);
* ids that do not parse leave the table (a key must be a key); a rating text that does not parse
  (``n/a``) becomes a null rating and stays, unless ``drop_malformed`` is set;
* ``watching_date`` is the UTC day of the epoch-seconds ``timestamp``, computed without the session zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import epoch_seconds, epoch_to_date_text, production_year, split_genres, strict_year


def clean_ratings(raw_ratings: DataFrame, drop_malformed: bool = False) -> DataFrame:
    typed = raw_ratings.na.drop(how="any").select(
        F.col("userId").try_cast("int").alias("userId"),
        F.col("movieId").try_cast("int").alias("movieId"),
        F.col("rating").try_cast("float").alias("rating"),
        F.col("timestamp"),
        epoch_to_date_text(epoch_seconds("timestamp")).alias("watching_date"),
    )
    required = ["userId", "movieId"] + (["rating", "watching_date"] if drop_malformed else [])
    return typed.na.drop(how="any", subset=required)


def clean_movies(raw_movies: DataFrame, year_rule: str = "suffix") -> DataFrame:
    """``year_rule='suffix'`` takes the four characters before the last one of the trimmed title (the source
    rule); ``'strict'`` takes a year only from a real ``(YYYY)`` ending, else null."""
    year = production_year("title") if year_rule == "suffix" else strict_year("title")
    return (
        raw_movies.na.drop(how="any")
        .select(
            F.col("movieId").try_cast("int").alias("movieId"),
            F.col("title"),
            F.col("genres"),
            year.alias("production_year"),
        )
        .na.drop(how="any", subset=["movieId"])
    )


def clean_tags(raw_tags: DataFrame) -> DataFrame:
    """Tags keep only their keys and text; rows whose keys do not parse are dropped."""
    return raw_tags.select(
        F.col("userId").try_cast("int").alias("userId"),
        F.col("movieId").try_cast("int").alias("movieId"),
        F.col("tag"),
    ).na.drop(how="any", subset=["userId", "movieId"])


def movie_genres(movies: DataFrame) -> DataFrame:
    """One row per (movie, genre part) of the cleaned movies; ``A||B`` gives an empty genre, ``A|A`` two rows."""
    return movies.select("movieId", F.explode(split_genres("genres")).alias("genre"))
