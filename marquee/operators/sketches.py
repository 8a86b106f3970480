"""Distinct counts over data that keeps growing: a sketch per day, stored, and united for any period.

A day's users are read once, when the day is new. Counts of a year, of all time or of any days are unions of the stored
sketches (a few KB each), so they cost the number of days, not of ratings. Sketches that are built in parts, merged in any
order or counted twice give the same count as one built from all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import year_of_date_text

#: Binary logarithm of a sketch's registers; the standard error is about 1.04 / sqrt(2 ** LOG_K), here 0.8 %.
LOG_K = 14
#: Tasks that a day's records are dealt over, at most: as many sketches of a day cross the network.
SLICES = 8


def daily_sketches(ratings: DataFrame, log_k: int = LOG_K) -> DataFrame:
    """``watching_date, users, num_ratings``: a sketch of the users of each day and the day's number of records. Records
    without a date have a row of their own, with a null date; null users are not counted.

    Records are dealt by day and a slice of its users first. Otherwise every task would have a sketch of nearly every day,
    and these (up to 16 KB each) would cross the network in numbers that grow with the tasks."""
    dealt = ratings.select("watching_date", "userId").repartition("watching_date", F.pmod(F.xxhash64("userId"), F.lit(SLICES)))
    return dealt.groupBy("watching_date").agg(F.hll_sketch_agg("userId", F.lit(log_k)).alias("users"), F.count(F.lit(1)).alias("num_ratings"))


def append_days(ratings: DataFrame, path: str) -> None:
    """Add the sketches of newly come ratings to those under ``path``; a day may come in several parts."""
    daily_sketches(ratings).write.mode("append").parquet(path)


def users_per_year(sketches: DataFrame) -> DataFrame:
    """``watching_year, num_users`` (estimated), ``num_ratings`` (exact) from stored sketches."""
    rows = sketches.select(year_of_date_text("watching_date").alias("watching_year"), "users", "num_ratings")
    return rows.groupBy("watching_year").agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("num_users"), F.sum("num_ratings").alias("num_ratings"))


def users_between(sketches: DataFrame, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """One row ``num_users, num_ratings`` of the days from ``first_day`` to ``last_day`` (text, both included; null: open);
    zeros if there is none."""
    rows = sketches
    if first_day is not None:
        rows = rows.where(F.col("watching_date") >= first_day)
    if last_day is not None:
        rows = rows.where(F.col("watching_date") <= last_day)
    found = rows.agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("n"), F.sum("num_ratings").alias("r"))
    return found.select(F.coalesce("n", F.lit(0)).alias("num_users"), F.coalesce("r", F.lit(0)).alias("num_ratings"))
