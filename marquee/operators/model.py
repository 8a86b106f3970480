"""The interaction tables.

``interactions``: one row per distinct (user, movie) that was rated or tagged; ``rating`` is the rating with the
greatest (timestamp, rating), null when the pair was only tagged.

Plan: a union of the two key sets and grouping, not a full outer join. A union keeps a filter on the keys
(``userId = 1``) pushable into both scans, which a full outer join blocks (the filter would sit above it as
``coalesce(l.userId, r.userId) = 1``); the aggregates are partial (map-side), so a hot pair or user is combined
before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import epoch_seconds, split_genres

# Fixed value: a rating record whose timestamp does not parse ranks below every dated record of its pair.
_UNDATED = -(2**63)
# Ratings lie within -10^6 and 10^6; a place in time and rating is seconds * _STEP + rating, exact as a decimal.
_STEP, _BELOW = 10_000_000, -2_000_000


def keyed_records(ratings: DataFrame, tags: DataFrame) -> DataFrame:
    """``userId, movieId, place, rating``: a row per record, with its place in time and rating (null of a tag).

    ``max(struct(ts, rating))`` would need a sort-based aggregate (struct buffers
    cannot be hash-aggregated), so time and rating are packed into one decimal key: ``ts * 10^7 + rating``, which
    orders as the pair does for every bigint ``ts`` and every rating between -10^6 and 10^6. A null rating (or one
    outside that range) ranks below every rating of its second. The aggregate is partial: a hot pair is combined before
    the shuffle. Tag rows have a null key and are skipped by ``max_by``, which leaves the rating null for pairs that
    were only tagged."""
    seconds = F.coalesce(epoch_seconds("timestamp"), F.lit(_UNDATED).cast("bigint")).cast("decimal(20,0)")
    exact = F.col("rating").try_cast("decimal(14,6)")
    value = F.when(F.abs(exact) <= 1_000_000, exact).otherwise(F.lit(_BELOW).cast("decimal(14,6)"))
    rated = ratings.select(
        "userId",
        "movieId",
        (seconds * F.lit(_STEP).cast("decimal(8,0)") + value).cast("decimal(35,6)").alias("place"),
        F.col("rating"),
    )
    tagged = tags.select(
        "userId", "movieId", F.lit(None).cast("decimal(35,6)").alias("place"), F.lit(None).cast("float").alias("rating")
    )
    return rated.unionByName(tagged).where(F.col("userId").isNotNull() & F.col("movieId").isNotNull())


def latest_of_pairs(keyed: DataFrame) -> DataFrame:
    """``userId, movieId, place, rating`` of the greatest place of each pair; merging such rows again gives the same."""
    return keyed.groupBy("userId", "movieId").agg(F.max("place").alias("place"), F.max_by("rating", "place").alias("rating"))


def interactions(ratings: DataFrame, tags: DataFrame) -> DataFrame:
    """One row per rated or tagged pair, by one hash aggregate and one shuffle over ``keyed_records``."""
    return keyed_records(ratings, tags).groupBy("userId", "movieId").agg(F.max_by("rating", "place").alias("rating"))


def with_movies(interactions: DataFrame, movies: DataFrame) -> DataFrame:
    """Interactions of movies that exist and have genres, with the movie columns (no explode)."""
    return interactions.join(movies.where(F.col("genres").isNotNull()), "movieId", "inner")


def interactions_wide(interactions: DataFrame, movies: DataFrame) -> DataFrame:
    """One row per (interaction, genre part): ``rating, userId, movieId, title, genre``.

    Interactions of unknown movies or of movies without genres have no row, as with the left join and explode
    of the source rule (explode of a null array yields nothing), so an inner join says the same.
    """
    return with_movies(interactions, movies).select(
        "rating", "userId", "movieId", "title", F.explode(split_genres("genres")).alias("genre")
    )


def _weight(parts: str):
    return F.size(F.filter(parts, lambda part: part == F.col("genre"))).cast("bigint")


def genre_parts(movies: DataFrame) -> DataFrame:
    """``movieId, title, genre, weight``: distinct genre parts of each movie with genres, ``weight`` = how often
    the part occurs in the movie's list (``A|A`` gives one row of weight 2). Movie-sized, never rating-sized."""
    # All parts of a movie are in its own row, so the fold is row-local (no shuffle): each distinct part, with
    # the number of parts equal to it.
    parts = split_genres("genres")
    return (
        movies.where(F.col("genres").isNotNull())
        .select("movieId", "title", parts.alias("_parts"), F.explode(F.array_distinct(parts)).alias("genre"))
        .select(
            "movieId",
            "title",
            "genre",
            _weight("_parts").alias("weight"),
        )
    )


def interaction_genres(interactions: DataFrame, movies: DataFrame, tasks: int | None = None) -> DataFrame:
    """The wide table with repeats folded: ``rating, userId, movieId, title, genre, weight``, one row per
    distinct (user, movie, genre). Every interaction-meaning operator accepts it in place of the wide table and
    weighs rows by ``weight``, which gives the wide table's results with plain counts instead of distinct
    counts (one aggregation level, so one shuffle fewer).

    Behind a join the rows of a task multiply by the genre parts, and an aggregate by user and genre keeps a group for
    nearly each of them: ``tasks`` deals the joined pairs over so many tasks before they multiply, which bounds that memory
    whatever the size of the join's partitions."""
    if tasks is None:
        joined = interactions.join(genre_parts(movies), "movieId", "inner")
    else:
        # by user and movie, which are distinct, so neither a hot user nor a hot movie fills a task
        dealt = with_movies(interactions, movies).repartition(tasks, "userId", "movieId").withColumn("_parts", split_genres("genres"))
        joined = dealt.withColumn("genre", F.explode(F.array_distinct("_parts"))).withColumn("weight", _weight("_parts"))
    return joined.select("rating", "userId", "movieId", "title", "genre", "weight")


def row_weight(wide: DataFrame):
    """``weight`` of a folded table, 1 for the plain wide table."""
    return F.col("weight") if "weight" in wide.columns else F.lit(1)


def rated_genres(ratings: DataFrame, movies: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rating meaning: one row per (rating record, genre part of its movie); records of unknown movies drop out.

    Same rows as ratings joined to movies joined to the (movie, genre) table, with one join instead of two
    because the genre table is the explode of the movies table. ``tasks`` as in ``interaction_genres``.
    """
    if tasks is not None:
        dealt = ratings.join(movies.select("movieId", "genres"), "movieId", "inner").repartition(tasks, "userId", "movieId", "rating")
        return dealt.withColumn("genre", F.explode(split_genres("genres"))).drop("genres")
    genres = movies.select("movieId", F.explode(split_genres("genres")).alias("genre"))
    return ratings.join(genres, "movieId", "inner")
