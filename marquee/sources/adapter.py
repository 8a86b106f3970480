"""The driver's Parquet tables seen as the three raw source tables (all string columns, as CSV gives them).

One rule per column:

* movies.movieId   = ``part.p_partkey``
* movies.title     = ``p_name``, a space, then ``(1950 + p_size)``
* movies.genres    = ``p_name`` with its space turned into a pipe, then ``|p_type|p_brand``
* ratings.userId   = ``orders.o_custkey``, joined to lineitem on the order key
* ratings.movieId  = ``lineitem.l_partkey``
* ratings.rating   = ``((int(l_quantity) - 1) mod 10 + 1) / 2``
* ratings.timestamp= epoch seconds of ``l_shipdate`` (a timestamp without zone, read as UTC)
* tags.userId      = ``events.user_id``;  tags.movieId = number at ``$.k`` of ``events.props``
* tags.tag         = ``events.event_type``; tags.timestamp = epoch seconds of ``events.ts``

``dirty=True`` adds the blemishes that the cleaning step must handle: null ratings and the text ``n/a``,
null genres and titles without a year, each on a fixed residue class of the source key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.columns import epoch_seconds_of_ntz

# Fixed values of the adapter.
FIRST_YEAR_OFFSET = 1950
DIRTY_RATING_NULL_MOD = 97
DIRTY_RATING_NA_MOD = 101
DIRTY_RATING_NA_TEXT = "n/a"
DIRTY_GENRES_NULL_MOD = 37
DIRTY_TITLE_NO_YEAR_MOD = 41


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _only(df: DataFrame, column: str, ids: Iterable[int] | None) -> DataFrame:
    """Rows of some ids, tested on the table's own column so that the Parquet reader gets the filter; the typed filter
    of a lookup sits above the casts and cannot reach it."""
    return df if ids is None else df.where(F.col(column).isin([int(i) for i in ids]))


def raw_movies(spark: SparkSession, sf_dir: str, dirty: bool = False, movie_ids: Iterable[int] | None = None) -> DataFrame:
    part = _only(read_table(spark, sf_dir, "part"), "p_partkey", movie_ids)
    title = F.concat(F.col("p_name"), F.lit(" ("), (F.lit(FIRST_YEAR_OFFSET) + F.col("p_size")).cast("string"), F.lit(")"))
    genres = F.concat(F.regexp_replace("p_name", " ", "|"), F.lit("|"), F.col("p_type"), F.lit("|"), F.col("p_brand"))
    if dirty:
        key = F.col("p_partkey")
        title = F.when(key % DIRTY_TITLE_NO_YEAR_MOD == 0, F.col("p_name")).otherwise(title)
        genres = F.when(key % DIRTY_GENRES_NULL_MOD == 0, F.lit(None).cast("string")).otherwise(genres)
    return part.select(
        F.col("p_partkey").cast("string").alias("movieId"),
        title.alias("title"),
        genres.alias("genres"),
    )


def raw_ratings(
    spark: SparkSession,
    sf_dir: str,
    dirty: bool = False,
    user_ids: Iterable[int] | None = None,
    movie_ids: Iterable[int] | None = None,
) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lineitem, orders = _only(lineitem, "l_partkey", movie_ids), _only(orders, "o_custkey", user_ids)
    rating = (((F.col("l_quantity").cast("int") - 1) % 10 + 1) / 2).cast("string")
    if dirty:
        key = F.col("l_orderkey")
        rating = (
            F.when(key % DIRTY_RATING_NULL_MOD == 0, F.lit(None).cast("string"))
            .when(key % DIRTY_RATING_NA_MOD == 0, F.lit(DIRTY_RATING_NA_TEXT))
            .otherwise(rating)
        )
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("o_custkey").cast("string").alias("userId"),
        F.col("l_partkey").cast("string").alias("movieId"),
        rating.alias("rating"),
        epoch_seconds_of_ntz("l_shipdate").cast("string").alias("timestamp"),
    )


def raw_tags(spark: SparkSession, sf_dir: str, user_ids: Iterable[int] | None = None) -> DataFrame:
    events = _only(read_table(spark, sf_dir, "events"), "user_id", user_ids)
    return events.select(
        F.col("user_id").cast("string").alias("userId"),
        F.get_json_object("props", "$.k").alias("movieId"),
        F.col("event_type").alias("tag"),
        epoch_seconds_of_ntz("ts").cast("string").alias("timestamp"),
    )
