"""Distributions of users' mean ratings: equal-width histograms, every bin listed (empty bins count 0).

Bins follow the plotting default the reference relied on: 10 equal bins from the smallest to the largest
value, the largest value in the last bin; when all values are equal the range is widened by 0.5 each side.

Plan: the values are counted per distinct (key, value) by a partial aggregate; the per-key range is joined back on the
key (one row per key, so it is small and broadcast by size when it fits; a hot key is split by AQE's skew join
otherwise), each distinct value gets its bin by arithmetic, and one partial aggregate per key sums all bins as
columns, which are then turned into rows. No value list is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import histogram_bin, histogram_edge
from marquee.operators.model import row_weight
from marquee.operators.profile import genre_stats, weighted_mean

DEFAULT_BINS = 10


def equal_width_histogram(
    values: DataFrame, key: str, value: str, bins: int = DEFAULT_BINS, count_name: str = "num_users"
) -> DataFrame:
    """``key, bin, bin_start, bin_end, <count_name>`` per key of ``values``; null values are left out.

    The values are first counted per distinct (key, value), so the per-user rows cross the network once; the
    range and the binning then read that table, which is the smaller the more the means repeat.
    """
    by_value = (
        values.where(F.col(value).isNotNull())
        .groupBy(key, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    same = F.col("_mn") == F.col("_mx")
    ranges = (
        by_value.groupBy(key)
        .agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
        .select(
            key,
            F.when(same, F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
            F.when(same, F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"),
        )
    )
    lo, hi = F.col("_lo"), F.col("_hi")
    placed = by_value.join(ranges, key, "inner").select(
        key, "_lo", "_hi", "_n", histogram_bin(F.col(value), lo, hi, bins).alias("_bin")
    )
    # one group per key holds all of its bins, so the empty ones need no second branch
    sums = [F.sum(F.when(F.col("_bin") == i, F.col("_n")).otherwise(0)).alias(f"_b{i}") for i in range(bins)]
    per_key = placed.groupBy(key).agg(F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"), *sums)
    rows = F.array(*[F.struct(F.lit(i).alias("bin"), F.col(f"_b{i}").alias("n")) for i in range(bins)])
    return per_key.select(key, "_lo", "_hi", F.explode(rows).alias("_r")).select(
        key,
        F.col("_r.bin").alias("bin"),
        histogram_edge(F.col("_r.bin"), lo, hi, bins).alias("bin_start"),
        histogram_edge(F.col("_r.bin") + 1, lo, hi, bins).alias("bin_end"),
        F.col("_r.n").alias(count_name),
    )


def genre_rating_histogram(wide: DataFrame, genre: str | Column | None = None, bins: int = DEFAULT_BINS) -> DataFrame:
    """Distribution over users of their mean rating of a genre (interaction meaning); all genres when
    ``genre`` is None."""
    picked = wide if genre is None else wide.where(F.col("genre") == (genre if isinstance(genre, Column) else F.lit(genre)))
    return equal_width_histogram(genre_stats(picked), "genre", "avgRating", bins)


def movie_rating_histogram(wide: DataFrame, title: str | Column | None = None, bins: int = DEFAULT_BINS) -> DataFrame:
    """Distribution over users of their mean rating of an exact title (several movies may share it; rows of the
    wide table are averaged as they come, once per genre part); all titles when ``title`` is None."""
    picked = wide if title is None else wide.where(F.col("title") == (title if isinstance(title, Column) else F.lit(title)))
    per_user = picked.groupBy("userId", "title").agg(weighted_mean("rating", row_weight(picked)).alias("avgRating"))
    return equal_width_histogram(per_user, "title", "avgRating", bins)
