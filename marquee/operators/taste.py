"""Taste comparison of users (rating meaning), all from one (user, genre) profile.

The like / dislike thresholds are window columns of the profile (``with_taste_flags``), so the seven frames of a
comparison are views over one profile with no driver round trip. Column names are fixed (``first_*``,
``second_*`` plus the two user ids), so a user compared with itself, or many pairs, fit one frame.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.profile import user_genre_profile, with_taste_flags

SHARED_COLUMNS = [
    "genre",
    "first_user",
    "second_user",
    "first_watchings",
    "second_watchings",
    "first_rating",
    "second_rating",
]
FLAG_COLUMNS = ["first_likes", "first_dislikes", "second_likes", "second_dislikes"]


def _side(flagged: DataFrame, prefix: str) -> DataFrame:
    return flagged.select(
        F.col("userId").alias(f"{prefix}_user"),
        "genre",
        F.col("watchings").alias(f"{prefix}_watchings"),
        F.col("Average_Rating").alias(f"{prefix}_rating"),
        F.col("likes").alias(f"{prefix}_likes"),
        F.col("dislikes").alias(f"{prefix}_dislikes"),
    )


def _user(profile: DataFrame, user_id: int) -> DataFrame:
    return profile.where(F.col("userId") == F.lit(int(user_id)))


def pair_users(pairs: DataFrame) -> DataFrame:
    """Distinct ``userId`` of a frame of ``first_user, second_user``."""
    return (
        pairs.select(F.col("first_user").alias("userId"))
        .unionByName(pairs.select(F.col("second_user").alias("userId")))
        .distinct()
    )


def pair_profile(ratings: DataFrame, movies: DataFrame, users: Iterable[int] | DataFrame) -> DataFrame:
    """The profile of just the users being compared: a list of ids (the filter reaches the rating scan), or a
    frame of ``userId`` such as ``pair_users(pairs)`` (a left-semi join)."""
    return user_genre_profile(ratings, movies, user_ids=users)


def taste_pairs(profile: DataFrame, pairs: DataFrame | Iterable[tuple[int, int]]) -> DataFrame:
    """Shared genres of each (first_user, second_user) pair with both users' counts, means and like / dislike
    flags: ``SHARED_COLUMNS + FLAG_COLUMNS``.

    ``pairs`` is the caller's list, or a frame of ``first_user, second_user``; the profile is flagged per user
    first (windows over whole user profiles), then joined to the pairs on each side.
    """
    if not isinstance(pairs, DataFrame):
        pairs = profile.sparkSession.createDataFrame(
            [(int(a), int(b)) for a, b in pairs], "first_user int, second_user int"
        )
    flagged = with_taste_flags(profile)
    return (
        pairs.select("first_user", "second_user")
        .distinct()
        .join(_side(flagged, "first"), "first_user", "inner")
        .join(_side(flagged, "second"), ["second_user", "genre"], "inner")
        .select(*SHARED_COLUMNS, *FLAG_COLUMNS)
    )


def taste_shared(profile: DataFrame, first: int, second: int) -> DataFrame:
    """Genres both users rated: ``SHARED_COLUMNS``."""
    return taste_pairs(profile, [(first, second)]).select(*SHARED_COLUMNS)


def _both(profile: DataFrame, first: int, second: int, first_flag: str, second_flag: str) -> DataFrame:
    shared = taste_pairs(profile, [(first, second)])
    return shared.where(F.col(f"first_{first_flag}") & F.col(f"second_{second_flag}")).select(*SHARED_COLUMNS)


def taste_both_like(profile: DataFrame, first: int, second: int) -> DataFrame:
    return _both(profile, first, second, "likes", "likes")


def taste_both_dislike(profile: DataFrame, first: int, second: int) -> DataFrame:
    return _both(profile, first, second, "dislikes", "dislikes")


def taste_like_dislike(profile: DataFrame, first: int, second: int) -> DataFrame:
    """Genres the first user likes and the second dislikes (joined on genre, not a cross product)."""
    return _both(profile, first, second, "likes", "dislikes")


def taste_dislike_like(profile: DataFrame, first: int, second: int) -> DataFrame:
    return _both(profile, first, second, "dislikes", "likes")


def taste_only_first(profile: DataFrame, first: int, second: int) -> DataFrame:
    """The first user's profile rows for genres the second user never rated (``userId, genre,
    Average_Rating, watchings``). Genre is unique per user in a profile, so an anti join equals the set
    difference joined back."""
    return _user(profile, first).join(_user(profile, second).select("genre"), "genre", "left_anti").select(
        "userId", "genre", "Average_Rating", "watchings"
    )


def taste_only_second(profile: DataFrame, first: int, second: int) -> DataFrame:
    return taste_only_first(profile, second, first)


def genre_set_except(profile: DataFrame, first: int, second: int) -> DataFrame:
    """The pure set form: distinct genres of the first user minus those of the second (``EXCEPT``)."""
    return _user(profile, first).select("genre").subtract(_user(profile, second).select("genre"))
