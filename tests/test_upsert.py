"""Interactions kept up to date batch by batch against the batch query."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from marquee.operators.model import interactions
from marquee.sinks import save_as_csv
from marquee.sources import adapter
from marquee.streaming.upsert import InteractionStore, upsert_stream


def parts(df, n):
    return [df.where(F.pmod(F.xxhash64(*df.columns), F.lit(n)) == k) for k in range(n)]


def test_batches_in_any_order_and_replays(spark, small, tmp_path):
    store = InteractionStore(spark, str(tmp_path / "state"), buckets=4)
    assert store.interactions().count() == 0
    ratings, tags = parts(small.ratings, 3), parts(small.tags, 2)
    assert store.apply("ratings", 0, ratings=ratings[2]) and store.apply("tags", 0, tags=tags[1]) and store.apply("ratings", 1, ratings=ratings[0])
    assert not store.apply("ratings", 1, ratings=ratings[0])  # again
    assert not store.apply("ratings", 0, ratings=ratings[1])  # an old number
    assert rows(store.interactions()) == rows(interactions(ratings[2].union(ratings[0]), tags[1]))
    assert store.apply("tags", 1, tags=tags[0]) and store.apply("ratings", 2, ratings=ratings[1])
    assert rows(store.interactions()) == rows(interactions(small.ratings, small.tags))
    assert store.apply("ratings", 3, ratings=small.ratings)  # the same records under a new number change nothing
    assert rows(store.interactions()) == rows(interactions(small.ratings, small.tags))


def test_a_batch_that_fails_changes_nothing(spark, small, tmp_path):
    store = InteractionStore(spark, str(tmp_path / "state"), buckets=4)
    store.apply("ratings", 0, ratings=small.ratings.where("userId < 20"))
    before = rows(store.interactions())
    bad = small.ratings.withColumn("rating", F.when(F.col("userId") == 21, F.raise_error(F.lit("lost")).cast("float")).otherwise(F.col("rating")))
    with pytest.raises(Exception, match="lost"):
        store.apply("ratings", 1, ratings=bad)
    assert rows(store.interactions()) == before
    assert store.apply("ratings", 1, ratings=small.ratings) and rows(store.interactions()) == rows(interactions(small.ratings, small.tags.limit(0)))


def test_null_keys_ties_and_undated_records(spark, tmp_path):
    store = InteractionStore(spark, str(tmp_path / "state"), buckets=3)
    ratings = spark.createDataFrame([(1, 1, 4.0, "5", None), (1, 1, 3.0, "9", None), (1, 1, 2.0, "9", None), (None, 1, 1.0, "1", None), (2, 2, None, "3", None), (2, 2, 5.0, "x", None), (3, 3, 1.5, "-7", None)], "userId int, movieId int, rating float, timestamp string, watching_date string")
    tags = spark.createDataFrame([(1, 1, "t"), (4, 4, None), (4, 4, "u"), (None, None, "v")], "userId int, movieId int, tag string")
    for k, row in enumerate(parts(ratings, 5)):
        store.apply("ratings", k, ratings=row)
    store.apply("tags", 0, tags=tags)
    assert rows(store.interactions()) == rows(interactions(ratings, tags))


def test_streams_of_files(spark, small, tmp_path):
    """Files come in two goes; the streams take up where they were."""
    raw_ratings, raw_tags = adapter.raw_ratings(spark, SMALL), adapter.raw_tags(spark, SMALL)
    store = InteractionStore(spark, str(tmp_path / "state"), buckets=4)
    for go, (r, t) in enumerate(zip(parts(raw_ratings, 2), parts(raw_tags, 2))):
        save_as_csv(r.coalesce(2), str(tmp_path / "ratings"), mode="append")
        save_as_csv(t.coalesce(1), str(tmp_path / "tags"), mode="append")
        for table in ("ratings", "tags"):
            assert upsert_stream(store, str(tmp_path / table), table, str(tmp_path / f"check-{table}"), max_files_per_trigger=1).awaitTermination(120)
    assert rows(store.interactions()) == rows(interactions(small.ratings, small.tags))
