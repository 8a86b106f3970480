"""Rows-only checks of the recommender: the data is random, so model quality is never tested."""

import math

from pyspark.sql import functions as F

from marquee.operators import recommend


def test_split_is_disjoint_stable_and_near_80_percent(small):
    a = recommend.split_ratings(small.ratings)
    b = recommend.split_ratings(small.ratings.repartition(7))
    key = ["userId", "movieId", "timestamp", "rating", "is_train"]
    assert a.select(*key).exceptAll(b.select(*key)).count() == 0
    share = a.where("is_train").count() / a.count()
    assert 0.75 < share < 0.85


def test_train_predict_recommend(small):
    model, test = recommend.train_als(small.ratings, max_iter=5)
    preds = recommend.predictions(model, test)
    (m,) = recommend.evaluation(preds).collect()
    assert m.num_predictions > 0 and math.isfinite(m.mse) and math.isclose(m.rmse, math.sqrt(m.mse))
    recs = recommend.recommend_for_users(model, [1, 3, 99999999], small.movies, n=10)
    per_user = {r.userId: r["count"] for r in recs.groupBy("userId").count().collect()}
    assert per_user == {1: 10, 3: 10}
    ranks = [r["rank"] for r in recs.where("userId = 1").orderBy("rank").collect()]
    assert ranks == list(range(1, 11))
    scores = [r.score for r in recs.where("userId = 1").orderBy("rank").collect()]
    assert scores == sorted(scores, reverse=True)
    assert recs.where(F.col("title").isNull()).count() == 0


def test_the_split_is_the_md5_of_the_pair(small):
    import hashlib

    for r in recommend.split_ratings(small.ratings.limit(200), seed=7).collect():
        digest = hashlib.md5(f"{r.userId}:{r.movieId}:7".encode()).hexdigest()
        assert r.is_train == (int(digest[:8], 16) % 100 < 80)


def test_ranks_stay_complete_when_movies_are_missing(small):
    model, _ = recommend.train_als(small.ratings, max_iter=2)
    recs = recommend.recommend_for_users(model, [1, 3], small.movies.where("movieId % 2 = 0"), n=10).collect()
    assert sorted((r.userId, r["rank"]) for r in recs) == [(u, k) for u in (1, 3) for k in range(1, 11)]
    assert any(r.title is None for r in recs) and all(r.score is not None for r in recs)


def test_source_records_are_read_once(spark, small, monkeypatch):
    """Training, the held-out side and the folded-in users of a query all come from one reading of the ratings."""
    from marquee.plans import registry

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    ratings = small.ratings.select("userId", "movieId", "rating").where("userId % 5 = 0")
    total = ratings.count()
    bundle = type("Tables", (), {"ratings": ratings.mapInArrow(counted, ratings.schema), "movies": small.movies})()
    monkeypatch.setattr(registry, "tables", lambda *_: bundle)
    for query in ("als_metrics", "cold_start_predictions", "mean_predictor_metrics"):
        registry.forget_models()
        read.value = 0
        assert registry.queries()[query](spark, "counted").count() > 0
        assert read.value == total, query
    registry.forget_models()


def test_asked_users_come_from_the_records_that_training_wrote(spark, small, monkeypatch):
    """The top lists read the ratings once as well: asked users without ratings get no rows, nor do those without records."""
    from marquee.plans import registry

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    kept = small.ratings.select("userId", "movieId", "rating").where("userId % 5 = 0 or userId = 3")
    ratings = kept.withColumn("rating", F.when(F.col("userId") != 3, F.col("rating")))
    total = ratings.count()
    bundle = type("Tables", (), {"ratings": ratings.mapInArrow(counted, ratings.schema), "movies": small.movies})()
    monkeypatch.setattr(registry, "tables", lambda *_: bundle)
    for query in ("recommendations", "recommendation_ranks"):
        registry.forget_models()
        read.value = 0
        assert {r.userId for r in registry.queries()[query](spark, "counted").collect()} == {5}
        assert read.value == total, query
    registry.forget_models()
