"""ALS recommender (explicit feedback): a reproducible split, training, held-out error, top-n per user.

* The split is a hash of (user, movie, seed), not ``randomSplit``: it does not depend on partitioning or on
  recomputation after an executor is lost, so train and test never overlap.
* ALS is Spark ML's block ALS; with the session's checkpoint folder set, it checkpoints its factors
  (``checkpointInterval``) so long lineage is cut.
* Recommendations are computed for the asked users only (``recommendForUserSubset``), keep rank and score, and
  meet the movie columns in a join bounded by users x n rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import fold_in, inner_product
from marquee.session import checkpoint_root, scratch_dir

# Fixed values of the reference model.
MAX_ITER = 10
REG_PARAM = 0.2
TRAIN_PERCENT = 80
DEFAULT_SEED = 42


def split_ratings(ratings: DataFrame, train_percent: int = TRAIN_PERCENT, seed: int = DEFAULT_SEED) -> DataFrame:
    """Adds ``is_train``: the first 8 hex digits of the md5 of ``userId:movieId:seed``, modulo 100, below
    ``train_percent``. Any engine computes the same split."""
    digest = F.md5(F.concat_ws(":", F.col("userId").cast("string"), F.col("movieId").cast("string"), F.lit(str(seed))).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return ratings.withColumn("is_train", bucket < F.lit(train_percent))


def rated_once(ratings: DataFrame) -> DataFrame:
    """``userId, movieId, rating`` of the records with a rating, written under the shared checkpoint folder: both sides of a
    split and all that training reads come from there, so what ``ratings`` is made of (a join, say) runs once."""
    rated = ratings.where(F.col("rating").isNotNull()).select("userId", "movieId", "rating")
    path = scratch_dir(ratings.sparkSession, "rated")
    rated.write.parquet(path)
    return ratings.sparkSession.read.schema(rated.schema).parquet(path)


def train_and_test(ratings: DataFrame, train_percent: int = TRAIN_PERCENT, seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """The two sides of the split, ``userId, movieId, rating``, of the records with a rating."""
    rated = ratings.where(F.col("rating").isNotNull()).select("userId", "movieId", "rating")
    split = split_ratings(rated, train_percent, seed)
    return split.where(F.col("is_train")).drop("is_train"), split.where(~F.col("is_train")).drop("is_train")


def warm_records(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test records whose user and movie both occur in train: those that a model with dropped cold starts predicts."""
    return test.join(train.select("userId"), "userId", "left_semi").join(train.select("movieId"), "movieId", "left_semi").select("userId", "movieId", "rating")


def mean_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """The plain predictor to compare a model with: the mean train rating of the movie, for warm records."""
    means = train.groupBy("movieId").agg(F.avg("rating").alias("prediction"))
    return warm_records(train, test).join(means, "movieId").select("userId", "movieId", "rating", "prediction")


def split_counts(ratings: DataFrame, train_percent: int = TRAIN_PERCENT, seed: int = DEFAULT_SEED) -> DataFrame:
    """``is_train, num_ratings``: sizes of the two sides of the split (rated records only)."""
    rated = ratings.where(F.col("rating").isNotNull())
    return split_ratings(rated, train_percent, seed).groupBy("is_train").agg(F.count(F.lit(1)).alias("num_ratings"))


def train_als(
    ratings: DataFrame,
    max_iter: int = MAX_ITER,
    reg_param: float = REG_PARAM,
    rank: int = 10,
    seed: int = DEFAULT_SEED,
    train_percent: int = TRAIN_PERCENT,
) -> tuple[ALSModel, DataFrame]:
    """Fit on the train side; returns ``(model, test)``. Records with a null rating take no part."""
    checkpoint_root(ratings.sparkSession)  # ALS checkpoints its factors there every 10 iterations
    train, test = train_and_test(ratings, train_percent, seed)
    als = ALS(
        maxIter=max_iter,
        regParam=reg_param,
        rank=rank,
        userCol="userId",
        itemCol="movieId",
        ratingCol="rating",
        coldStartStrategy="drop",
        seed=seed,
    )
    return als.fit(train), test


def predictions(model: ALSModel, test: DataFrame) -> DataFrame:
    """``userId, movieId, rating, prediction`` for held-out records whose user and movie were trained."""
    return model.transform(test).select("userId", "movieId", "rating", "prediction")


def evaluation(preds: DataFrame) -> DataFrame:
    """One row ``num_predictions, mse, rmse`` computed by a distributed aggregate."""
    sq = F.pow(F.col("rating") - F.col("prediction"), 2)
    return preds.agg(F.count(F.lit(1)).alias("num_predictions"), F.avg(sq).alias("mse")).withColumn(
        "rmse", F.sqrt("mse")
    )


def recommend_for_users(
    model: ALSModel, users: DataFrame | Iterable[int], movies: DataFrame, n: int = 10
) -> DataFrame:
    """Top ``n`` movies per asked user: ``userId, rank, movieId, score, title, genres, production_year``.

    ``users`` is a frame with ``userId`` or a list of ids; unknown users get no rows. A movie that is not in
    ``movies`` keeps its rank and score, with null columns.
    """
    if not isinstance(users, DataFrame):
        users = model.userFactors.sparkSession.createDataFrame([(int(u),) for u in users], "userId int")
    recs = model.recommendForUserSubset(users.select("userId").distinct(), n)
    ranked = recs.select("userId", F.posexplode("recommendations").alias("pos", "rec")).select(
        "userId",
        (F.col("pos") + 1).alias("rank"),
        F.col("rec.movieId").alias("movieId"),
        F.col("rec.rating").alias("score"),
    )
    return ranked.join(movies, "movieId", "left").select(
        "userId", "rank", "movieId", "score", "title", "genres", "production_year"
    )


def recommend_for_all_users(model: ALSModel, movies: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` movies of every user of the model: the columns of ``recommend_for_users``, with the score as a double.

    An exact search by inner product (``operators.inner_product``): items in blocks of falling norm, and a user is done
    when no later item can enter its list. Ties go to the smaller movie id.
    """
    found = inner_product.ranked(inner_product.search(model.userFactors, model.itemFactors, n))
    rows = found.select(F.col("user").cast("int").alias("userId"), "rank", F.col("item").cast("int").alias("movieId"), "score")
    return rows.join(movies, "movieId", "left").select("userId", "rank", "movieId", "score", "title", "genres", "production_year")


def split_new_users(ratings: DataFrame, percent: int = TRAIN_PERCENT, seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(old, known, asked)``: all rated records of the users that a model learns from, and of the others (a hash of the
    user, ``percent`` of 100 learn) the records that are known about them and those that are asked for."""
    rated = ratings.where(F.col("rating").isNotNull()).select("userId", "movieId", "rating")
    bucket = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("user"), F.col("userId").cast("string"), F.lit(str(seed))).cast("binary")), 1, 8), 16, 10).cast("bigint") % 100
    old, new = rated.where(bucket < percent), split_ratings(rated.where(bucket >= percent), percent, seed)
    return old, new.where("is_train").drop("is_train"), new.where(~F.col("is_train")).drop("is_train")


def predict_new_users(model: ALSModel, known: DataFrame, asked: DataFrame, reg_param: float = REG_PARAM) -> DataFrame:
    """``userId, movieId, rating, prediction`` for users that the model has not seen, from their ``known`` records: users and
    movies without any factors are left out, as in ``predictions``."""
    return fold_in.predict_with(fold_in.fold_in(known, model.itemFactors, model.rank, reg_param), model.itemFactors, asked)
