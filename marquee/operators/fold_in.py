"""Users that a trained model has not seen: their factors from its item factors and their own ratings.

ALS fits a user's factors by a ridge regression of the user's ratings on the factors of the rated items. For a new user the
same equations are summed up in Spark, one hash aggregate with a partial step (a user with very many ratings costs no
single task its rows), and the small system of each user is solved on its own. The model is not trained again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_equations(ratings: DataFrame, item_factors: DataFrame, rank: int) -> DataFrame:
    """``userId, num_ratings, products, targets``: sums over a user's ratings of the products of each two item factors
    (i <= j, in order) and of each factor with the rating.

    Ratings that are null or of unknown items are left out; a user without any other has no row. Repeated records count
    each, as in training.
    """
    known = ratings.where(F.col("userId").isNotNull() & F.col("rating").isNotNull()).select("userId", F.col("movieId").alias("id"), F.col("rating").cast("double").alias("rating"))
    items = item_factors.where(F.col("features").isNotNull()).select("id", *[F.col("features")[k].cast("double").alias(f"f{k}") for k in range(rank)])
    pairs = [(i, j) for i in range(rank) for j in range(i, rank)]
    sums = known.join(items, "id").groupBy("userId").agg(
        F.count(F.lit(1)).alias("num_ratings"),
        *[F.sum(F.col(f"f{i}") * F.col(f"f{j}")).alias(f"p{i}_{j}") for i, j in pairs],
        *[F.sum(F.col(f"f{i}") * F.col("rating")).alias(f"t{i}") for i in range(rank)],
    )
    return sums.select("userId", "num_ratings", F.array(*[f"p{i}_{j}" for i, j in pairs]).alias("products"), F.array(*[f"t{i}" for i in range(rank)]).alias("targets"))


def _solved(reg_param: float, rank: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.triu_indices(rank)
        for batch in batches:
            m = batch.num_rows
            left = np.zeros((m, rank, rank))
            left[:, upper[0], upper[1]] = batch.column("products").flatten().to_numpy(zero_copy_only=False).reshape(m, len(upper[0]))
            left[:, upper[1], upper[0]] = left[:, upper[0], upper[1]]
            right = batch.column("targets").flatten().to_numpy(zero_copy_only=False).reshape(m, rank)
            left += (reg_param * batch.column("num_ratings").to_numpy())[:, None, None] * np.eye(rank)
            found = np.linalg.solve(left, right[:, :, None])[:, :, 0]
            yield pa.RecordBatch.from_arrays([batch.column("userId"), batch.column("num_ratings"), pa.array(found.tolist(), pa.list_(pa.float64()))], names=["userId", "num_ratings", "features"])

    return run


def fold_in(ratings: DataFrame, item_factors: DataFrame, rank: int, reg_param: float) -> DataFrame:
    """``userId, num_ratings, features``: the ridge solution of each user, with the penalty times the number of ratings as
    training has it. ``item_factors`` has ``id`` and ``features`` (``rank`` numbers); ``reg_param`` must be above 0, so
    that a user with a single rating has a solution too."""
    if reg_param <= 0:
        raise ValueError("reg_param must be above 0")
    equations = normal_equations(ratings, item_factors, rank)
    schema = T.StructType([equations.schema["userId"], T.StructField("num_ratings", T.LongType()), T.StructField("features", T.ArrayType(T.DoubleType()))])
    return equations.mapInArrow(_solved(reg_param, rank), schema)


def predict_with(user_factors: DataFrame, item_factors: DataFrame, records: DataFrame) -> DataFrame:
    """``userId, movieId, rating, prediction`` of the records whose user and item have factors."""
    users = user_factors.select("userId", F.col("features").alias("u"))
    items = item_factors.select(F.col("id").alias("movieId"), F.col("features").alias("v"))
    product = F.aggregate(F.zip_with("u", "v", lambda a, b: a * b.cast("double")), F.lit(0.0), lambda total, x: total + x)
    return records.join(users, "userId").join(items, "movieId").select("userId", "movieId", "rating", product.alias("prediction"))
