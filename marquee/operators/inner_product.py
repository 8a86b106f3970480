"""Exact top-n search by inner product, for all users at once.

Items are laid out by falling norm and met in blocks. By the Cauchy-Schwarz inequality no item from a place on can
score more for a user than the user's norm times the norm there; once that is below the user's n-th best score, the user
is done. So most pairs are never scored, and the result is the same as if all were.

A block has at most ``max_block`` items and a round at most ``BLOCKS`` blocks, so what is sent to the tasks is bounded
whatever the number of items; users never leave their partitions (no shuffle of users, no pairs
of users and items as rows). Each round is written to the shared folder and later rounds read the users that are still open.
The work is that of the pairs within the bound, in the worst case of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import scratch_dir

#: Items of the first block (it grows by GROWTH until MAX_BLOCK), items scored at once inside a task, users likewise.
FIRST_BLOCK, GROWTH, MAX_BLOCK, STRIP, USERS_AT_ONCE = 1024, 4, 65536, 512, 2048
#: Blocks of the full size that one round meets, so that users are written once for all of them.
BLOCKS = 16
#: Room for rounding in the bound, and in a product of matrices against the sums in a fixed order.
SLACK, NEAR = 1e-9, 1e-12

STATE = T.StructType([
    T.StructField("user", T.LongType()),
    T.StructField("features", T.ArrayType(T.DoubleType())),
    T.StructField("norm", T.DoubleType()),
    T.StructField("items", T.ArrayType(T.LongType())),
    T.StructField("scores", T.ArrayType(T.DoubleType())),
    T.StructField("num_scored", T.LongType()),
])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _norm():
    return F.sqrt(F.aggregate("features", F.lit(0.0), lambda total, x: total + x * x))


def _met(blocks: list, n: int):
    """Users after some blocks: their best items so far and how many they were scored against. Self-contained, so that
    executors need no copy of this module."""

    strip, users_at_once, slack, near = STRIP, USERS_AT_ONCE, SLACK, NEAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nobody = np.iinfo(np.int64).max
        for whole in batches:
            for at in range(0, whole.num_rows, users_at_once):
                batch = whole.slice(at, users_at_once)
                m = batch.num_rows
                users = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(m, -1)
                norm, scored = batch.column("norm").to_numpy(), batch.column("num_scored").to_numpy().copy()
                ids, best = np.full((m, n), nobody), np.full((m, n), -np.inf)
                for k, (i, s) in enumerate(zip(batch.column("items").to_pylist(), batch.column("scores").to_pylist())):
                    ids[k, : len(i)], best[k, : len(s)] = i, s
                for block in blocks:
                    item_ids, vectors, norms = block.value
                    for start in range(0, len(item_ids), strip):
                        # an item that could tie the n-th best may have a smaller id, so equality goes on
                        most = norm * norms[start]
                        rows = np.flatnonzero(most * (1 + slack) >= best[:, -1])
                        if not len(rows):
                            break
                        part, own = item_ids[start : start + strip], vectors[start : start + strip]
                        scored[rows] += len(part)
                        # a product of matrices, right up to rounding, leaves the users that may have a better item
                        rough = (users[rows] @ own.T).max(axis=1)
                        rows = rows[~(rough < best[rows, -1] - near * most[rows])]
                        # sums in a fixed order, so that a score does not depend on the block that it is worked out in
                        score = np.zeros((len(rows), len(part)))
                        for f in range(users.shape[1]):
                            score += users[rows, f][:, None] * own[:, f][None, :]
                        better = (score >= best[rows, -1][:, None]).any(axis=1)
                        rows, score = rows[better], score[better]
                        score = np.concatenate([best[rows], score], axis=1)
                        both = np.concatenate([ids[rows], np.broadcast_to(part, (len(rows), len(part)))], axis=1)
                        order = np.lexsort((both, -score), axis=-1)[:, :n]
                        best[rows], ids[rows] = np.take_along_axis(score, order, 1), np.take_along_axis(both, order, 1)
                found = [i[i != nobody].tolist() for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("user"),
                        batch.column("features"),
                        batch.column("norm"),
                        pa.array(found, pa.list_(pa.int64())),
                        pa.array([s[: len(i)].tolist() for i, s in zip(found, best)], pa.list_(pa.float64())),
                        pa.array(scored, pa.int64()),
                    ],
                    names=["user", "features", "norm", "items", "scores", "num_scored"],
                )

    return run


def search(users: DataFrame, items: DataFrame, n: int, user_col: str = "id", item_col: str = "id", first_block: int = FIRST_BLOCK, max_block: int = MAX_BLOCK) -> DataFrame:
    """One row per user: user, features, norm, items and scores (the ``n`` items of the highest inner product, best first,
    ties by item id; all of them if there are fewer), num_scored (items that the user was scored against).

    ``users`` and ``items`` have an id and ``features`` (arrays of one length). Rows without id or features are left out.
    Repeated user rows are searched one by one; an item that repeats takes several places.
    """
    spark = users.sparkSession
    vector = F.transform("features", lambda x: x.cast("double"))
    known = lambda df, c: df.where(F.col(c).isNotNull() & F.col("features").isNotNull())
    none = lambda kind: F.array().cast(f"array<{kind}>")
    left = known(users, user_col).select(F.col(user_col).cast("long").alias("user"), vector.alias("features"))
    left = left.select("user", "features", _norm().alias("norm"), none("bigint").alias("items"), none("double").alias("scores"), F.lit(0).cast("long").alias("num_scored"))
    right = known(items, item_col).select(F.col(item_col).cast("long").alias("item"), vector.alias("features"))
    ordered = right.withColumn("norm", _norm()).orderBy(F.col("norm").desc(), "item")
    # places rise with the order; the number of items in each partition of the sort makes them ranks
    ordered = _written(ordered.withColumn("place", F.monotonically_increasing_id()), "items-by-norm")
    sizes = ordered.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count(F.lit(1)).alias("c")).orderBy("part").collect()
    ends = np.cumsum([r["c"] for r in sizes])
    total = int(ends[-1]) if len(ends) else 0

    def place_of(rank: int) -> int:
        k = int(np.searchsorted(ends, rank, side="right"))
        return (sizes[k]["part"] << 33) + rank - int(ends[k] - sizes[k]["c"])

    rank, size, done = 0, first_block, []
    while rank < total:
        blocks, stop = [], min(total, rank + (size if size < max_block else BLOCKS * size))
        while rank < stop:
            end = min(total, rank + size)
            # with the first item of the next block, whose norm bounds all that follows
            rows = ordered.where(F.col("place").between(place_of(rank), place_of(min(end, total - 1)))).orderBy("place").toArrow()
            norms = rows.column("norm").to_numpy()
            vectors = np.array(rows.column("features").to_pylist())
            n_own = end - rank
            blocks.append(spark.sparkContext.broadcast((rows.column("item").to_numpy()[:n_own], vectors[:n_own], norms[:n_own])))
            rank = end
        left = _written(left.mapInArrow(_met(blocks, n), STATE), "inner-products")
        for block in blocks:
            block.unpersist()
        if rank == total:
            break
        bound = F.col("norm") * F.lit(float(norms[n_own]) * (1 + SLACK))
        ready = (F.size("items") == n) & (F.get("scores", F.lit(n - 1)) > bound)
        done.append(left.where(ready))
        left = left.where(~ready)
        if left.isEmpty():
            break
        size = min(size * GROWTH, max_block)
    for part in done:
        left = left.unionByName(part)
    return left


def ranked(found: DataFrame) -> DataFrame:
    """``user, rank, item, score``: the items of ``search``, one row each."""
    rows = found.select("user", F.posexplode(F.arrays_zip("items", "scores")).alias("pos", "hit"))
    return rows.select("user", (F.col("pos") + 1).alias("rank"), F.col("hit.items").alias("item"), F.col("hit.scores").alias("score"))
