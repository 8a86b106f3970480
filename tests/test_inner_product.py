"""Top-n for all users against brute force, and factors of
new users against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import fold_in, inner_product, recommend


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids if ids is not None else range(len(vectors)), vectors)], "id int, features array<float>")


def brute(users, items, n):
    users, items = np.asarray(users, np.float32).astype(float), np.asarray(items, np.float32).astype(float)
    out = []
    for u, x in enumerate(users):
        score = np.zeros(len(items))
        for f in range(len(x)):
            score += x[f] * items[:, f]
        order = np.lexsort((np.arange(len(items)), -score))[:n]
        out += [(u, k + 1, int(i), float(score[i])) for k, i in enumerate(order)]
    return out


@pytest.mark.parametrize("case", ["spread", "even", "ties", "zeros", "negative"])
def test_all_users_equal_brute_force(spark, case):
    rng = np.random.default_rng(1)
    users, items = rng.normal(size=(300, 6)), rng.normal(size=(900, 6))
    if case == "spread":
        items *= np.exp(rng.normal(0, 1.5, (900, 1)))
    if case == "even":
        items /= np.linalg.norm(items, axis=1, keepdims=True)
    if case == "ties":
        users, items = rng.integers(-1, 2, (300, 6)), rng.integers(-2, 3, (900, 6))
    if case == "zeros":
        users, items = 0 * users, 0 * items
    if case == "negative":
        items = -np.abs(items)
        users = np.abs(users)
    found = inner_product.search(frame(spark, users), frame(spark, items).repartition(5), 7, first_block=16, max_block=256).cache()
    assert sorted(map(tuple, inner_product.ranked(found).collect())) == brute(users, items, 7)
    scored = found.agg(F.sum("num_scored")).first()[0]
    assert scored <= 300 * 900
    if case == "spread":
        assert scored < 0.75 * 300 * 900
    found.unpersist()


def test_users_are_written_once_for_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(40, 4)), rng.normal(size=(300, 4))
    items /= np.linalg.norm(items, axis=1, keepdims=True)  # even norms: every user meets every block
    names, old = [], inner_product._written
    monkeypatch.setattr(inner_product, "_written", lambda df, name: names.append(name) or old(df, name))
    found = inner_product.search(frame(spark, users), frame(spark, items), 5, first_block=4, max_block=16)
    assert sorted(map(tuple, inner_product.ranked(found).collect())) == brute(users, items, 5)
    assert names.count("inner-products") <= 4  # 4 items, then 16 blocks a round; 20 rounds with one block each


def test_few_items_no_rows_and_missing_values(spark):
    items = frame(spark, [[1, 0], [0, 2]], [5, 3])
    none = spark.createDataFrame([(None, [1.0, 1.0]), (4, None)], "id int, features array<float>")
    found = inner_product.search(frame(spark, [[1, 1]], [9]).union(none), items.union(none), 10)
    assert [tuple(r) for r in inner_product.ranked(found).orderBy("rank").collect()] == [(9, 1, 3, 2.0), (9, 2, 5, 1.0)]
    assert inner_product.search(frame(spark, [[1, 1]]), items.limit(0), 3).first().items == []
    assert inner_product.search(items.limit(0), items, 3).count() == 0


def test_the_model_s_own_lists(small):
    model, _ = recommend.train_als(small.ratings, max_iter=3)
    got = recommend.recommend_for_all_users(model, small.movies, n=5)
    by_library = {r.userId: [x.rating for x in r.recommendations] for r in model.recommendForAllUsers(5).collect()}
    mine = {}
    for r in got.orderBy("userId", "rank").collect():
        mine.setdefault(r.userId, []).append(r.score)
        assert r.title is not None
    assert mine.keys() == by_library.keys()
    assert all(np.allclose(mine[u], by_library[u], atol=1e-5) for u in mine)


def test_fold_in_equals_the_ridge_solution(spark):
    rng = np.random.default_rng(0)
    items = rng.normal(size=(30, 4)).astype(np.float32)
    rows = [(u, int(m), float(rng.integers(1, 11)) / 2) for u in range(12) for m in rng.choice(30, 5 + u % 4)] + [(50, 3, 4.0), (51, 2, None), (52, 999, 3.0), (None, 1, 2.0), (53, 1, 3.0), (53, 1, 3.0)]
    found = fold_in.fold_in(spark.createDataFrame(rows, "userId int, movieId int, rating float"), frame(spark, items), 4, 0.2)
    got = {r.userId: (r.num_ratings, r.features) for r in found.collect()}
    want = {}
    for u in {r[0] for r in rows if r[0] is not None and r[2] is not None and r[1] < 30}:
        x = np.array([items[m] for w, m, r in rows if w == u and r is not None and m < 30], float)
        y = np.array([r for w, m, r in rows if w == u and r is not None and m < 30])
        want[u] = (len(y), np.linalg.solve(x.T @ x + 0.2 * len(y) * np.eye(4), x.T @ y))
    assert got.keys() == want.keys() and not {51, 52, None} & got.keys()
    assert all(got[u][0] == want[u][0] and np.allclose(got[u][1], want[u][1], atol=1e-9) for u in want)
    with pytest.raises(ValueError):
        fold_in.fold_in(found, frame(spark, items), 4, 0.0)


def test_fold_in_gives_trained_users_their_own_factors(small):
    """Training ends with this very step for the users it knows."""
    model, _ = recommend.train_als(small.ratings, max_iter=2)
    train, _ = recommend.train_and_test(small.ratings)
    mine = {r.userId: r.features for r in fold_in.fold_in(train, model.itemFactors, model.rank, recommend.REG_PARAM).collect()}
    trained = {r.id: r.features for r in model.userFactors.collect()}
    assert mine.keys() == trained.keys()
    assert all(np.allclose(mine[u], trained[u], atol=1e-3) for u in trained)


def test_new_users_get_predictions(small):
    old, known, asked = recommend.split_new_users(small.ratings)
    assert not {r.userId for r in old.select("userId").distinct().collect()} & {r.userId for r in asked.select("userId").distinct().collect()}
    assert old.count() + known.count() + asked.count() == small.ratings.where("rating is not null").count()
    model, _ = recommend.train_als(old, max_iter=3, train_percent=100)
    assert recommend.predictions(model, asked).count() == 0  # the model alone drops them all
    found = recommend.predict_new_users(model, known, asked)
    n = found.count()
    assert 0 < n <= asked.count() and found.where("prediction is null or isnan(prediction)").count() == 0
