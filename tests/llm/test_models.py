"""Language identification and toxicity: held-out accuracy, the learners on small cases, odd rows."""

import random
import zlib
from dataclasses import replace

import numpy as np
from conftest import SMALL
from marquee.llm import language as L
from marquee.llm import toxicity as X
from marquee.llm.common import fold, table
from pyspark.sql import functions as F

MIDDLE = SMALL.replace("sf0.001", "sf0.01")


def test_fold_is_crc32_of_the_id(spark):
    rows = spark.range(-3, 50).select("id", fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_languages_of_held_out_documents(spark):
    rows = L.op2(spark, MIDDLE).join(table(spark, MIDDLE, "documents", "doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_nothing_is_learnt_from_held_out_rows(spark):
    docs = table(spark, SMALL, "documents", "doc_id", "text", "lang")
    held = fold("doc_id", 3) == 1
    a = L.train(docs, ~held)
    b = L.train(docs.withColumns({"lang": F.when(held, "xx").otherwise(F.col("lang")), "text": F.when(held, "zzz").otherwise(F.col("text"))}), ~held)
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights) and np.array_equal(a.idf, b.idf) and a.temperature == b.temperature


def test_language_of_odd_rows(spark, make_docs, odd, no_docs):
    model = L.train(make_docs([(k, t, g) for k, (t, g) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]), F.lit(True))
    assert model.languages == ["de", "en"]
    rows = {r.doc_id: r for r in L.predict(odd, model).collect()}
    assert all((rows[k].lang_pred, rows[k].score) == ("und", 0.0) for k in (1, 2, 3))
    assert L.predict(make_docs([(1, "12 %% 4"), (2, "the dog")]), model).orderBy("doc_id").collect()[0].lang_pred == "und"
    assert L.predict(no_docs, model).count() == 0
    nothing = L.train(no_docs, F.lit(True))
    assert {r.lang_pred for r in L.predict(odd, nothing).collect()} == {"und"}
    kept = L.keep_identified(odd, model)
    assert kept.columns == odd.columns and not {1, 2, 3} & {r.doc_id for r in kept.collect()}


def test_texts_in_no_learned_language_go(spark, make_docs):
    """Other languages, code and random letters have n-grams that no training row has; short clean texts stay."""
    docs = table(spark, MIDDLE, "documents", "doc_id", "text", "lang")
    model = L.train(docs, fold("doc_id", L.FOLDS) != L.HELD_OUT)
    rng = random.Random(0)
    bad = [
        "все люди рождаются свободными и равными в своем достоинстве и правах",
        "人人生而自由在尊严和权利上一律平等",
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem",
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(600)),
        "qzx" * 400,
        "1234 5678 %%%",
    ]
    kept = L.keep_identified(make_docs(list(enumerate(bad))), model)
    assert kept.count() == 0
    clean = docs.where((fold("doc_id", L.FOLDS) == L.HELD_OUT) & F.col("lang").isNotNull())
    found = L.keep_identified(clean, model)
    assert found.count() >= 0.995 * clean.count()
    only = L.keep_identified(clean, model, languages=["en"]).groupBy("lang").count().collect()
    assert {r["lang"] for r in only if r["count"] > 5} == {"en"}


def plain_learner(rows, labels, n):
    """Follow the regularised leader, weight by weight, with the sums kept in dicts."""
    z, q = {}, {}

    def weight(i, c):
        zs = z.get((i, c), 0.0)
        return 0.0 if abs(zs) <= L.L1 else -(zs - np.sign(zs) * L.L1) / ((L.BETA + q.get((i, c), 0.0) ** 0.5) / L.ALPHA + L.L2)

    for turn in range(L.PASSES):
        for k in np.random.default_rng(turn).permutation(len(rows)):
            at, x = rows[k]
            w = {(i, c): weight(i, c) for i in at for c in range(n)}
            score = [sum(float(v) * w[i, c] for i, v in zip(at, x)) for c in range(n)]
            top = max(score)
            total = sum(np.exp(s - top) for s in score)
            for c in range(n):
                error = np.exp(score[c] - top) / total - (labels[k] == c)
                for i, v in zip(at, x):
                    g, before = float(v) * error, q.get((i, c), 0.0)
                    q[i, c] = before + g * g
                    z[i, c] = z.get((i, c), 0.0) + g - (q[i, c] ** 0.5 - before**0.5) / L.ALPHA * w[i, c]
    return {(i, c): weight(i, c) for i, c in z}


def test_weights_against_a_plain_learner():
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4).astype(np.float32)) for _ in range(60)]
    labels = [int(at[0] % 3) for at, _ in rows]
    got, want = L.learn_weights(rows, labels, 3), plain_learner(rows, labels, 3)
    assert all(abs(got[i, c] - w) < 1e-5 for (i, c), w in want.items())
    assert np.count_nonzero(got) == sum(w != 0 for w in want.values()) > 0


def test_temperature_finds_the_least_loss():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 4000)
    logits = rng.normal(0, 1, (4000, 3))
    y = np.array([rng.choice(3, p=L._softmax(x)) for x in logits])
    assert abs(L.fit_temperature(5 * logits, y) - 5) < 0.6
    assert L.fit_temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_penalties_leave_weights_out():
    rows = [(np.array([k % 2, 5]), np.array([0.9, 0.1], np.float32)) for k in range(40)]
    w = L.learn_weights(rows, [k % 2 for k in range(40)], 2)
    assert w[0, 0] > 0 > w[0, 1] and np.count_nonzero(w.any(axis=1)) <= 3


def test_toxic_held_out_documents(spark):
    rows = X.op4(spark, MIDDLE).join(table(spark, MIDDLE, "labels", "doc_id", "toxic"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == 1 and r.toxic == 0 for r in held) <= 0.02 * len(held)
    assert sum(r.predicted == r.toxic for r in held) >= 0.93 * len(held)


def test_pairs_of_terms_that_single_weights_miss():
    """Label 1 exactly if an insult and a mention come together or neither does: no sum of weights tells."""
    rng = random.Random(1)
    sets, y = [], []
    for _ in range(600):
        insult, mention = rng.random() < 0.5, rng.random() < 0.5
        found = {X.slot(w) for w, use in ((b"insult", insult), (b"mention", mention), (b"always", True)) if use} | {X.slot(f"w{rng.randint(0, 9)}".encode())}
        sets.append(np.array(sorted(found), "<u4"))
        y.append(float(insult and mention))
    model = X.fit(sets, np.array(y))
    score = lambda *ws: model.score([model.term[X.slot(w)] for w in ws if X.slot(w) in model.term])
    assert score(b"insult", b"mention") > 0.5 > max(score(b"insult"), score(b"mention"), score())
    # the factors do it: without them the pair is not told
    model = replace(model, factors=0 * model.factors)
    assert score(b"insult", b"mention") < 0.5


def test_score_is_the_sum_over_terms_and_pairs():
    rng = np.random.default_rng(2)
    model = X.Model({}, 0.3, rng.normal(size=7), rng.normal(size=(7, X.FACTORS)))
    for rows in ([], [2], [0, 3, 4], list(range(7))):
        z = 0.3 + sum(model.weights[a] for a in rows) + sum(model.factors[a] @ model.factors[b] for a in rows for b in rows if a < b)
        assert abs(model.score(rows) - 1 / (1 + np.exp(-z))) < 1e-12


def test_gradients_against_differences():
    rng = np.random.default_rng(3)
    x, y = (rng.random((40, 6)) < 0.5).astype(float), (rng.random(40) < 0.4).astype(float)
    bias, w, v = 0.2, rng.normal(size=6), rng.normal(size=(6, X.FACTORS))

    def loss(bias, w, v):
        z = np.array([bias + r @ w + sum(r[a] * r[b] * (v[a] @ v[b]) for a in range(6) for b in range(a)) for r in x])
        return np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y)) + (X.L2_WEIGHT * (w @ w) + X.L2_FACTOR * (v * v).sum()) / 12

    g0, gw, gv = X.gradients(x, y, bias, w, v)
    e = 1e-6
    assert abs((loss(bias + e, w, v) - loss(bias - e, w, v)) / (2 * e) - g0) < 1e-7
    for k in range(6):
        d = e * np.eye(6)[k]
        assert abs((loss(bias, w + d, v) - loss(bias, w - d, v)) / (2 * e) - gw[k]) < 1e-7
        d = d[:, None] * np.eye(X.FACTORS)[0]
        assert abs((loss(bias, w, v + d) - loss(bias, w, v - d)) / (2 * e) - gv[k, 0]) < 1e-7


def test_pairs_of_terms_that_say_nothing_alone():
    """4,000 + 8,000 rows of which a third of those with either term are toxic, as of all rows, and all with both are."""
    rng = np.random.default_rng(3)
    insult, mention, filler = X.slot(b"insult"), X.slot(b"mention"), [X.slot(f"w{k}".encode()) for k in range(300)]
    sets, y = [], []
    for k in range(12000):
        toxic = k < 4000
        # 16 rows with both, all toxic; alone 64 toxic and 144 harmless rows with each, so 80 of 224
        at = k if toxic else k - 4000
        found = [insult] * (at < (80 if toxic else 144)) + [mention] * (64 <= at < 144 if toxic else 144 <= at < 288)
        sets.append(np.unique(np.array([*found, *rng.choice(filler, 12, replace=False)], "<u4")))
        y.append(float(toxic))
    y = np.array(y)
    model = X.fit(sets, y)
    assert {insult, mention} <= model.term.keys() and len(model.term) < 10  # chance terms stay out
    score = lambda *slots: model.score([model.term[s] for s in slots if s in model.term])
    assert score(insult, mention) > 0.5 > max(score(insult), score(mention), score())
    assert np.abs(model.factors).max() > 0.1
    model = replace(model, factors=0 * model.factors)
    assert score(insult, mention) < 0.5


def test_toxicity_of_odd_rows(spark, make_docs, odd, no_docs):
    docs = make_docs([(k, ("you idiot " if k % 3 == 0 else "fine ") + f"word{k} and more text number {k}") for k in range(60)])
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)] + [(None, 1), (7, None), (900, 1)], "doc_id long, toxic int")
    model = X.train(docs, labels, F.lit(True))
    found = {r.doc_id: r.predicted for r in X.predict(docs, model).collect()}
    assert found == {k: int(k % 3 == 0) for k in range(60)}
    rows = X.predict(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert X.predict(no_docs, model).count() == 0
    none = X.train(no_docs, labels, F.lit(True))
    assert all(0 <= r.score <= 1 for r in X.predict(odd, none).collect())
    kept = X.keep_harmless(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k in range(60) if k % 3}
