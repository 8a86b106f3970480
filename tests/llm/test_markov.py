"""The hidden Markov model against sums over all state paths, plain loops and plain word counts."""

import itertools
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from marquee.llm import hidden_markov as H
from marquee.llm.common import fold, table
from pyspark.sql import functions as F


def small_model(states=3, symbols=5, seed=0):
    rng = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return H.Model(norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((symbols, states)), 0))


def paths(model, text):
    """(chance, path) of every path of hidden states."""
    for path in itertools.product(range(len(model.first)), repeat=len(text)):
        p = model.first[path[0]] * model.emit[text[0], path[0]]
        for a, b, s in zip(path, path[1:], text[1:]):
            p *= model.step[a, b] * model.emit[s, b]
        yield p, path


TEXTS = [np.array(t) for t in ([1, 2, 0], [0], [4, 4, 3, 1, 2, 0], [2, 0], [3, 3, 3, 3, 0], [1, 0])]


def test_likelihood_is_the_sum_over_all_paths():
    model = small_model()
    want = [np.log10(sum(p for p, _ in paths(model, t))) for t in TEXTS]
    assert np.allclose(H.log_likelihoods(model, TEXTS), want, atol=1e-12)


def test_expected_counts_are_those_of_all_paths():
    model = small_model(seed=4)
    first, step, emit, loss = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for t in TEXTS:
        every = list(paths(model, t))
        total = sum(p for p, _ in every)
        loss += np.log(total)
        for p, path in every:
            first[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                step[a, b] += p / total
            for s, a in zip(t, path):
                emit[s, a] += p / total
    found = H.expected(model, TEXTS)
    for got, want in ((found.first, first), (found.step, step), (found.emit, emit), (found.loss, loss)):
        assert np.allclose(got, want, atol=1e-12)
    again = H.Sums.from_flat(found.flat(), 3)
    assert np.array_equal(again.step, found.step) and np.array_equal(again.emit, found.emit) and again.loss == found.loss


def test_steps_raise_the_likelihood_and_find_hidden_states(monkeypatch):
    monkeypatch.setattr(H, "PRIOR", 1e-9)
    monkeypatch.setattr(H, "PRIOR_STEP", 1e-9)
    rng = np.random.default_rng(0)
    texts = [np.append(rng.integers(1, 4, 30) + 3 * (k % 2), 0) for k in range(200)]  # two kinds of text that share no word
    plain = np.bincount(np.concatenate(texts), minlength=7) / sum(map(len, texts))
    model, losses = H.start(plain, 2), []
    for _ in range(30):
        sums = H.expected(model, texts)
        losses.append(sums.loss)
        model = H.improved(sums, plain)
    assert all(b >= a - 1e-6 for a, b in zip(losses, losses[1:]))
    # knowing the kind makes each word one of three instead of one of six
    assert H.log_likelihoods(model, texts).mean() > 30 * np.log10(1 / 3) - 2.5


def test_a_long_document_does_not_underflow():
    model = small_model(symbols=5)
    text = np.array([1, 2, 3, 4] * 50_000)
    got = H.log_likelihoods(model, [text])[0]
    now, want = model.first, 0.0
    for t, s in enumerate(text):
        now = (now if t == 0 else now @ model.step) * model.emit[s]
        want += np.log10(now.sum())
        now = now / now.sum()
    assert np.isfinite(got) and got == pytest.approx(want)


def words_of(text):
    return (text or "").encode().translate(H._LOWER).split()


def plain_counts(docs):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) by the formula, from (doc_id, text)."""
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter()
    for d, t in docs:
        if not out(d):
            counts.update([*words_of(t), None])
    n, v = sum(counts.values()), len(counts)
    rows = []
    for d, t in docs:
        tokens = [*words_of(t), None]
        rows.append((d, out(d), len(tokens), sum(counts[w] > 0 for w in tokens), n, sum(np.log10((counts[w] + 1) / (n + 1 * (v + 1))) for w in tokens)))
    return rows


def check_counts(rows, docs):
    key = lambda r: repr(r[:5])
    got, want = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows], key=key), sorted(plain_counts(docs), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def test_query_counts_and_held_out_gain(spark):
    rows = H.op12(spark, SMALL).collect()
    check_counts(rows, [(d.doc_id, d.text) for d in table(spark, SMALL, "documents", "doc_id", "text").collect()])
    held = [r for r in rows if r.held_out]
    assert all(r.score < 0 for r in rows)
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_chances_of_all_next_words_sum_to_one(spark, make_docs):
    """Over all texts of one word: known words and, for each shared symbol, an unknown one; and the empty text."""
    docs = make_docs([(k, " ".join(f"w{(k * j) % 40}" for j in range(1, 30))) for k in range(40)])
    m = H.LanguageModel(docs, F.lit(True))
    words, _, inside = m.alphabet
    share = {(r.word): (r.total, r.symbol) for r in words.collect()}
    model = m.model
    now = model.first[None, :] * model.emit  # (symbol, state) of the first token
    chance = now.sum(axis=1)
    known = sum(chance[s] * (1 if inside[s] == 0 else (n + 1) / inside[s]) for n, s in share.values() if n)
    unknown = sum(chance[s] / inside[s] for s in range(1 + H.FREQUENT, len(inside)))
    unused = chance[1 + len([1 for n, s in share.values() if s <= H.FREQUENT]) : 1 + H.FREQUENT].sum()
    assert known + unknown + unused + chance[H.END] == pytest.approx(1)


def test_chunks_and_blocks_of_any_size_give_the_same(spark, make_docs):
    docs = [(k, " ".join(f"w{(k * j) % (7 + k % 5)}" for j in range(k % 23))) for k in range(60)]
    frame = make_docs(docs).repartition(3)
    learn = fold("doc_id", H.FOLDS) != H.HELD_OUT
    scores = []
    for sizes in ({}, {"chunk_bytes": 50, "block_tokens": 64}, {"chunk_words": 5, "block_tokens": 1}):
        found = H.LanguageModel(frame, learn, **sizes)
        rows = found.scores().withColumn("train_tokens", F.lit(found.totals[0])).collect()
        check_counts(rows, docs)
        scores.append({r.doc_id: r.score for r in rows})
    for other in scores[1:]:
        assert all(other[d] == pytest.approx(s, rel=1e-6) for d, s in scores[0].items())


def test_odd_rows_empty_table_and_no_training_rows(spark, odd, no_docs):
    found = H.LanguageModel(odd, fold("doc_id", H.FOLDS) != H.HELD_OUT)
    rows = found.scores().withColumn("train_tokens", F.lit(found.totals[0])).collect()
    check_counts(rows, [(r.doc_id, r.text) for r in odd.collect()])
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows)
    assert H.LanguageModel(no_docs, F.lit(True)).scores().collect() == []
    unseen = H.LanguageModel(odd, F.lit(False))
    assert unseen.totals == (0, 0, 0)
    assert all(r.base_score == 0 and r.n_known == 0 and np.isfinite(r.score) for r in unseen.scores().collect())


def test_every_training_document_is_learnt_from_in_each_pass(spark, make_docs):
    """The model equals incremental EM in plain loops over all training documents, none of which is in two parts."""
    docs = make_docs([(k, " ".join(f"w{(k * j) % (7 + k % 5)}" for j in range(k % 23))) for k in range(90)]).repartition(3)
    m = H.LanguageModel(docs, fold("doc_id", H.FOLDS) != H.HELD_OUT, states=4)
    rows = m.encoded.collect()
    assert {r.doc_id for r in rows if r.part >= 0} == {k for k in range(90) if zlib.crc32(str(k).encode()) % 7 != 2}
    assert all((r.part >= 0) == r.learn for r in rows) and len({r.part for r in rows}) > 3
    count = m.alphabet[1]
    plain = (count + 1) / (count.sum() + len(count))
    want, sums = H.start(plain, 4), {}
    for turn in range(H.PASSES * H.PARTS):
        texts = [H._symbols(bytes(r.symbols)) for r in rows if r.part == turn % H.PARTS]
        if texts:
            sums[turn % H.PARTS] = H.expected(want, texts).flat()
            want = H.improved(H.Sums.from_flat(sum(sums.values()), 4), plain)
    for got, other in ((m.model.first, want.first), (m.model.step, want.step), (m.model.emit, want.emit)):
        assert np.allclose(got, other, rtol=1e-6)
    assert sum(H.Sums.from_flat(x, 4).first.sum() for x in sums.values()) == pytest.approx(m.totals[2])


def test_expected_counts_hold_one_table_of_tokens_by_states():
    model, tokens = small_model(states=12, symbols=50, seed=5), 1 << 18
    texts = list(np.random.default_rng(1).integers(0, 50, (1 << 12, tokens >> 12)))
    tracemalloc.start()
    try:
        H.expected(model, texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * tokens * 12 * 8


def test_documents_of_a_chunk_come_in_batches_of_bounded_size(monkeypatch):
    monkeypatch.setattr(H, "BATCH_WORDS", 50, raising=False)
    rng = np.random.default_rng(3)
    place = {f"w{k}".encode(): k for k in range(40)}
    rows = [(k, k % 3 > 0, rng.integers(0, 40, k % 30 if k != 17 else 90).astype(np.int32)) for k in range(60)]
    batches = list(H._chunk_batches(7, place, rows))
    documents, words = [b for b in batches if b.column("word").null_count], [b for b in batches if not b.column("word").null_count]
    sizes = [[len(raw) // 4 for raw in b.column("words").to_pylist()] for b in documents]
    assert all(sum(s) <= 50 or len(s) == 1 for s in sizes) and sum(map(len, sizes)) == len(rows)
    (listed,) = words
    names, counts = listed.column("word").to_pylist(), listed.column("c").to_pylist()
    read = [(d, x, [names[i] for i in H.from_planes(raw)]) for b in documents for d, x, raw in zip(*[b.column(c).to_pylist() for c in ("doc_id", "learn", "words")])]
    assert read == [(d, x, [f"w{i}" for i in places]) for d, x, places in rows]
    learnt = Counter(w for _, x, text in read if x for w in text)
    assert counts == sorted(counts, reverse=True) and all(learnt[w] == c for w, c in zip(names, counts))
