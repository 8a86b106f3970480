"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
from conftest import SMALL
from marquee.llm import periodic_runs as R
from marquee.llm.common import table


def brute(words):
    """Every maximal stretch of every period, least period only."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def random_words(rng):
    """Texts with runs of all kinds: nested, touching, with errors, of few letters."""
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randint(0, 200))]
    if kind == 1:
        return ["a"] * rng.randint(0, 90) + ["b"] * rng.randint(0, 60)
    out = [rng.choice("abcdef") for _ in range(rng.randint(0, 30))]
    for _ in range(rng.randint(1, 4)):
        part = [rng.choice("ab" if kind == 2 else "abcdefghij") for _ in range(rng.randint(1, 60))]
        if kind == 3:
            part = (part[:3] * 10)[: rng.randint(20, 40)] + part
        out += part * rng.randint(1, 6) + part[: rng.randrange(len(part))]
        if rng.random() < 0.3 and out:
            out[rng.randrange(len(out))] = "z"
    return out


def test_runs_equal_the_search_over_all_periods():
    rng = random.Random(5)
    for _ in range(60):
        texts = [random_words(rng) for _ in range(12)]
        flat, number = [], {}
        for k, words in enumerate(texts):
            flat += [number.setdefault(w, len(number)) for w in words] + [10**6 + k]
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes + 1) - sizes - 1
        want = sorted((int(starts[k]) + s, n, q) for k, t in enumerate(texts) for s, n, q in brute(t))
        assert [tuple(r) for r in R.runs_of(np.array(flat), sizes).tolist()] == want


def test_structured_words_with_long_periods():
    """Words in which tuples repeat inside one period (Thue-Morse, Fibonacci) and periods of many scales."""
    morse = [bin(k).count("1") & 1 for k in range(700)]
    fib = [0, 1]
    a, b = [0], [0, 1]
    while len(b) < 700:
        a, b = b, b + a
    fib = b[:700]
    for words in (morse, fib, morse[:333] * 4, fib[:217] * 3 + [9] + fib[:150] * 4, list(range(500)) * 3, (list(range(40)) * 4 + [99]) * 3):
        got = R.runs_of(np.array([*words, 10**6]), np.array([len(words)]))
        assert [tuple(r) for r in got.tolist()] == brute(words)


def test_a_long_run_takes_time_in_proportion():
    words = np.append(np.tile(np.arange(1000), 400), 10**6)
    assert R.runs_of(words, np.array([400_000])).tolist() == [[0, 400_000, 1000]]


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-1000 * r[1] / r[2], r[0], r[2]), default=None)
    digest = lambda x: hashlib.sha256(x).hexdigest()
    tail = (digest("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), digest(b" ".join(collapsed(words, runs))))
    return (doc_id, len(runs), *(best or (None,) * 3), *tail, 1000 * best[1] // best[2] if best else None)


def test_query_against_brute_force(spark):
    got = sorted(map(tuple, R.op13(spark, SMALL).collect()))
    docs = table(spark, SMALL, "documents", "doc_id", "text").collect()
    assert got == sorted(expected(d.doc_id, d.text) for d in docs)
    assert sum(r[1] for r in got) > 5


def test_odd_rows_and_clashing_columns(odd, no_docs, make_docs):
    got = {(r.doc_id, r.n_words): r for r in R.periodic_runs(odd).collect()}
    assert len(R.periodic_runs(odd).collect()) == odd.count()
    long = next(r for k, r in got.items() if k[0] == 8)
    assert [tuple(r) for r in long.runs] == [(0, 5000, 1)] and long.collapsed == "long " + "x" * 20000 and long.top == 0
    assert got[1, 0].runs == [] and got[1, 0].top is None and got[1, 0].collapsed == "" == got[3, 0].collapsed
    assert R.periodic_runs(no_docs).collect() == []
    tie = make_docs([(1, " ".join(["a"] * 24 + ["b"] * 24 + ["a", "b"] * 12))])
    row = R.periodic_runs(tie).first()
    assert [tuple(r) for r in row.runs][row.top] == (0, 24, 1)
