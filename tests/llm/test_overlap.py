"""Benchmark decontamination against brute force."""

import hashlib
import random
import re

from conftest import SMALL
from marquee.llm import decontaminate as D
from marquee.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, found, longest = words(text), set(), set(), 0
        for item_id, item in items:
            t = words(item)
            n = min(window, len(t))
            for i in range(len(t) - n + 1) if n else ():
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == t[i : i + n]:
                        hit.update(range(j, j + n))
                        if item_id is not None:
                            found.add(str(item_id))
                        k = n
                        while i + k < len(t) and j + k < len(w) and w[j + k] == t[i + k]:
                            k += 1
                        longest = max(longest, k)
        out.append((doc_id, len(w), len(hit), sorted(found), longest))
    return out


def found_rows(df):
    return [(r.doc_id, r.n_words, sum(r.hit_spans[1::2]) - sum(r.hit_spans[::2]), list(r["items"]), r.longest_match) for r in df.collect()]


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(6)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.choice([0, 3, 5, 12, 25]))) for k in range(6)] + [(6, None), (7, ""), (None, say(11)), (8, "Tiny")]
    items += [(9, items[4][1])]
    docs = [(k, say(rng.randint(0, 60))) for k in range(12)]
    for k in range(12, 18):
        t = rng.choice(items[:6])[1].split()
        cut = rng.randint(0, max(0, len(t) - 10))
        docs.append((k, say(5).upper() + ", " + "-".join(t[cut:]) + " zzz, tiny! " + say(4)))
    return docs + [(18, None), (19, ""), (20, "..."), (20, "..."), (None, items[3][1])], items


def test_all_occurrences_and_longest_matches(spark, make_docs):
    for seed in range(4):
        docs, items = case(seed)
        bench = spark.createDataFrame(items, "item_id long, text string")
        want = sorted(brute(docs, items), key=repr)
        for size in (D.BENCHMARK_BLOCK, 60):  # one pass, and several passes over parts of the benchmark
            found = sorted(found_rows(D.find_overlap(make_docs(docs), bench, block_bytes=size)), key=repr)
            if size == D.BENCHMARK_BLOCK:
                assert found == want
            else:
                assert [f[:4] for f in found] == [w[:4] for w in want]
        clean = D.decontaminate(make_docs(docs), bench, block_bytes=60)
        assert clean.columns == make_docs(docs).columns
        assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == sorted(((d[0], d[1]) for d, w in zip(docs, brute(docs, items)) if not w[2]), key=repr)


def test_query_on_the_small_table(spark):
    docs = [tuple(r) for r in table(spark, SMALL, "documents", "doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SMALL, "benchmark", "item_id", "text").collect()]
    # windows by dictionary: the plain form is too slow here
    at = {}
    for item_id, text in items:
        t = words(text)
        n = min(10, len(t))
        for i in range(len(t) - n + 1) if n else ():
            at.setdefault(tuple(t[i : i + n]), set()).add(str(item_id))
    want = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in at}:
            for j in range(len(w) - n + 1):
                if ids := at.get(tuple(w[j : j + n])):
                    hit.update(range(j, j + n))
                    found |= ids
        want[doc_id] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    rows = D.op5(spark, SMALL).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == want
    assert any(r.contaminated for r in rows)


def test_empty_tables(spark, no_docs, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_overlap(no_docs, none).count() == 0
    assert all(not r.hit_spans for r in D.find_overlap(odd, none).collect())
    assert D.decontaminate(odd, none).count() == odd.count()
