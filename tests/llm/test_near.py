"""N-gram join and fingerprints against brute force."""

import random
import re

import pytest
from conftest import SMALL
from marquee.llm import ngram_join as J
from marquee.llm import order_minhash as O
from marquee.llm.common import table


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    group = list(range(len(docs)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    out = []
    for k, (doc_id, _) in enumerate(docs):
        ids = [docs[m][0] for m in range(len(docs)) if root(m) == root(k) and docs[m][0] is not None]
        out.append((doc_id, len(sets[k]), min(ids) if sets[k] and ids else doc_id))
    return sorted(out, key=repr)


def family(rng, n, words=60, changes=3):
    base = [f"v{rng.randint(0, 400)}" for _ in range(words)]
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randint(0, changes)):
            t[rng.randrange(len(t))] = f"x{rng.randint(0, 9)}"
        if rng.random() < 0.4:
            t = t[: rng.randint(words // 2, words)]
        if rng.random() < 0.3:
            t += [f"y{rng.randint(0, 3)}" for _ in range(rng.randint(1, 14))]
        yield " ".join(t).upper() if rng.random() < 0.2 else " ".join(t)


def collection(seed):
    rng = random.Random(seed)
    texts = [t for _ in range(6) for t in family(rng, rng.randint(2, 14))]
    passage = " ".join(f"p{k}" for k in range(30))
    texts += [f"{passage} " + " ".join(f"q{rng.randint(0, 99)}" for _ in range(rng.randint(5, 14))) for _ in range(15)]
    texts += [" ".join(f"z{k}" for k in range(s, s + 40)) for s in range(0, 40, 4)]  # a chain
    texts += texts[:5] + ["one", "one", "one two", "", None, "  "]
    rng.shuffle(texts)
    ids = rng.sample(range(-50, 5000), len(texts) - 1)
    return [*zip(ids, texts), (None, texts[0])]


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(make_docs, seed):
    docs = collection(seed)
    found = sorted((tuple(r) for r in J.near_duplicates(make_docs(docs)).collect()), key=repr)
    assert found == brute(docs)


def test_salted_groups_and_all_pairs_rounds(make_docs, monkeypatch):
    docs = collection(11)
    monkeypatch.setattr(J, "SALT_ROWS", 3)
    monkeypatch.setattr(J, "PAIRS_PER_ENTRY", 0)
    monkeypatch.setattr(J, "CENTRE_ROUNDS", 2)
    found = sorted((tuple(r) for r in J.near_duplicates(make_docs(docs)).collect()), key=repr)
    assert found == brute(docs)


def test_query_on_the_small_table(spark):
    docs = [tuple(r) for r in table(spark, SMALL, "documents", "doc_id", "text").collect()]
    found = sorted((tuple(r) for r in J.op9(spark, SMALL).collect()), key=repr)
    assert found == brute(docs)


def test_one_of_each_group_stays(make_docs):
    docs = collection(5)
    docs.append(docs[0])
    kept = J.keep_one(make_docs(docs))
    assert kept.columns == make_docs(docs).columns
    ids = {}
    for doc_id, n, component in brute(docs):
        ids.setdefault(component if n and doc_id is not None else ("alone", doc_id), []).append(doc_id)
    named = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    alone = [d for d in docs if d[0] is not None and not shingles(d[1])]
    groups = {c for d, n, c in brute(docs) if n and d is not None}
    assert sorted(named) == sorted([*groups, *[d[0] for d in alone]])


def test_one_of_each_group_where_ids_repeat(spark):
    """Ids name several texts; a unique text is never lost, rows without an id or without words all stay, and columns may
    have any name."""
    a, b = "one two three four five six seven eight", "quite another text of some more words than that"
    names = "doc_id long, text string, _id string, _mark int, _rank int, _alone int, _gone int, component int, key int, n int"
    rows = [(1, a), (5, a), (5, b), (5, b), (6, b.upper()), (7, None), (7, None), (None, a), (None, a), (8, " "), (8, " "), (9, "solo"), (9, "solo"), (9, "other")]
    docs = spark.createDataFrame([(*r, "x", *[k] * 7) for k, r in enumerate(rows)], names)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(1, a), (5, b), (7, None), (7, None), (None, a), (None, a), (8, " "), (8, " "), (9, "solo"), (9, "other")], key=repr)


def test_odd_and_empty(odd, no_docs):
    found = {r.doc_id: r for r in J.near_duplicates(odd).collect()}
    assert [found[k].n_shingles for k in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert all(found[k].component_id == k for k in (1, 2, 3, 4, 5))
    assert J.near_duplicates(no_docs).count() == 0
    assert J.keep_one(no_docs).count() == 0


# fingerprints -------------------------------------------------------------------------------------------


def plain_smallest(hashes):
    """Tuples by full sort, without strips or shared heads."""
    import numpy as np

    out = []
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for m in O._MULTIPLIERS:
        v = short * m
        out.append(sorted(sorted(range(len(v)), key=lambda k: (v[k], k))[: O.TUPLE]))
    return out


def test_signatures_equal_the_plain_form(monkeypatch):
    import numpy as np

    monkeypatch.setattr(O, "STRIP", 50)
    rng = random.Random(4)
    for n in (0, 1, 11, 12, 13, 40, 400):
        text = "".join(rng.choice("ab c") for _ in range(n))
        hashes = O.kmers(text)
        assert len(np.unique(hashes)) == len(hashes)  # occurrence numbers keep repeats apart
        picked = [sorted(row) for row in O.smallest(hashes)[1].tolist()]
        assert picked == plain_smallest(hashes)
        edited, same = O.edited_with_next(text, "xyz" * 50)
        own, changed = O.fingerprints(text, edited, same)
        assert O.as_text(own) == O.as_text(O.fingerprint(text)) and O.as_text(changed) == O.as_text(O.fingerprint(edited))


def test_first_occurrences_are_the_same_element_with_and_without_repeats():
    import numpy as np

    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(200))
    once, twice = O.kmers(text), O.kmers(text + text)
    assert np.array_equal(once, twice[: len(once)]) and len(np.unique(twice)) == len(twice)
    # k-mers of the head come again in the replaced quarter of the text only, or of the edited one only
    for whole, following in ((text + text[:66], "z" * 100), (text + "z" * 66, text)):
        edited, same = O.edited_with_next(whole, following)
        own, changed = O.fingerprints(whole, edited, same)
        assert O.as_text(own) == O.as_text(O.fingerprint(whole)) and O.as_text(changed) == O.as_text(O.fingerprint(edited))
        assert np.array_equal(O.kmers(whole)[: same - O.KMER + 1], O.kmers(edited)[: same - O.KMER + 1])


def plain_fingerprint(text):
    """Order MinHash word by word in whole numbers, from the method's description and the fixed multipliers only."""
    full = (1 << 64) - 1

    def mixed(x):
        for shift, by in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D)):
            x = (x ^ (x >> shift)) * by & full
        return x ^ (x >> 33)

    size, seen, items = min(12, len(text)), {}, []
    for at in range(len(text) - size + 1 if text else 0):
        part = text[at : at + size]
        h = 0
        for c in part:
            h = (h * 0x5851F42D4C957F2D + ord(c) + 1) & full
        h, number = mixed((h + size) & full), seen.get(part, 0)
        seen[part] = number + 1
        items.append(mixed((h + number * 0x9E3779B97F4A7C15) & full) if number else h)
    out = []
    for m in O._MULTIPLIERS.tolist():
        least = sorted(range(len(items)), key=lambda k: (((items[k] >> 32) * m) & 0xFFFFFFFF, k))[:2]
        total = len(least)
        for k in sorted(least):
            total = mixed((total * 0x9E3779B97F4A7C15 + items[k]) & full)
        out.append(f"{total >> 32:08x}")
    return "".join(out)


def test_fingerprints_equal_a_plain_computation():
    rng = random.Random(11)
    for n in (0, 1, 5, 11, 12, 13, 14, 60, 300):
        for letters in ("ab c", "aé日😀 bcdefgh", "a"):
            text = "".join(rng.choice(letters) for _ in range(n))
            assert O.as_text(O.fingerprint(text)) == plain_fingerprint(text)


def test_likeness_falls_with_the_edits():
    rng = random.Random(12)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(2000))
    own, last = O.fingerprint(text), 1.0
    for edits in (2, 20, 100):
        t = list(text)
        for k in rng.sample(range(len(t)), edits):
            t[k] = "#"
        now = O.likeness(own, O.fingerprint("".join(t)))
        assert now < last
        last = now
    assert last < 0.35


def test_order_matters():
    parts = ["the quick brown fox jumps", "over the lazy dog again and", "while nobody looks at it", "for a very long time indeed"]
    text, turned = " ".join(parts * 3), " ".join(parts[::-1] * 3)
    assert O.likeness(O.fingerprint(text), O.fingerprint(text)) == 1.0
    assert O.likeness(O.fingerprint(text), O.fingerprint(turned)) < 0.7


@pytest.mark.parametrize("rows", [1, 3, 1024])
def test_neighbours_across_ranges(make_docs, rows):
    import hashlib

    rng = random.Random(rows)
    docs = [(k, "".join(rng.choice("abcd efg") for _ in range(rng.randint(0, 90)))) for k in rng.sample(range(-30, 300), 25)]
    docs += [(400, None), (401, ""), (402, "x")]
    order = sorted(docs)
    found = {r.doc_id: r for r in O.compare_with_next(make_docs(docs), range_rows=rows).collect()}
    assert len(found) == len(docs)
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = found[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == O.as_text(O.fingerprint(text)) and r.edited_fingerprint == O.as_text(O.fingerprint(edited))
        assert r.near_edited == O.likeness(O.fingerprint(text), O.fingerprint(edited))
        assert r.near_next == O.likeness(O.fingerprint(text), O.fingerprint(following))


def test_fingerprints_of_odd_rows(odd, no_docs, make_docs):
    rows = O.compare_with_next(odd, range_rows=2).collect()
    assert len(rows) == odd.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert O.compare_with_next(no_docs).count() == 0
    (only,) = O.compare_with_next(make_docs([(3, "abcdefgh")])).collect()
    assert only.near_next == 1.0
    assert len({r.fingerprint for r in O.order_fingerprints(odd).where("doc_id in (1, 2)").collect()}) == 1
