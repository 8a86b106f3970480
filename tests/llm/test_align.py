"""Token alignment against whole-text encoding by the libraries and a plain search for overlaps."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from conftest import SMALL  # noqa: E402
from marquee.llm import token_align as A  # noqa: E402
from marquee.llm import token_codec, token_counts  # noqa: E402
from marquee.llm.bpe import byte_alphabet  # noqa: E402
from marquee.llm.common import table  # noqa: E402


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(token_codec.default_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())


def spans(libraries, text):
    """(A tokens, B tokens) of a whole text as (id, start, end); None if some bytes are not given back."""
    a, b = libraries
    byte_of, raw = byte_alphabet(), (" " + text).encode()
    sides = ([(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
             [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in (b.id_to_piece(i),)])
    out = []
    for side in sides:
        if b"".join(x for _, x in side) != raw:
            return None
        at, found = 0, []
        for i, x in side:
            found.append((i, at, at + len(x)))
            at += len(x)
        out.append(found)
    return out


def brute(libraries, docs):
    linked, rows = [], []
    for doc_id, text in docs:
        both = spans(libraries, text) if text else None
        if both is None:
            linked.append([])
            rows.append((doc_id, 0, 0, 0, ""))
            continue
        x, y = both
        ends = sorted({e for _, _, e in x} & {e for _, _, e in y})
        groups, low = [], 0
        for end in ends:
            part = [",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in (x, y)]
            groups.append("|".join(part))
            low = end
        j, links = 0, []
        for i, s, e in x:
            while y[j][2] <= s:
                j += 1
            k = j
            while k < len(y) and y[k][1] < e:
                links.append((i, y[k][0]))
                k += 1
        linked.append(links)
        rows.append((doc_id, len(x), len(y), len(groups), ";".join(groups)))
    counts = Counter(p for links in linked for p in set(links))
    most = defaultdict(int)
    for (a, _), c in counts.items():
        most[a] = max(most[a], c)
    return [(*row, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links)) for row, links in zip(rows, linked)], counts


def result(frame):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.groups, r.n_links, r.n_best, r.count_sum) for r in frame.collect()]


TEXTS = ["", None, "a", " ", "  two  spaces ", "line\nbreak \n  indent\t x", "trailing\n", "trailing  ", "</s> <s>x<|endoftext|> <0x41>", "été naïve 東京 😀👩‍👩‍👧", "holds ▁ itself", "x\x00y \x1c z\x85 w",
         "non break em 　wide", "don't we'll 12345 1,2", "word " * 300, "y" * 5000, "a" * 70 + " b"]


def test_coalescing_with_gaps_and_ties():
    a, b = (np.array([0, 2, 9, 12]), np.array([2, 5, 12, 13])), (np.array([0, 6, 10]), np.array([5, 8, 11]))
    group, first = A.coalesce(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]))
    assert group.tolist() == [0, 0, 2, 3, 0, 1, 2] and len(first) == 4
    left, right = A.overlaps(a, b)
    assert list(zip(left.tolist(), right.tolist())) == [(0, 0), (1, 0), (2, 2)]
    assert [x.tolist() for x in A.coalesce(np.zeros(0, int), np.zeros(0, int))] == [[], []]


def test_numbers_as_planes():
    x = np.array([0, 1, 255, 256, 2**32 - 1], np.uint32)
    assert A.from_planes(A.planes(x)).tolist() == x.tolist() and A.from_planes(A.planes(x[:0])).tolist() == []


def test_documents_equal_the_plain_search(spark, libraries, make_docs):
    rng = random.Random(2)
    letters = "aabe tt  \n\t'1é😀▁ 日,.<"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    docs = [(k, t) for k, t in enumerate(texts)] + [(3, "a"), (None, "a b")]
    want, counts = brute(libraries, docs)
    for chunk_bytes in (A.CHUNK_BYTES, 400):
        found = A.Alignment(make_docs(docs).repartition(3), with_groups=True, chunk_bytes=chunk_bytes)
        assert sorted(result(found.documents()), key=repr) == sorted(want, key=repr)
        assert {(r.a, r.b): r.total for r in found.pair_counts().collect()} == dict(counts)


def test_query(spark, libraries):
    got = sorted(map(tuple, A.op11(spark, SMALL).collect()))
    want, _ = brute(libraries, [(d.doc_id, d.text) for d in table(spark, SMALL, "documents", "doc_id", "text").collect()])
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    assert got == sorted((d, na, nb, ng, nl, best, total, digest(g)) for d, na, nb, ng, g, nl, best, total in want)


def test_every_token_text_merges_into_its_token(libraries):
    """What makes merging by token texts the same as merging by the listed pairs: run on the listed pairs alone."""
    merges, text_of, _ = A.load_byte_level(token_codec.default_path())
    for word, last, _ in merges.walk(sorted(merges.ids)):
        assert last[len(word)] == merges.ids[word] and text_of[last[len(word)]] == word
    assert sorted(merges.rank.values()) == list(range(len(merges.rank))) and merges.rank.keys() == merges.split.keys()


def test_ids_equal_the_library(libraries):
    rng = random.Random(8)
    texts = [t for t in TEXTS if t] + ["".join(chr(rng.choice([rng.randrange(0x20, 0x180), rng.randrange(0x2000, 0x30FF)])) for _ in range(60)) for _ in range(400)]
    aligner = A.Aligner(token_codec.default_path(), token_counts.default_path())
    assert [aligner.id_of_rank[aligner.a.encode_ordinary(t)].tolist() for t in texts] == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]


def test_cache_of_any_size_gives_the_same(libraries):
    small = A.Aligner(token_codec.default_path(), token_counts.default_path(), cache_units=3)
    full = A.Aligner(token_codec.default_path(), token_counts.default_path())
    for _ in range(2):
        cut = small.units([t or "" for t in TEXTS])
        x, y = small.lookup(cut), full.lookup(cut)
        assert {u: (v.n_a, v.groups, v.pairs.tolist()) for u, v in x.items()} == {u: (v.n_a, v.groups, v.pairs.tolist()) for u, v in y.items()}


def test_empty_table_and_odd_rows(no_docs, odd):
    assert A.Alignment(no_docs).documents().collect() == []
    assert A.Alignment(odd).documents().count() == odd.count()
