"""Encoding and counting against the public libraries."""

import hashlib
import random

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from conftest import SMALL  # noqa: E402
from marquee.llm import token_codec, token_counts  # noqa: E402
from marquee.llm.common import table  # noqa: E402

LETTERS = "aaabbe ett  \n'st1290é😀<|endoftext|>▁\t日"


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 120))) for _ in range(n)] + ["", "a" * 3000, " " * 500, "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(token_codec.default_path())


@pytest.fixture(scope="module")
def coder():
    return token_codec.TrieEncoder(token_codec.default_path())


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(token_counts.default_path())


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())


def test_ids_equal_the_library_and_decode_back(library, coder):
    texts = random_texts(400)
    ids = coder.encode_block(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [coder.decode(x) for x in ids] == texts == library.decode_batch([np.frombuffer(x, "<u4").tolist() for x in ids], skip_special_tokens=False)


def test_every_character_is_cut_as_the_library_does(library, coder):
    texts = [f"a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)}  {chr(c)}\n" for c in [*range(0x3000), *range(0xFE00, 0x10000, 7), *range(0x1F300, 0x1F700)]]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode_block(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_full_word_cache_changes_nothing(library):
    small = token_codec.TrieEncoder(token_codec.default_path(), cache_words=5)
    texts = random_texts(50)
    for part in (texts[:20], texts[10:], texts):
        assert [np.frombuffer(x, "<u4").tolist() for x in small.encode_block(part)] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_shared_prefixes_are_walked_once(coder):
    walked = list(coder.merges.walk(sorted([b"the", b"there", b"therefore", b"thin"])))
    assert [w for w, _, _ in walked] == [b"the", b"there", b"therefore", b"thin"]
    from marquee.llm.bpe import shared_prefixes

    assert shared_prefixes([b"the", b"there", b"therefore", b"thin"]) == [0, 3, 5, 2]
    assert shared_prefixes(["a", "ab", "b"]) == [0, 1, 0] and shared_prefixes([]) == []


def test_tokens_of_the_vocabulary_encode_as_themselves(coder):
    for raw, last, _ in coder.merges.walk(sorted(coder.merges.ids)):
        assert last[len(raw)] == coder.merges.ids[raw]


def test_codec_on_odd_rows(spark, odd, no_docs, library):
    rows = [r.asDict() for r in token_codec.encode_documents(odd).collect()]
    texts = [r["text"] or "" for r in odd.select("text").collect()]
    assert sorted(r["decoded"] for r in rows) == sorted(texts)
    for r in rows:
        want = library.encode(r["decoded"], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(bytes(r["ids"])).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert token_codec.encode_documents(no_docs).count() == 0


def test_codec_query(spark, library):
    docs = {r.doc_id: r.text for r in table(spark, SMALL, "documents", "doc_id", "text").collect()}
    found = token_codec.op1(spark, SMALL).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def test_counts_of_every_prefix(counter, pieces):
    for text in random_texts(25, seed=8)[:26]:
        assert token_counts.counts_of(counter.block_deltas([text])[0]).tolist() == [len(pieces.encode(text[:k])) for k in range(len(text) + 1)]


def test_counts_of_all_code_points(counter, pieces):
    """Every code point there is, between letters, spaces and other code points of its neighbourhood."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b {chr(c)}{chr(c)}" for c in points[k : k + 512]) for k in range(0, len(points), 512)]
    got = [int(token_counts.counts_of(d)[-1]) for d in counter.block_deltas(texts)]
    assert got == [len(x) for x in pieces.encode(texts)]


def test_counts_of_whole_texts(counter, pieces):
    texts = random_texts(800, seed=9) + [" " * k + "a" + " " * k for k in range(20)]
    assert [int(token_counts.counts_of(d)[-1]) for d in counter.block_deltas(texts)] == [len(x) for x in pieces.encode(texts)]


def test_budget_without_encoding_again(counter, pieces):
    text = "Then the unbelievable answer came, at 12 o'clock. " * 3
    deltas = counter.block_deltas([text])[0]
    for budget in range(0, 60, 7):
        k = token_counts.fitting_prefix(deltas, budget)
        assert len(pieces.encode(text[:k])) <= budget
        assert all(len(pieces.encode(text[:j])) > budget for j in range(k + 1, len(text) + 1))


def test_count_query_and_odd_rows(spark, odd, no_docs, pieces):
    for docs in (odd, table(spark, SMALL, "documents", "doc_id", "text")):
        want = sorted((len((r.text or "").encode()), len(pieces.encode(r.text or ""))) for r in docs.collect())
        found = token_counts.prefix_counts(docs, 100).collect()
        assert sorted((r.n_bytes, r.n_tokens) for r in found) == want
        assert all(int(token_counts.counts_of(bytes(r.deltas))[-1]) == r.n_tokens for r in found)
    assert token_counts.prefix_counts(no_docs, 10).count() == 0
    assert all(r.over_limit == (r.n_tokens > 4096) for r in token_counts.op7(spark, SMALL).collect())
