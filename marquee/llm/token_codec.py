"""Op 1, BPE encoding and decoding by prefix sharing.

The distinct words of a block of documents go into a trie; a depth-first walk carries the last token of every
prefix, so a prefix that many words share is worked out once. A word's tokens are read back from its end.
Documents are then looked up word by word. No shuffle: blocks are bounded by bytes, the word cache by entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.llm.bpe import load_byte_level
from marquee.llm.common import blocks, column_list

#: Words kept in a worker's cache, and bytes beyond which a word is worked out alone and not kept.
CACHE_WORDS, LONG_WORD = 250_000, 64

#: Fixed value: how byte-level vocabularies of this family cut text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def word_pattern() -> regex.Pattern:
    """The word pattern with white space as Unicode defines it (the property, not Python's wider class)."""
    return regex.compile(WORD_PATTERN.replace(r"[^\s\p{L}", r"[^\p{White_Space}\p{L}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class TrieEncoder:
    """Encoder and decoder of one vocabulary; ids come as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.merges, self.text_of, self.added = load_byte_level(path)
        self.words = word_pattern()
        self.added_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words
        self.raw_ids = {t: int(t).to_bytes(4, "little") for t in self.text_of}
        self.size_of = {t: len(raw) for t, raw in self.text_of.items()}
        self.bytes_of = [self.text_of.get(t, b"") for t in range(max(self.text_of, default=-1) + 1)]

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Token ids of distinct words through one trie.

        The trie is held in its depth-first order, the words sorted by bytes; see ``Merges.walk``. A long word has
        a walk of its own, in time linear in its length.
        """
        found: dict[str, bytes] = {}
        short: dict[bytes, str] = {}
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            if len(raw) <= LONG_WORD:
                short[raw] = word
            else:
                for _, last, _ in self.merges.walk([raw]):
                    found[word] = self._read_back(last, len(raw))
        for raw, last, _ in self.merges.walk(sorted(short)):
            found[short[raw]] = self._read_back(last, len(raw))
        return found

    def _read_back(self, last: list[int], end: int) -> bytes:
        out, raw_ids, size_of = [], self.raw_ids, self.size_of
        while end:
            token = last[end]
            out.append(raw_ids[token])
            end -= size_of[token]
        out.reverse()
        return b"".join(out)

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """Ids of every whole text. Added tokens inside a text become their id, as the library does by default."""
        cut = [self._pieces(t) for t in texts]
        cache = self.cache
        fresh = set().union(*cut).difference(cache)
        special = fresh & self.added.keys()
        new = self.encode_words(fresh - special) | {w: self.raw_ids[self.added[w]] for w in special}
        room = self.cache_words - len(cache)
        cache.update((w, ids) for (w, ids), _ in zip(((w, i) for w, i in new.items() if len(w) <= LONG_WORD), range(room)))
        return [b"".join([cache[w] if w in cache else new[w] for w in words]) for words in cut]

    def _pieces(self, text: str) -> list[str]:
        if self.added_split is None or not any(a in text for a in self.added):
            return self.words.findall(text)
        out: list[str] = []
        for part in self.added_split.split(text):
            out.extend([part] if part in self.added else self.words.findall(part))
        return out

    def decode(self, ids: bytes) -> str:
        at = self.bytes_of
        return b"".join([at[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("ids", T.BinaryType()),
    T.StructField("decoded", T.StringType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """One row per input row: the token ids (little-endian u32 bytes), the decoded text, and digests of both.

    ``keep`` names which of the two large columns are wanted; digests are always there. Null text counts as empty
    (no tokens, empty decode). Ids may be null or repeated: rows are independent. Other columns are not read.
    """
    path = path or default_path()
    keep = tuple(keep)
    schema = T.StructType([f for f in SCHEMA if f.name not in ("ids", "decoded") or f.name in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = TrieEncoder(path)
        for block in blocks(batches, "text"):
            texts = [t or "" for t in column_list(block, "text")]
            ids = coder.encode_block(texts)
            columns = {"doc_id": pa.array(column_list(block, "doc_id"), pa.int64())}
            digests, sizes, texts_out = [], [], []
            for x in ids:
                text = coder.decode(x)
                digests.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
                sizes.append(len(text))
                if "decoded" in keep:
                    texts_out.append(text)
            if "ids" in keep:
                columns["ids"] = pa.array(ids, pa.binary())
            if "decoded" in keep:
                columns["decoded"] = pa.array(texts_out, pa.string())
            columns |= {
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": pa.array(digests, pa.string()),
                "n_chars": pa.array(sizes, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, schema)


def op1(spark, sf_dir: str) -> DataFrame:
    """The digest columns of every document; see ``encode_documents``."""
    from marquee.llm.common import table

    out = encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"), keep=())
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
