"""Op 7, token counts by prefix dynamic programming.

The last-token recurrence gives the exact token count of *every* prefix of a text in one pass. Each document keeps
its counts as one signed byte per code point (the change of the count), from which the total, the count of any
prefix and the longest prefix within a budget are read without encoding again. Words are independent (no piece
crosses the border before a space), so a word's deltas are worked out once per worker. No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.llm.bpe import _NEVER, Merges
from marquee.llm.common import blocks, column_list, table

#: Words kept in a worker's cache; code points beyond which a word is worked out and not kept.
CACHE_WORDS, LONG_WORD = 250_000, 48
#: Fixed value: the stand-in of a space inside pieces.
SPACE = "▁"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str) -> Merges:
    """Merges over characters of a sentence-piece model (identity normalisation, leading space added).

    Pieces merge by score; equal scores merge from the left. A piece that its own text does not merge into can
    never be made, so it is left out. A character that is no piece but takes part in merges has a negative id.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    text_of = {i: sp.id_to_piece(i) for i in plain}
    level = {s: k for k, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
    rank_of = {text_of[i]: level[sp.get_score(i)] for i in plain if len(text_of[i]) > 1}
    ids = {s: i for i, s in text_of.items()}
    made: dict[str, int] = {s: i for s, i in ids.items() if len(s) == 1}
    split: dict[int, tuple[int, int]] = {}
    for s in sorted(rank_of, key=len):
        parts = _last_merge(list(s), rank_of)
        if parts and all(len(x) == 1 or x in made for x in parts):
            split[ids[s]] = tuple(made.setdefault(x, -ord(x) - 2) if len(x) == 1 else made[x] for x in parts)
            made[s] = ids[s]
    return Merges(made, split, {t: rank_of[text_of[t]] for t in split})


def _last_merge(symbols: list[str], rank_of: dict[str, int]) -> tuple[str, str] | None:
    """The two parts that merge last when the whole text becomes one symbol; None if it does not."""
    whole = "".join(symbols)
    while len(symbols) > 2:
        ranks = [rank_of.get(a + b, _NEVER) for a, b in zip(symbols, symbols[1:])]
        k = int(np.argmin(ranks))
        if ranks[k] == _NEVER:
            return None
        symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
    return tuple(symbols) if len(symbols) == 2 and whole in rank_of else None


class PrefixCounter:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.merges = load_pieces(path)
        self.words = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words

    def word_deltas(self, words: Iterable[str]) -> dict[str, bytes]:
        """Change of the token count with each code point of distinct words, one signed byte each."""
        found: dict[str, bytes] = {}
        short = []
        for word in words:
            if len(word) <= LONG_WORD:
                short.append(word)
            else:
                for _, _, counts in self.merges.walk([word]):
                    found[word] = _changes(counts)
        found.update((word, _changes(counts)) for word, _, counts in self.merges.walk(sorted(short)))
        return found

    def block_deltas(self, texts: list[str]) -> list[bytes]:
        """For each text, signed bytes, one per code point; their running sum is the token count of every prefix."""
        cut = [self.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        cache = self.cache
        new = self.word_deltas(set().union(*cut).difference(cache))
        room = self.cache_words - len(cache)
        cache.update(islice(((w, d) for w, d in new.items() if len(w) <= LONG_WORD), room))
        return [_without_added_space(b"".join([cache[w] if w in cache else new[w] for w in words])) for words in cut]


def _changes(counts: list[int]) -> bytes:
    return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])


def _without_added_space(deltas: bytes) -> bytes:
    """The leading space that encoding adds is counted together with the first code point of the text."""
    return bytes([(deltas[0] + deltas[1]) & 255]) + deltas[2:] if deltas else b""


def counts_of(deltas: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2, ... code points."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(deltas, np.int8), dtype=np.int64)])


def fitting_prefix(deltas: bytes, budget: int) -> int:
    """Code points of the longest prefix with at most ``budget`` tokens (counts need not rise with the length)."""
    return int(np.flatnonzero(counts_of(deltas) <= budget)[-1]) if budget >= 0 else 0


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("fit_chars", T.LongType()),
    T.StructField("deltas", T.BinaryType()),
])


def prefix_counts(docs: DataFrame, budget: int, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep_deltas: bool = True) -> DataFrame:
    """One row per input row: UTF-8 bytes, tokens, code points of the longest prefix within ``budget`` tokens, and
    the prefix counts as signed byte deltas.

    Null text counts as empty: no bytes, no tokens. Special strings inside a text are ordinary text. Ids may be null
    or repeated; other columns are not read.
    """
    path = path or default_path()
    schema = SCHEMA if keep_deltas else T.StructType(SCHEMA.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(path)
        for block in blocks(batches, "text"):
            texts = [t or "" for t in column_list(block, "text")]
            deltas = counter.block_deltas(texts)
            columns = {
                "doc_id": pa.array(column_list(block, "doc_id"), pa.int64()),
                "n_bytes": pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                "n_tokens": pa.array([int(np.frombuffer(d, np.int8).sum(dtype=np.int64)) for d in deltas], pa.int64()),
                "fit_chars": pa.array([fitting_prefix(d, budget) for d in deltas], pa.int64()),
            }
            if keep_deltas:
                columns["deltas"] = pa.array(deltas, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, schema)


#: Tokens beyond which the query marks a document.
LIMIT = 4096


def op7(spark, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    out = prefix_counts(table(spark, sf_dir, "documents", "doc_id", "text"), LIMIT, keep_deltas=False)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fit_chars")
