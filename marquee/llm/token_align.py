"""Op 11, alignment of two tokenizers by interval coalescing.

The tokens of both tokenizers over the same bytes are intervals. All intervals of a block of texts are sorted by start
(lexsort) and the running maximum of their ends (``maximum.accumulate``) is compared with the next start: where a start
reaches it, a group ends. Within groups, each token is linked with the tokens of the other side that it overlaps.

Texts are cut into units at spaces that follow no white space, where both tokenizers cut words for certain, so a unit is
encoded and aligned once per block and the frequent ones once per worker. How many documents hold a link is counted over
the corpus: chunks of documents add up their own pairs, the sums meet the chunks' pairs by a join on the pair, and go
back to the documents of the chunk. No pair list of the corpus is ever sent to all tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import token_codec, token_counts
from marquee.llm.bpe import load_byte_level
from marquee.llm.common import blocks, column_list, table, written

#: Bytes of text whose pairs are added up together, and that are aligned at once; units kept in a worker's cache, and
#: characters of the longest kept.
CHUNK_BYTES, ALIGN_BYTES, CACHE_UNITS, LONG_UNIT = 8 << 20, 1 << 20, 150_000, 64
#: Fixed value: the stand-in of a space inside pieces.
SPACE = "▁"

# a last single space stays with its word: alone it would be an empty text to the side that adds a space itself
_CUT = re.compile(r"(?<=\S)(?= (?s:.))")


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each interval and the number of groups' first places: (group, first interval of each in order of
    start). A group ends where the next start reaches the largest end so far. Intervals are not empty."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order]) if len(order) else ends
    opens = np.concatenate([[True], starts[order][1:] >= reach[:-1]]) if len(order) else np.zeros(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    return group, order[opens]


def overlaps(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and B of all pairs of intervals that overlap. Both sides are in order and free of overlaps."""
    first = np.searchsorted(b[1], a[0], side="right")
    many = np.maximum(np.searchsorted(b[0], a[1], side="left") - first, 0)
    left = np.repeat(np.arange(len(many)), many)
    return left, np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)


class Unit(NamedTuple):
    """What a unit adds to its document; ``groups`` is None if one tokenizer does not give back the unit's bytes."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str | None
    pairs: np.ndarray  # id pair of each link, A id in the upper half


_NO_PAIRS = np.zeros(0, np.int64)


def _sizes(lists: list) -> np.ndarray:
    return np.fromiter(map(len, lists), np.int64, len(lists))


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64)


class Aligner:
    def __init__(self, path_a: str, path_b: str, cache_units: int = CACHE_UNITS):
        import sentencepiece
        import tiktoken

        # The library below merges any two neighbours whose text is a token, where the file lists the pairs that merge. Both
        # give the same wherever every token's own text merges into that token, which a test holds for the whole vocabulary.
        merges, self.bytes_a, _ = load_byte_level(path_a)
        ids = sorted(merges.ids.values(), key=lambda i: (i in merges.split, merges.rank.get(i, i)))
        self.id_of_rank = np.array(ids, np.int64)
        ranks = {self.bytes_a[i]: k for k, i in enumerate(ids)}
        self.a = tiktoken.Encoding("byte level", pat_str=token_codec.WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [self.bytes_a.get(i, b"") for i in range(max(self.bytes_a) + 1)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i in range(self.b.get_piece_size()) for p in (self.b.id_to_piece(i),)]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.cache: dict[str, Unit] = {}
        self.cache_units = cache_units
        # every id as text, with what can follow it inside its group and after its part of it
        self.text_a = np.array([f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"], object)
        self.text_b = np.array([f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"], object)

    def units(self, texts: list[str]) -> list[list[str]]:
        """Each text behind one added space, cut at its units; a text without characters has none."""
        return [_CUT.split(" " + t) if t else [] for t in texts]

    def align(self, units: list[str]) -> list[Unit]:
        """Encode distinct units by both tokenizers and align them all at once."""
        ids_a = list(map(self.a.encode_ordinary, units))
        ids_b = self.b.encode([u[1:] for u in units], num_threads=1)  # this side adds the space itself
        raw = [u.encode("utf-8", "surrogatepass") for u in units]
        n_a, n_b, flat_a, flat_b = _sizes(ids_a), _sizes(ids_b), self.id_of_rank[_flat(ids_a)], _flat(ids_b)
        if self._given_back(raw, n_a, flat_a, self.size_a, self.bytes_a) and self._given_back(raw, n_b, flat_b, self.size_b, self.bytes_b):
            return self._aligned(n_a, n_b, flat_a, flat_b)
        whole = lambda ids, table: b"".join([table[i] for i in ids])
        good = [whole(self.id_of_rank[x], self.bytes_a) == r == whole(y, self.bytes_b) for x, y, r in zip(ids_a, ids_b, raw)]
        ids_a, ids_b = [x for x, ok in zip(ids_a, good) if ok], [y for y, ok in zip(ids_b, good) if ok]
        found = iter(self._aligned(_sizes(ids_a), _sizes(ids_b), self.id_of_rank[_flat(ids_a)], _flat(ids_b)) if ids_a else ())
        return [next(found) if ok else Unit(0, 0, 0, None, _NO_PAIRS) for ok in good]

    @staticmethod
    def _given_back(raw: list[bytes], n: np.ndarray, flat: np.ndarray, size: np.ndarray, table: list[bytes]) -> bool:
        """Whether all units' tokens make up their bytes: the ends agree, and so do the bytes of all units in a row."""
        ends = np.concatenate([[0], np.cumsum(size[flat])])[np.cumsum(n)]
        return np.array_equal(ends, np.cumsum(_sizes(raw))) and b"".join([table[i] for i in flat.tolist()]) == b"".join(raw)

    def _aligned(self, n_a: np.ndarray, n_b: np.ndarray, flat_a: np.ndarray, flat_b: np.ndarray) -> list[Unit]:
        end_a, end_b = np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b])
        start_a, start_b = end_a - self.size_a[flat_a], end_b - self.size_b[flat_b]
        # units lie end to end, so each begins a group of its own
        group, _ = coalesce(np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b]))
        group_a, group_b = group[: len(flat_a)], group[len(flat_a) :]
        left, right = overlaps((start_a, end_a), (start_b, end_b))
        codes = flat_a[left] << 32 | flat_b[right]
        # all ids as texts, group after group, A before B: each stands behind the tokens of the groups before its own
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        texts = np.empty(len(group), object)
        texts[np.arange(len(flat_a)) + np.searchsorted(group_b, group_a, side="left")] = self.text_a[2 * flat_a + last_a]
        texts[np.arange(len(flat_b)) + np.searchsorted(group_a, group_b, side="right")] = self.text_b[2 * flat_b + last_b]
        texts = texts.tolist()
        ends = np.cumsum(n_a)
        links = np.searchsorted(left, ends).tolist()
        groups = (group_a[ends - 1] + 1).tolist()
        tokens = np.cumsum(n_a + n_b).tolist()
        return [
            Unit(a, b, g1 - g0, "".join(texts[t0:t1])[:-1], codes[l0:l1])
            for a, b, g0, g1, t0, t1, l0, l1 in zip(n_a.tolist(), n_b.tolist(), [0, *groups], groups, [0, *tokens], tokens, [0, *links], links)
        ]

    def lookup(self, texts: list[list[str]]) -> dict[str, Unit]:
        """All units of some texts; the short ones are kept for later texts while there is room."""
        cache = self.cache
        wanted = set().union(*texts)
        fresh = list(wanted.difference(cache))
        found = {u: cache[u] for u in wanted.intersection(cache)}
        if fresh:
            new = self.align(fresh)
            found.update(zip(fresh, new))
            room = self.cache_units - len(cache)
            if room > 0:
                cache.update(islice(((u, x) for u, x in zip(fresh, new) if len(u) <= LONG_UNIT), room))
        return found


_DOCUMENT = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
SCHEMA = T.StructType(
    [T.StructField("chunk", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in _DOCUMENT]
    + [T.StructField("groups_sha256", T.StringType()), T.StructField("groups", T.StringType()), T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType())]
    + [T.StructField(c, T.IntegerType()) for c in ("at", "a", "b")]
    + [T.StructField("docs", T.LongType())]
)


def planes(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as four planes of bytes, which compress well when the numbers are small."""
    return np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


class _Chunk:
    """Documents of one chunk: their rows, and the id pairs of their links with how often each document has them."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.rows: list[tuple] = []
        # distinct pairs of all documents in a row, how often, and how many each document has
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Document rows, then a row for each distinct pair with the number of documents that hold it. A document names
        its pairs by their place in that list, the frequent ones first, as steps from one to the next."""
        ends = np.cumsum(np.concatenate(self.sizes)).tolist()
        codes, place, docs = np.unique(np.concatenate(self.codes), return_inverse=True, return_counts=True)
        order = np.argsort(-docs, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        every, count, pairs, times = rank[place], np.concatenate(self.times), [], []
        for start, end in zip([0, *ends], ends):
            mine = every[start:end]
            turn = np.argsort(mine)
            pairs.append(planes(np.diff(mine[turn], prepend=0)))
            times.append(planes(count[start:end][turn]))
        yield self._batch(len(ends), {c: pa.array(x, pa.string() if c.startswith("groups") else pa.int64()) for c, x in zip([*_DOCUMENT, "groups_sha256", "groups"], zip(*self.rows))} | {"pairs": pa.array(pairs, pa.binary()), "times": pa.array(times, pa.binary())})
        codes, docs = codes[order], docs[order]
        for k in range(0, len(codes), 1 << 16):
            part = codes[k : k + (1 << 16)]
            yield self._batch(len(part), {"at": pa.array(np.arange(k, k + len(part), dtype=np.int32)), "a": pa.array((part >> 32).astype(np.int32)), "b": pa.array((part & 0xFFFFFFFF).astype(np.int32)), "docs": pa.array(docs[k : k + len(part)].astype(np.int64))})

    def _batch(self, n: int, columns: dict) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(SCHEMA)
        columns["chunk"] = pa.array(np.full(n, self.number))
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)


def _chunks(path_a: str, path_b: str, chunk_bytes: int, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        chunk = _Chunk(number)
        for block in blocks(batches, "text", ALIGN_BYTES):
            texts = [t or "" for t in column_list(block, "text")]
            cut = aligner.units(texts)
            units = aligner.lookup(cut)
            place = {u: k for k, u in enumerate(units)}
            every = list(units.values())
            names = [u.groups for u in every]
            counts = np.array([(u.n_a, u.n_b, u.n_groups, len(u.pairs), u.groups is None) for u in every], np.int64).reshape(-1, 5)
            codes, code_of = np.unique(np.concatenate([_NO_PAIRS, *[u.pairs for u in every]]), return_inverse=True)
            begin = np.cumsum(counts[:, 3]) - counts[:, 3]
            # all units of all documents in a row
            own = [[place[u] for u in units] for units in cut]
            sizes = _sizes(own)
            at, doc_of = _flat(own), np.repeat(np.arange(len(own)), sizes)
            sums = np.stack([np.bincount(doc_of, counts[at, k], len(own)) for k in range(5)], axis=1).astype(np.int64)
            good = (sums[:, 4] == 0) & (sizes > 0)
            sums[~good] = 0
            for doc, k, ok, row in zip(column_list(block, "doc_id"), own, good.tolist(), sums[:, :4].tolist()):
                joined = ";".join([names[x] for x in k]) if ok else ""
                chunk.rows.append((doc, *row, hashlib.sha256(joined.encode()).hexdigest() if ok else "", joined if with_groups else None))
            kept = good[doc_of]
            at, doc_of = at[kept], doc_of[kept]
            many = counts[at, 3]
            inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            found, times = np.unique(np.repeat(doc_of, many) * len(codes) + code_of[np.repeat(begin[at], many) + inside], return_counts=True)
            doc_of, code = np.divmod(found, max(1, len(codes)))
            chunk.codes.append(codes[code])
            chunk.times.append(times)
            chunk.sizes.append(np.bincount(doc_of, minlength=len(own)))
            chunk.size += sum(map(len, texts))
            if chunk.size >= chunk_bytes:
                yield from chunk.batches()
                chunk = _Chunk(number := number + 1)
        if chunk.rows:
            yield from chunk.batches()

    return run


def _with_counts(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """Documents of one chunk with the sums over their links; ``pairs`` has the corpus-wide count of each of its pairs."""
    total, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
    at = pairs.column("at").to_numpy()
    total[at], best[at] = pairs.column("total").to_numpy(), pairs.column("best").to_numpy(zero_copy_only=False)
    n_best, sums = [], []
    for steps, times in zip(documents.column("pairs").to_pylist(), documents.column("times").to_pylist()):
        mine, n = np.cumsum(from_planes(steps), dtype=np.int64), from_planes(times).astype(np.int64)
        n_best.append(int((best[mine] * n).sum()))
        sums.append(int((total[mine] * n).sum()))
    out = documents.select([*_DOCUMENT, "groups_sha256", "groups"])
    return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


class Alignment:
    """Tokens of one frame of documents, aligned. ``documents()`` and ``pair_counts()`` are what queries use."""

    def __init__(self, docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False, chunk_bytes: int = CHUNK_BYTES):
        rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
        run = _chunks(path_a or token_codec.default_path(), path_b or token_counts.default_path(), chunk_bytes, with_groups)
        self.chunks = written(rows.mapInArrow(run, SCHEMA), "token-align")
        self.pairs = self.chunks.where("at is not null").select("chunk", "at", "a", "b", "docs")

    def pair_counts(self) -> DataFrame:
        """One row per linked id pair: a, b, total (documents that hold it linked), best (whether no pair of the same A id
        is in more documents)."""
        counts = self.pairs.groupBy("a", "b").agg(F.sum("docs").alias("total"))
        most = counts.groupBy("a").agg(F.max("total").alias("most"))
        return counts.join(most, "a").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))

    def documents(self) -> DataFrame:
        """One row per input row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups (`a1,a2|b1;a3|b2`, if asked
        for), n_best (links whose count is the highest of their A id), count_sum (over links).

        A text that is null, empty, or not given back byte for byte by both tokenizers has no tokens: zeros and empty
        texts. Repeated rows are documents of their own; ids may be null; other columns are not read.
        """
        asked = self.pairs.select("chunk", "at", "a", "b").join(self.pair_counts(), ["a", "b"]).select(F.col("chunk").alias("of_chunk"), "at", "total", "best")
        rows = self.chunks.where("at is null").select("chunk", *_DOCUMENT, "groups_sha256", "groups", "pairs", "times")
        schema = T.StructType([f for f in SCHEMA if f.name in (*_DOCUMENT, "groups_sha256", "groups")] + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
        return rows.groupBy("chunk").cogroup(asked.groupBy("of_chunk")).applyInArrow(_with_counts, schema)


def op11(spark, sf_dir: str) -> DataFrame:
    """The digest columns of every document; see ``Alignment.documents``."""
    found = Alignment(table(spark, sf_dir, "documents", "doc_id", "text")).documents()
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
