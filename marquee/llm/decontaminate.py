"""Op 5, benchmark decontamination with suffix arrays.

Each block of training documents (bounded by bytes) becomes one shard: its words as integer ids, and a suffix array
over the places where a benchmark window can start. Every benchmark suffix of window length is looked up in each
shard by binary search, which gives all its verbatim occurrences; neighbouring hits on one diagonal add up to the
longest match. Words outside the benchmark's vocabulary end a suffix, so places before them are left out: no window
can match there. The benchmark travels to the tasks in parts of a checked size, one at a time; between two parts the rows
are written to the shared folder. No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import Shared, blocks, column_bytes, column_list, keep_rows, table, written

#: Words of a window, and bytes of benchmark text that one pass sends to the tasks.
WINDOW, BENCHMARK_BLOCK = 10, 16 << 20

#: A-Z lower-cased, other letters, digits and bytes of non-ASCII characters kept, everything else a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(raw: bytes) -> list[bytes]:
    return raw.translate(_WORD_BYTES).split()


class Benchmark:
    """The windows of some benchmark items, over the items' own vocabulary (ids from 1)."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item_id, raw in items:
            if text := tuple(words(raw)):
                owners.setdefault(text, set()).update([item_id] if item_id is not None else [])
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        texts = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in t], ">u4") for t in owners]
        self.owners = [sorted(ids) for ids in owners.values()]
        # a place of the benchmark per window: its ids padded with zeros, its length, its text and offset
        rows, sizes, text_at, offset = [], [], [], []
        for k, t in enumerate(texts):
            n = min(window, len(t))
            view = np.lib.stride_tricks.sliding_window_view(t, n)
            rows.append(np.pad(view, ((0, 0), (0, window - n))))
            sizes += [n] * len(view)
            text_at += [k] * len(view)
            offset += range(len(view))
        places = np.concatenate(rows) if rows else np.zeros((0, window), ">u4")
        keys = _keys(places)
        self.keys, which = np.unique(keys, return_inverse=True)
        order = np.argsort(which, kind="stable")
        self.first = np.searchsorted(which[order], np.arange(len(self.keys) + 1))
        self.text_at, self.offset = np.array(text_at, np.int64)[order], np.array(offset, np.int64)[order]
        self.sizes = np.array(sizes, np.int64)[order][self.first[:-1]] if len(self.keys) else np.zeros(0, np.int64)
        full = places[order][self.first[:-1]].copy() if len(self.keys) else places
        full[full == 0] = 0xFFFFFFFF
        self.upper = _keys(full)
        self.shortest = int(self.sizes.min()) if len(self.sizes) else window


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian ids as byte strings, which compare as the rows do."""
    return np.ascontiguousarray(rows, ">u4").view(f"S{4 * rows.shape[1]}").ravel()


class Shard:
    """Suffix array over the words of some documents."""

    def __init__(self, benchmark: Benchmark, texts: list[bytes]):
        get = benchmark.vocabulary.get
        ids, self.n_words = [], []
        for raw in texts:
            found = [get(w, 0) for w in words(raw)]
            self.n_words.append(len(found))
            ids += found
            ids.append(0)
        self.ids = np.array(ids + [0] * benchmark.window, ">u4")
        self.starts = np.concatenate([[0], np.cumsum(np.array(self.n_words, np.int64) + 1)])
        # places with at least the shortest window of known words ahead
        ends = np.flatnonzero(self.ids == 0)
        known = np.flatnonzero(self.ids)
        ahead = ends[np.searchsorted(ends, known)] - known
        places = known[ahead >= benchmark.shortest]
        keys = _keys(self.ids[places[:, None] + np.arange(benchmark.window)]) if len(places) else np.zeros(0, f"S{4 * benchmark.window}")
        order = np.argsort(keys, kind="stable")
        self.places, self.keys = places[order], keys[order]

    def search(self, benchmark: Benchmark) -> tuple[np.ndarray, np.ndarray]:
        """All occurrences: window numbers and their places in the shard."""
        low = np.searchsorted(self.keys, benchmark.keys, "left")
        high = np.searchsorted(self.keys, benchmark.upper, "right")
        found = np.flatnonzero(high > low)
        window = np.repeat(found, (high - low)[found])
        at = np.concatenate([self.places[low[k] : high[k]] for k in found]) if len(found) else np.zeros(0, np.int64)
        return window, at


def match_block(benchmark: Benchmark, texts: list[bytes]) -> list[tuple[int, list[int], set[str], int]]:
    """For each text: words, hit spans as flat (start, end) word positions, ids of items found, longest match."""
    shard = Shard(benchmark, texts)
    out: list[tuple[int, list[int], set[str], int]] = [(n, [], set(), 0) for n in shard.n_words]
    window, at = shard.search(benchmark)
    if not len(at):
        return out
    edges = np.zeros(len(shard.ids) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + benchmark.sizes[window], -1)
    covered = np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8)])
    turns = np.flatnonzero(np.diff(covered))
    for start, end in turns.reshape(-1, 2).tolist():  # a span never crosses documents: a zero id parts them
        doc = int(np.searchsorted(shard.starts, start, "right")) - 1
        out[doc][1].extend((start - int(shard.starts[doc]), end - int(shard.starts[doc])))
    # occurrences with the benchmark places of their windows, and runs along diagonals
    doc_of = np.searchsorted(shard.starts, at, "right") - 1
    counts = (benchmark.first[1:] - benchmark.first[:-1])[window]
    place = np.repeat(benchmark.first[:-1][window], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    text, here = benchmark.text_at[place], np.repeat(at, counts)
    diagonal = here - benchmark.offset[place]
    order = np.lexsort((here, diagonal, text))
    text, here, diagonal, size, doc = text[order], here[order], diagonal[order], np.repeat(benchmark.sizes[window], counts)[order], np.repeat(doc_of, counts)[order]
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (diagonal[1:] != diagonal[:-1]) | (here[1:] != here[:-1] + 1)])
    first = np.flatnonzero(new)
    run = np.diff(np.concatenate([first, [len(new)]]))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, doc[first], run + size[first] - 1)
    for d, t in np.unique(np.stack([doc, text], axis=1), axis=0).tolist():
        out[d][2].update(benchmark.owners[t])
    return [(n, spans, ids, int(longest[k])) for k, (n, spans, ids, _) in enumerate(out)]


def merge_spans(a: list[int], b: list[int]) -> list[int]:
    """Union of two sorted lists of flat (start, end) spans."""
    if not a or not b:
        return a or b
    out: list[int] = []
    for start, end in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest_match", T.LongType()),
]


def find_overlap(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BENCHMARK_BLOCK) -> DataFrame:
    """One row per document row: words, hit spans (flat start and end word positions), ids of the items found, and
    the longest verbatim match in words.

    Null or word-less texts have no words and no hits; null or word-less items have no windows. An item without an id
    counts for hits but is not listed. Items of equal words share their windows and are all listed. Repeated document
    rows are judged row by row. Other columns are not read.
    """
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        docs[text_col].cast("string").alias("text"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in _FOUND],
    )
    for index, last in _benchmark_parts(benchmark, window, item_col, item_text_col, block_bytes):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), *([] if last else [T.StructField("text", T.StringType())]), *_FOUND])
        rows = rows.mapInArrow(_pass(index, last), schema)
        if not last:
            rows = written(rows, "benchmark-part")
            index.drop()
    return rows


def _benchmark_parts(benchmark: DataFrame, window: int, item_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[Shared, bool]]:
    """Indexes of the benchmark, each over about ``block_bytes`` of its text (its size is counted first), and whether it is
    the last. One at a time: the caller ends a part's work before it asks for the next, so neither the driver nor a task
    ever holds more than one."""
    spark = benchmark.sparkSession
    items = benchmark.select(benchmark[item_col].cast("string").alias("item"), benchmark[text_col].cast("binary").alias("raw")).where("raw is not null").distinct()
    size = items.agg(F.sum(F.octet_length("raw") + 16).alias("size")).first()["size"] or 0
    parts = max(1, -(-size // block_bytes))
    of_part = lambda k: items.where(F.pmod(F.xxhash64("raw"), F.lit(parts)) == k) if parts > 1 else items
    for k in range(parts):
        yield Shared(spark, Benchmark([(r["item"], bytes(r["raw"])) for r in of_part(k).collect()], window)), k == parts - 1


def _pass(index, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = index.get()
        for block in blocks(batches, "text"):
            found = match_block(benchmark, column_bytes(block, "text"))
            before = zip(column_list(block, "hit_spans"), column_list(block, "items"), column_list(block, "longest_match"))
            merged = [(n, merge_spans(s0 or [], s), sorted({*(i0 or ()), *i}), max(l0 or 0, l)) for (n, s, i, l), (s0, i0, l0) in zip(found, before)]
            columns = {"doc_id": block.column(0)}
            if not last:
                columns["text"] = block.column(1)
            columns |= {f.name: pa.array([m[j] for m in merged], pa.list_(pa.int64()) if j == 1 else pa.list_(pa.string()) if j == 2 else pa.int64()) for j, f in enumerate(_FOUND)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BENCHMARK_BLOCK) -> DataFrame:
    """The documents, all columns and rows as they are, without those that hold a benchmark window.

    Judged row by row like ``find_overlap``; null, empty and word-less texts stay, repeated rows are judged alike. No shuffle;
    a benchmark of several parts has its documents written between them.
    """
    for index, last in _benchmark_parts(benchmark, window, item_col, item_text_col, block_bytes):
        docs = keep_rows(docs, text_col, _clean_rows(index))
        if not last:
            docs = written(docs, "benchmark-part")
            index.drop()
    return docs


def _clean_rows(index: Shared):
    def judge():
        benchmark = index.get()
        return lambda block, column: [not spans for _, spans, _, _ in match_block(benchmark, column_bytes(block, column))]

    return judge


def op5(spark, sf_dir: str) -> DataFrame:
    found = find_overlap(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size("hit_spans") - 1), F.lit(0).cast("long"), lambda a, i: a + F.col("hit_spans")[i] * F.when(i % 2 == 1, 1).otherwise(-1))
    n_hit = F.when(F.size("hit_spans") == 0, F.lit(0).cast("long")).otherwise(n_hit)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


ORACLE = """
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
item AS (
  SELECT item_id, w, least(10, len(w)) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM item)),
place AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, s.n AS n, unnest(generate_series(1, len(w) - s.n + 1)) AS i
        FROM doc, (SELECT DISTINCT n FROM item) s WHERE len(w) >= s.n)),
hit AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM place p JOIN win ON win.n = p.n AND win.g = p.g),
word AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS at FROM hit),
hits AS (SELECT doc_id, count(*) AS n_hit FROM word GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hits ON hits.doc_id = doc.doc_id LEFT JOIN items ON items.doc_id = doc.doc_id
"""
