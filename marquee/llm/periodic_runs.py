"""Op 13, periodic runs of words by multi-scale minimizers.

A run is a stretch of words in which words one period apart are the same, as long as it can be, of at least
``MIN_WORDS`` words and ``MIN_TIMES`` periods. Periods too short for sampling are found by comparing each word with the
one a lag away. Longer ones fall into scales [P, 3P/2): at each scale the word tuples of nearly 3P/2 words are hashed and
the smallest hash of each window is kept. A run holds two windows one period apart with the same words, so the same
tuple is kept at both, and no place between them has that tuple (it is longer than the period). Neighbouring
equal minimizers at a distance of the scale are thus seeds of every run of the scale; each is extended word by word.

A block of documents is worked on as one array, with a word of its own between two documents. Row by row: no shuffle.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import blocks, column_bytes, column_list, table

#: Least words and least periods of a run, and the longest period that is looked for lag by lag.
MIN_WORDS, MIN_TIMES, SHORT = 24, 3, 8


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _window(x: np.ndarray, w: int, best: np.ufunc) -> np.ndarray:
    """``best`` of every ``w`` neighbours, by running values from the borders of parts of ``w`` both ways."""
    n = len(x)
    fill = x[-1] if n else 0
    parts = np.concatenate([x, np.full(-n % w, fill, x.dtype)]).reshape(-1, w)
    ahead = best.accumulate(parts, axis=1).ravel()[:n]
    back = best.accumulate(parts[:, ::-1], axis=1)[:, ::-1].ravel()[:n]
    return best(back[: n - w + 1], ahead[w - 1 :])


def minimizers(x: np.ndarray, w: int) -> np.ndarray:
    """Places whose value is the smallest of some window of ``w`` neighbours; all places with that value count."""
    if len(x) < w:
        return np.zeros(0, np.int64)
    least = _window(x, w, np.minimum)
    top = np.zeros(w - 1, x.dtype)
    return np.flatnonzero(_window(np.concatenate([top, least, top]), w, np.maximum) == x)


def tuple_hashes(words: np.ndarray, sizes: list[int]) -> Iterator[np.ndarray]:
    """For each of the rising sizes, a hash of the ``size`` words from every place on (as far as they reach)."""
    level, width = _mixed(words.astype(np.uint64) + np.uint64(1)), 1
    for size in sizes:
        while 2 * width <= size:
            level, width = _joined(level[:-width], level[width:]), 2 * width
        n = len(words) - size + 1
        yield _joined(level[:n], level[size - width : size - width + n]) if size > width else level[:n]


def _same(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on, in steps of 1 or -1, hold the same word as the place ``lag`` behind them."""
    count, size = 0, 64
    while True:
        if step > 0:
            x, y = words[at + count : at + count + size], words[at + count + lag : at + count + lag + size]
            x = x[: len(y)]
        else:
            low = max(0, at - count - size + 1)
            x, y = words[low : at - count + 1][::-1], words[low + lag : at - count + 1 + lag][::-1]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return count + int(differ[0])
        count += len(x)
        if len(x) < size:
            return count
        size *= 2


def runs_of(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs of many documents: rows (start, length, period), by start and period.

    ``words`` are the numbers of all words, one document after the other, each followed by a number that occurs once;
    ``sizes`` the words of each document. Starts count in ``words``.
    """
    found: dict[tuple[int, int], int] = {}  # a run is named by its ends; the smallest lag that fits is its period

    def keep(start: int, length: int, lag: int) -> None:
        if length >= max(MIN_WORDS, MIN_TIMES * lag):
            found[start, length] = min(lag, found.get((start, length), lag))

    for lag in range(1, SHORT + 1):
        same = np.concatenate([[False], words[:-lag] == words[lag:], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = turns[::2], turns[1::2]
        for k in np.flatnonzero(ends - starts + lag >= max(MIN_WORDS, MIN_TIMES * lag)):
            keep(int(starts[k]), int(ends[k] - starts[k]) + lag, lag)
    scales, period = [], SHORT + 1
    while MIN_TIMES * period <= sizes.max(initial=0):
        scales.append((period, max(period, (3 * period - 1) // 2)))  # smallest and largest period of the scale
        period = scales[-1][1] + 1
    spans = np.column_stack([np.cumsum(sizes + 1) - sizes - 1, sizes + 1])
    while scales:
        # documents too short for a scale are too short for all that follow
        spans = spans[spans[:, 1] > MIN_TIMES * scales[0][0]]
        few = [s for s in scales if s[0] < 4 * scales[0][0]]
        scales = scales[len(few) :]
        place = np.repeat(spans[:, 0] - (np.cumsum(spans[:, 1]) - spans[:, 1]), spans[:, 1]) + np.arange(spans[:, 1].sum())
        part = words[place]
        for (low, high), hashes in zip(few, tuple_hashes(part, [high for _, high in few])):
            # a tuple and a window of them span at most two of the smallest periods
            at = minimizers(hashes, 2 * low - high + 1)
            order = np.argsort(hashes[at], kind="stable")
            at, value = at[order], hashes[at][order]
            lags = at[1:] - at[:-1]
            seeds = np.flatnonzero((value[1:] == value[:-1]) & (lags >= low) & (lags <= high))
            done: dict[int, int] = {}  # by lag: up to where its last stretch goes
            for k in seeds[np.argsort(at[seeds], kind="stable")]:
                a, lag = int(at[k]), int(lags[k])
                if done.get(lag, -1) > a:
                    continue
                ahead = _same(part, a, lag, 1)
                start = a - _same(part, a - 1, lag, -1) if a else 0
                done[lag] = max(a + 1, a + ahead)
                keep(int(place[start]), a + ahead - start + lag, lag)
    return np.array(sorted((s, n, q) for (s, n), q in found.items()), np.int64).reshape(-1, 3)


def collapsed_places(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first period only; starts count from 0."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def _ahead(a, b) -> int:
    """Order of runs: greatest length / period first, then smallest start, then period. Exact, in integers."""
    return int(b[1]) * int(a[2]) - int(a[1]) * int(b[2]) or int(a[0] - b[0]) or int(a[2] - b[2])


Edit = Callable[[int | None, int], "np.ndarray | None"]

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
    T.StructField("top", T.IntegerType()),
    T.StructField("collapsed", T.StringType()),
    T.StructField("runs_sha256", T.StringType()),
    T.StructField("collapsed_sha256", T.StringType()),
])


def _scan(edit: Edit | None, schema: T.StructType):
    with_text = "collapsed" in schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            ids, texts = column_list(block, "doc_id"), [t.split() for t in column_bytes(block, "text")]
            if edit is not None:
                places = [edit(doc, len(words)) for doc, words in zip(ids, texts)]
                texts = [words if p is None else [words[k] for k in p.tolist()] for words, p in zip(texts, places)]
            number = {w: k for k, w in enumerate(set().union(*texts))}
            sizes = np.array([len(words) for words in texts], np.int64)
            starts = np.cumsum(sizes + 1) - sizes - 1
            flat = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
            for k, words in enumerate(texts):
                flat[starts[k] : starts[k] + sizes[k]] = [number[w] for w in words]
                flat[starts[k] + sizes[k]] = len(number) + k
            found = runs_of(flat, sizes)
            cuts = np.searchsorted(found[:, 0], np.append(starts, len(flat)))
            runs, tops, kept, digests, text_digests = [], [], [], [], []
            for k, words in enumerate(texts):
                own = found[cuts[k] : cuts[k + 1]] - np.array([starts[k], 0, 0])
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own.tolist()])
                tops.append(min(range(len(own)), key=cmp_to_key(lambda a, b: _ahead(own[a], own[b])), default=None))
                if len(own):
                    words = [words[i] for i in np.flatnonzero(collapsed_places(len(words), own)).tolist()]
                text = b" ".join(words)
                if with_text:
                    kept.append(text.decode("utf-8", "surrogatepass"))
                digests.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in own.tolist()).encode()).hexdigest())
                text_digests.append(hashlib.sha256(text).hexdigest())
            columns = {"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(sizes), "runs": pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), "top": pa.array(tops, pa.int32())}
            if with_text:
                columns["collapsed"] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_pydict(columns | {"runs_sha256": pa.array(digests), "collapsed_sha256": pa.array(text_digests)})

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: Edit | None = None, with_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period; by start, then period), top (place in
    ``runs`` of the one with most periods, ties to the smallest start, then period; null without runs), collapsed (the
    text with the first period of each run only, words joined by one space; if ``with_text``), and digests.

    Words are cut at ASCII white space. A null or empty text, or one without words, has no runs and collapses to nothing.
    Rows are independent: ids may be null or repeated, other columns are not read. ``edit(doc_id, n_words)`` may name,
    for each place of a text, the word that stands there instead (null: the text as it is).
    """
    schema = SCHEMA if with_text else T.StructType([f for f in SCHEMA if f.name != "collapsed"])
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(_scan(edit, schema), schema)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The query's own edit: every tenth document, by a checksum of its id, repeats a stretch of its words up to its end.
    A null id is left as it is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def op13(spark, sf_dir: str) -> DataFrame:
    """Runs of every document, with the edit of ``planted``; see ``periodic_runs``."""
    found = periodic_runs(table(spark, sf_dir, "documents", "doc_id", "text"), edit=planted, with_text=False)
    top = F.get("runs", F.col("top"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        "runs_sha256",
        "collapsed_sha256",
    ).withColumn("exponent_milli", F.expr("(1000 * length) div period"))
