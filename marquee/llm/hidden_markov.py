"""Op 12, scoring by a hidden Markov language model.

Words are counted over all training documents. A word with at least 1 / ``FREQUENT`` of all tokens is a symbol of its
own, the end of a text is one, and the other words share symbols by the hash of their last bytes. The hidden states give
out symbols; a word of a shared symbol has the chance of its smoothed count inside it, which leaves a share for unknown
words. So the tables of the states have a fixed size, whatever the vocabulary.

Baum-Welch: every task adds up the expected transitions and symbols of its documents (scaled forward and backward
recursions over many documents at once), the sums of all tasks give the next model. The training documents are dealt into
parts by hash; a step takes up the sums of one part anew and keeps those of the others (incremental EM, Neal and Hinton
1998), so a pass covers every training document once and betters the model after each part. The score of a text is its
exact log likelihood by the scaled forward recursion.

Word counts reach documents without sending the vocabulary to all tasks: chunks of documents name their distinct words,
the words meet their counts by a join, and the answers go back to the chunk.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import blocks, column_bytes, column_list, fold, table, written
from marquee.llm.token_align import from_planes, planes

#: Hidden states, most words with a symbol of their own, shared symbols, and last bytes of a word that choose one.
STATES, FREQUENT, SHARED, TAIL = 12, 2048, 2048, 3
#: Parts of the training documents, each with a step of its own, and passes over all of them.
PARTS, PASSES = 8, 2
#: Weight of the plain symbol shares in each state, and of an even share in transitions and first states, in tokens.
PRIOR, PRIOR_STEP = 20.0, 1.0
#: Bytes of text whose words are looked up together, distinct words that end a chunk early, and tokens worked on at once.
CHUNK_BYTES, CHUNK_WORDS, BLOCK_TOKENS = 32 << 20, 1 << 20, 1 << 19
#: Tokens from which a document waits for others as long, so that few documents never take a step alone.
LONG = 2048
#: Documents are learnt from if their fold of FOLDS is not HELD_OUT.
FOLDS, HELD_OUT = 7, 2

#: Words whose places go into one batch of document rows (a single longer document exceeds it).
BATCH_WORDS = 1 << 18

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
END = 0


def _give_back() -> None:
    """A Python worker serves later stages too: what a task has freed goes back to the system at its end, not on to them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


# the model -------------------------------------------------------------------------------------------


@dataclass
class Model:
    """Shares of first states, transitions (from, to) and symbols (symbol, state)."""

    first: np.ndarray
    step: np.ndarray
    emit: np.ndarray


@dataclass
class Sums:
    """Expected counts of first states, transitions and symbols, and the log likelihood (natural)."""

    first: np.ndarray
    step: np.ndarray
    emit: np.ndarray
    loss: float = 0.0

    def flat(self) -> np.ndarray:
        return np.concatenate([self.first, self.step.ravel(), self.emit.ravel(), [self.loss]])

    @classmethod
    def from_flat(cls, x: np.ndarray, states: int) -> Sums:
        k = states + states * states
        return cls(x[:states], x[states:k].reshape(states, states), x[k:-1].reshape(-1, states), float(x[-1]))


class _Steps:
    """Documents laid out by place: the first tokens of all documents, then the second ones, and so on. Longest first, so
    the documents that reach a place are the first ones."""

    def __init__(self, texts: list[np.ndarray]):
        sizes = np.array([len(t) for t in texts])
        self.turn = np.argsort(-sizes, kind="stable")
        sizes = sizes[self.turn]
        flat = np.concatenate([texts[k] for k in self.turn]).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        self.many = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), side="right")
        self.at = np.concatenate([[0], np.cumsum(self.many)])
        self.symbols = np.concatenate([flat[starts[:m] + t] for t, m in enumerate(self.many.tolist())])


def forward(model: Model, steps: _Steps, keep: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """The scale of each token (its chance after the ones before it), and the scaled state shares if kept."""
    scale = np.empty(len(steps.symbols))
    shares = np.empty((len(scale), len(model.first))) if keep else None
    now = None
    for t, m in enumerate(steps.many.tolist()):
        at = slice(steps.at[t], steps.at[t + 1])
        now = (model.first if t == 0 else now[:m] @ model.step) * model.emit[steps.symbols[at]]
        total = now.sum(axis=1)
        now /= total[:, None]
        scale[at] = total
        if keep:
            shares[at] = now
    return scale, shares


def log_likelihoods(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """log10 of the chance of each symbol sequence (none of them empty), summed over hidden states."""
    steps = _Steps(texts)
    scale, _ = forward(model, steps, False)
    logs, out = np.log10(scale), np.zeros(len(texts))
    for t, m in enumerate(steps.many.tolist()):
        out[steps.turn[:m]] += logs[steps.at[t] : steps.at[t + 1]]
    return out


def expected(model: Model, texts: list[np.ndarray]) -> Sums:
    """Forward and backward over some documents: the expected counts of Baum-Welch. The state shares are the only table of
    tokens by states; what a step needs of the symbols is looked up as it comes."""
    steps, states = _Steps(texts), len(model.first)
    scale, shares = forward(model, steps, True)
    between, back = np.zeros((states, states)), None
    for t in range(len(steps.many) - 1, -1, -1):
        at = slice(steps.at[t], steps.at[t + 1])
        m = int(steps.many[t])
        after = np.ones((m, states))
        if back is not None:
            more, then = len(back), slice(steps.at[t + 1], steps.at[t + 2])
            ahead = model.emit[steps.symbols[then]] / scale[then, None] * back
            between += shares[at][:more].T @ ahead
            after[:more] = ahead @ model.step.T
        back = after
        shares[at] *= back
    emit = np.stack([np.bincount(steps.symbols, shares[:, k], len(model.emit)) for k in range(states)], axis=1)
    return Sums(shares[: steps.many[0]].sum(axis=0), between * model.step, emit, float(np.log(scale).sum()))


def improved(sums: Sums, plain: np.ndarray) -> Model:
    """The next model; ``plain`` are the symbols' shares over all states, so no chance is ever zero."""
    states = len(sums.first)
    first = sums.first + PRIOR_STEP / states
    step = sums.step + PRIOR_STEP / states
    emit = sums.emit + PRIOR * plain[:, None]
    return Model(first / first.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def start(plain: np.ndarray, states: int) -> Model:
    """States that mostly stay as they are and differ by chance in their symbols."""
    rng = np.random.default_rng(0)
    emit = plain[:, None] * np.exp(rng.normal(0, 1, (len(plain), states)))
    step = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


def _batched(texts: Iterator, block_tokens: int) -> Iterator[list]:
    """Lists of (row, symbols) of about as many tokens; long documents wait for each other."""
    parts, sizes = ([], []), [0, 0]
    for row, symbols in texts:
        k = int(len(symbols) >= LONG)
        parts[k].append((row, symbols))
        sizes[k] += len(symbols)
        if sizes[k] >= block_tokens:
            yield parts[k][:]
            parts[k].clear()
            sizes[k] = 0
    yield from (p for p in parts if p)


# words and counts ------------------------------------------------------------------------------------

_CHUNK = T.StructType([
    T.StructField("chunk", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("learn", T.BooleanType()),
    T.StructField("words", T.BinaryType()),
    T.StructField("at", T.IntegerType()),
    T.StructField("word", T.StringType()),
    T.StructField("tail", T.IntegerType()),
    T.StructField("c", T.LongType()),
])


def tail_of(word: bytes, shared: int = SHARED) -> int:
    """The shared symbol of a word, by its last bytes."""
    return xxhash.xxh3_64_intdigest(word[-TAIL:]) % shared


def _chunk_batches(number: int, place: dict[bytes, int], rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Document rows, which name their words by place in the chunk's list, and a row for each distinct word with its
    training count. Frequent words come first, so most places are small numbers."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_CHUNK)

    def batch(n, columns):
        columns["chunk"] = pa.array(np.full(n, number))
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    counts = np.zeros(len(place), np.int64)
    for _, learn, places in rows:
        if learn:
            np.add.at(counts, places, 1)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order))
    ends, start = np.cumsum([len(places) for _, _, places in rows]), 0
    while start < len(rows):
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BATCH_WORDS, side="right")))
        own = rows[start:end]
        yield batch(len(own), {
            "doc_id": pa.array([d for d, _, _ in own], pa.int64()),
            "learn": pa.array([x for _, x, _ in own], pa.bool_()),
            "words": pa.array([planes(rank[places]) for _, _, places in own], pa.binary()),
        })
        start = end
    words = list(place)
    for k in range(0, len(words), 1 << 16):
        part = order[k : k + (1 << 16)].tolist()
        own = [words[i] for i in part]
        yield batch(len(own), {
            "at": pa.array(np.arange(k, k + len(own), dtype=np.int32)),
            "word": pa.array([w.decode("utf-8", "surrogatepass") for w in own], pa.string()),
            "tail": pa.array([tail_of(w) for w in own], pa.int32()),
            "c": pa.array(counts[part].astype(np.int64)),
        })


def _chunks(chunk_bytes: int, chunk_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        place: dict[bytes, int] = {}
        rows: list[tuple] = []
        for block in blocks(batches, "text"):
            for doc, learn, raw in zip(column_list(block, "doc_id"), column_list(block, "learn"), column_bytes(block, "text")):
                words = raw.translate(_LOWER).split()
                for w in set(words).difference(place):
                    place[w] = len(place)
                rows.append((doc, learn, np.array([place[w] for w in words], np.int32)))
                size += len(raw)
                if size >= chunk_bytes or len(place) >= chunk_words:
                    yield from _chunk_batches(number, place, rows)
                    number, size, place, rows = number + 1, 0, {}, []
        if rows:
            yield from _chunk_batches(number, place, rows)
            place, rows = {}, []
        _give_back()

    return run


_ENCODED = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("learn", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("n_known", T.LongType()),
    T.StructField("base_score", T.DoubleType()),
    T.StructField("inside", T.DoubleType()),
    T.StructField("symbols", T.BinaryType()),
])


def _encode(total: int, distinct: int, ends: int, of_symbol: np.ndarray):
    """Documents of one chunk with the counts and symbols of their words; ``of_symbol`` is what a count is divided by
    inside each symbol (0: it has one word only)."""

    def run(documents: pa.Table, words: pa.Table) -> pa.Table:
        count, symbol = np.zeros(words.num_rows, np.int64), np.zeros(words.num_rows, np.int64)
        at = words.column("at").to_numpy()
        count[at], symbol[at] = words.column("total").to_numpy(), words.column("symbol").to_numpy()
        base = np.log10((count + 1) / (total + distinct + 1))
        share = of_symbol[symbol]
        inside = np.where(share > 0, np.log10((count + 1) / np.maximum(share, 1)), 0.0)
        out = {name: [] for name in ("n_tokens", "n_known", "base_score", "inside", "symbols")}
        for batch in documents.select(["words"]).to_batches(max_chunksize=1024):
            for raw in column_list(batch, "words"):
                mine = from_planes(raw)
                out["n_tokens"].append(len(mine) + 1)
                out["n_known"].append(int((count[mine] > 0).sum()) + (ends > 0))
                out["base_score"].append(float(base[mine].sum() + np.log10((ends + 1) / (total + distinct + 1))))
                out["inside"].append(float(inside[mine].sum()))
                out["symbols"].append(np.append(symbol[mine], END).astype("<u2").tobytes())
        _give_back()
        kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "inside": pa.float64(), "symbols": pa.binary()}
        return pa.table({"doc_id": documents.column("doc_id"), "learn": documents.column("learn")} | {n: pa.array(x, kinds[n]) for n, x in out.items()})

    return run


def _symbols(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2")


_PART = 1 << 12


def _sums(model: Model, block_tokens: int):
    """Expected counts of a task's documents, in parts of a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        texts = ((None, _symbols(raw)) for batch in batches for raw in column_list(batch, "symbols"))
        for group in _batched(texts, block_tokens):
            found = expected(model, [s for _, s in group]).flat()
            total = found if total is None else total + found
        if total is not None:
            salt = TaskContext.get().partitionId() % 64
            parts = [total[k : k + _PART] for k in range(0, len(total), _PART)]
            yield pa.RecordBatch.from_pydict({"part": pa.array(range(len(parts)), pa.int32()), "salt": pa.array([salt] * len(parts), pa.int32()), "sums": pa.array([p.tobytes() for p in parts], pa.binary())})
        _give_back()

    return run


def _added_by(key: tuple[str, ...]):
    """Sums of the rows of equal keys, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(zip(*[column_list(batch, c) for c in key]), column_list(batch, "sums")):
                x = np.frombuffer(raw)
                totals[k] = totals[k] + x if k in totals else x
        keys = list(zip(*totals)) or [()] * len(key)
        yield pa.RecordBatch.from_pydict({c: pa.array(x, pa.int32()) for c, x in zip(key, keys)} | {"sums": pa.array([x.tobytes() for x in totals.values()], pa.binary())})

    return run


def _scores(model: Model, block_tokens: int):
    names = ["doc_id", "learn", "n_tokens", "n_known", "base_score", "inside"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((row[:-1], _symbols(row[-1])) for batch in batches for row in zip(*[column_list(batch, n) for n in (*names, "symbols")]))
        for group in _batched(rows, block_tokens):
            own = dict(zip(names, zip(*[row for row, _ in group])))
            score = log_likelihoods(model, [s for _, s in group]) + np.array(own["inside"])
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(own["doc_id"], pa.int64()),
                "held_out": pa.array([not x for x in own["learn"]], pa.bool_()),
                "n_tokens": pa.array(own["n_tokens"], pa.int64()),
                "n_known": pa.array(own["n_known"], pa.int64()),
                "base_score": pa.array(own["base_score"], pa.float64()),
                "score": pa.array(score, pa.float64()),
            })

    return run


_SCORED = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("held_out", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("n_known", T.LongType()),
    T.StructField("base_score", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
])


class LanguageModel:
    """A model of one frame of documents, learnt from the rows where ``learn_from`` holds; ``scores()`` covers all rows.

    A null text counts as empty: its only token is the end. Ids may be null or repeated, rows are documents of their own;
    other columns are not read. Without training rows all counts are 0 and the states say nothing.
    """

    def __init__(self, docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, passes: int = PASSES, chunk_bytes: int = CHUNK_BYTES, chunk_words: int = CHUNK_WORDS, block_tokens: int = BLOCK_TOKENS):
        self.spark, self.states, self.passes, self.block_tokens = docs.sparkSession, states, passes, block_tokens
        rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), F.coalesce(learn_from, F.lit(False)).alias("learn"))
        self.chunks = written(rows.mapInArrow(_chunks(chunk_bytes, chunk_words), _CHUNK), "markov-chunks")
        self.documents = self.chunks.where("at is null").select("chunk", "doc_id", "learn", "words")
        self.words = self.chunks.where("at is not null").select("chunk", "at", "word", "tail", "c")

    @cached_property
    def counts(self) -> DataFrame:
        """word, tail, total: training count of every word of the documents."""
        return written(self.words.groupBy("word", "tail").agg(F.sum("c").alias("total")), "markov-counts")

    @cached_property
    def totals(self) -> tuple[int, int, int]:
        """Training tokens, distinct training tokens, training documents (each has one end)."""
        words = self.counts.where("total > 0").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
        ends = self.documents.where("learn").count()
        return words["n"] + ends, words["v"] + (ends > 0), ends

    @cached_property
    def alphabet(self) -> tuple[DataFrame, np.ndarray, np.ndarray]:
        """(word, total, symbol) of every word; by symbol, its training count and what counts are divided by inside it."""
        total, _, ends = self.totals
        own = F.col("total") * FREQUENT >= F.lit(max(total, 1))
        frequent = sorted((-r["total"], r["word"]) for r in self.counts.where(own).select("word", "total").collect())  # at most FREQUENT by definition
        shared = self.counts.where(~own & (F.col("total") > 0)).groupBy("tail").agg(F.sum("total").alias("n"), F.count(F.lit(1)).alias("v")).collect()
        count, inside = np.zeros(1 + FREQUENT + SHARED, np.int64), np.zeros(1 + FREQUENT + SHARED)
        count[END] = ends
        count[1 : 1 + len(frequent)] = [-c for c, _ in frequent]
        inside[1 + FREQUENT :] = 1
        for r in shared:
            count[1 + FREQUENT + r["tail"]] = r["n"]
            inside[1 + FREQUENT + r["tail"]] = r["n"] + r["v"] + 1
        symbols = self.spark.createDataFrame([(w, k + 1) for k, (_, w) in enumerate(frequent)], "word string, symbol int")
        words = self.counts.join(F.broadcast(symbols), "word", "left").select("word", "total", F.coalesce("symbol", F.col("tail") + 1 + FREQUENT).alias("symbol"))
        return words, count, inside

    @cached_property
    def encoded(self) -> DataFrame:
        """Every document as symbols, with its counts and the share of its words inside their symbols (log10); written by
        ``part`` (-1: not learnt from), so that a step reads its own part only."""
        words, _, inside = self.alphabet
        total, distinct, ends = self.totals
        found = self.words.select(F.col("chunk").alias("of_chunk"), "at", "word").join(words, "word").select("of_chunk", "at", "total", "symbol")
        rows = self.documents.groupBy("chunk").cogroup(found.groupBy("of_chunk")).applyInArrow(_encode(total, distinct, ends, inside), _ENCODED)
        part = F.when(F.col("learn"), F.pmod(F.xxhash64("doc_id", "symbols"), F.lit(PARTS))).otherwise(-1).cast("int")
        return written(rows.withColumn("part", part), "markov-symbols", partition_by="part")

    @cached_property
    def model(self) -> Model:
        count = self.alphabet[1]
        plain = (count + 1) / (count.sum() + len(count))
        model = start(plain, self.states)
        sums: dict[int, np.ndarray] = {}  # of each part, as last taken up
        for turn in range(self.passes * PARTS if self.totals[2] else 0):
            found = self.expected(model, turn % PARTS)
            if found is not None:
                sums[turn % PARTS] = found.flat()
                model = improved(Sums.from_flat(np.sum(list(sums.values()), axis=0), self.states), plain)
        return model

    def expected(self, model: Model, part: int) -> Sums | None:
        """Expected counts of a part of the training documents (None: it has none): added up by task, then over all tasks, a
        fixed size in the end."""
        parts = self.encoded.where(F.col("part") == part).select("symbols").mapInArrow(_sums(model, self.block_tokens), "part int, salt int, sums binary")
        for key in (("part", "salt"), ("part",)):
            parts = parts.repartition(*key).mapInArrow(_added_by(key), ", ".join(f"{k} int" for k in key) + ", sums binary")
        rows = sorted(((r["part"], r["sums"]) for r in parts.collect()), key=lambda r: r[0])
        return Sums.from_flat(np.concatenate([np.frombuffer(raw) for _, raw in rows]), self.states) if rows else None

    def scores(self) -> DataFrame:
        """One row per input row: doc_id, held_out, n_tokens, n_known, base_score, score (log10)."""
        return self.encoded.mapInArrow(_scores(self.model, self.block_tokens), _SCORED)


def op12(spark, sf_dir: str) -> DataFrame:
    """Scores of every document by a model learnt from those that are not held out; see ``LanguageModel``."""
    found = LanguageModel(table(spark, sf_dir, "documents", "doc_id", "text"), fold("doc_id", FOLDS) != HELD_OUT)
    out = found.scores().withColumn("train_tokens", F.lit(found.totals[0]).cast("long"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
