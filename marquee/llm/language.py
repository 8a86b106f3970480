"""Op 2, language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams of the lower-cased text (runs of non-letters are one space) are hashed; document frequencies
are counted over all training documents. The weights are learnt with follow-the-regularised-leader under L1 and L2
penalties from a bounded sample per language, and a temperature is fitted on the part of the sample kept apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import Shared, blocks, column_list, fold, keep_rows, summed_vector, table, vector_chunks

#: Hashed features, n-gram sizes, and about how many documents of each language the weights are learnt from.
BITS, SIZES, SAMPLE_PER_LANGUAGE = 15, (1, 2, 3), 600
#: Learner: step size, smoothing, L1 and L2 penalties, passes; every FIT_PART-th sample row goes to the temperature.
ALPHA, BETA, L1, L2, PASSES, FIT_PART = 1.0, 1.0, 0.02, 0.05, 4, 4
#: Languages are learnt from documents whose fold of FOLDS is not HELD_OUT.
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
#: A text is kept while its best language stands clearly above guessing: this many times an even share.
ABOVE_EVEN_SHARE = 1.4
#: Evidence that a text is in a learned language at all: its n-grams may be rarer than those of any sample row kept apart by
#: this share of how far those rows reach above their median. Short texts count as if they had so many usual n-grams more.
RARER, USUAL_NGRAMS = 0.6, 20


class NgramCounter:
    """Counts of hashed character n-grams of a text."""

    def __init__(self):
        self.letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers (rising) and their counts; both empty for a text without letters."""
        codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = self.letter[codes]
        if not letters.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes = np.where(letters, codes, 32)
        codes = codes[(codes != 32) | np.concatenate([[True], codes[:-1] != 32])]
        codes = np.concatenate([[32], codes, [32]]).astype(np.uint64)
        found, rolling = [], np.zeros(len(codes), np.uint64)
        for n in range(1, max(SIZES) + 1):
            rolling = rolling[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
            if n in SIZES:
                found.append((rolling * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
        total = np.bincount(np.concatenate(found).astype(np.int64), minlength=1 << BITS)
        at = np.flatnonzero(total)
        return at, total[at]


def _weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return (x / np.sqrt((x * x).sum() or 1.0)).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    usual: float = 0.0
    rarest: float = np.inf

    def rarity(self, at: np.ndarray, counts: np.ndarray) -> float:
        """Mean inverse document frequency of a text's n-grams: low where the training documents share them."""
        return float(((counts * self.idf[at]).sum() + USUAL_NGRAMS * self.usual) / (counts.sum() + USUAL_NGRAMS))

    def identified(self, counter: NgramCounter, text: str | None, min_score: float, languages: frozenset[str] | None) -> bool:
        """Whether a text is in a learned language (one of ``languages``, if given): its n-grams are as usual there as
        those of known rows, and the model does better than guess."""
        at, counts = counter.counts(text)
        if not len(at) or not self.languages or self.rarity(at, counts) > self.rarest:
            return False
        language, score = self._best(at, counts)
        return score >= min_score and (languages is None or language in languages)

    def _best(self, at: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        p = _softmax(_weighted(at, counts, self.idf) @ self.weights[at] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])

    def predict(self, counter: NgramCounter, text: str | None) -> tuple[str, float]:
        at, counts = counter.counts(text)
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        return self._best(at, counts)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def learn_weights(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], n_languages: int) -> np.ndarray:
    """Follow the regularised leader, one example at a time, over classes at once."""
    z, n = np.zeros((1 << BITS, n_languages)), np.zeros((1 << BITS, n_languages))

    def current(at):
        zs = z[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for turn in range(PASSES):
        for k in np.random.default_rng(turn).permutation(len(rows)):
            at, x = rows[k]
            w = current(at)
            error = _softmax(x @ w)
            error[labels[k]] -= 1.0
            g = x[:, None] * error[None, :]
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return current(slice(None)).astype(np.float32)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm; 1 without rows."""
    if not len(labels):
        return 1.0

    def loss(t):
        return -np.log(np.maximum(_softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean() + 1e-4 * t * t

    low, high, g = -4.0, 4.0, (5**0.5 - 1) / 2
    a, b = high - g * (high - low), low + g * (high - low)
    for _ in range(40):
        if loss(a) <= loss(b):
            high, b = b, a
            a = high - g * (high - low)
        else:
            low, a = a, b
            b = low + g * (high - low)
    return float(np.exp((low + high) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents by feature, with the number of documents in the slot after the last feature."""
    counter, seen = NgramCounter(), np.zeros((1 << BITS) + 1, np.int64)
    for block in blocks(batches, "text"):
        for text in column_list(block, "text"):
            at, _ = counter.counts(text)
            if len(at):
                seen[at] += 1
                seen[-1] += 1
    yield vector_chunks(seen)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = NgramCounter()
    for block in blocks(batches, "text"):
        rows = [counter.counts(t) for t in column_list(block, "text")]
        yield pa.RecordBatch.from_pydict({
            "lang": block.column(block.schema.get_field_index("lang")),
            "at": pa.array([at.astype("<u4").tobytes() for at, _ in rows], pa.binary()),
            "counts": pa.array([c.astype("<u4").tobytes() for _, c in rows], pa.binary()),
        })


def train(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from the rows where ``learn_from`` holds and text and language are known.

    Document frequencies cover all of them. The weights see about ``sample`` documents of each language, picked by a
    hash and without repeated rows, so a language with few documents is learnt from all of them.
    """
    rows = docs.where(learn_from).select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang")).where("text is not null and lang is not null")
    seen = summed_vector(rows.select("text").mapInArrow(_frequencies, "chunk int, counts binary"), (1 << BITS) + 1)
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1.0
    sizes = {r["lang"]: r["c"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).collect()}
    if not sizes:
        return Model([], idf, np.zeros((1 << BITS, 0), np.float32), 1.0)
    share = F.element_at(F.create_map(*[F.lit(v) for lang, c in sizes.items() for v in (lang, min(1.0, sample / c))]), F.col("lang"))
    picked = rows.withColumn("h", F.xxhash64("id", "text", "lang")).where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).dropDuplicates(["h"])
    languages = sorted(sizes)
    found = sorted((r["lang"], bytes(r["at"]), bytes(r["counts"])) for r in picked.select("lang", "text").mapInArrow(_vectors, "lang string, at binary, counts binary").collect())
    vectors, labels, raw = [], [], []
    for lang, at, counts in found:
        if at:
            places = np.frombuffer(at, "<u4").astype(np.int64)
            raw.append((places, np.frombuffer(counts, "<u4").astype(np.int64)))
            vectors.append((places, _weighted(*raw[-1], idf)))
            labels.append(languages.index(lang))
    apart = [k % FIT_PART == FIT_PART - 1 for k in range(len(vectors))]
    weights = learn_weights([v for v, x in zip(vectors, apart) if not x], [y for y, x in zip(labels, apart) if not x], len(languages))
    logits = np.array([x @ weights[at] for (at, x), kept in zip(vectors, apart) if kept]).reshape(-1, len(languages))
    model = Model(languages, idf.astype(np.float32), weights, fit_temperature(logits, np.array([y for y, x in zip(labels, apart) if x], np.int64)))
    held = [r for r, kept in zip(raw, apart) if kept]
    if held:
        model.usual = float(np.median([(n * model.idf[at]).sum() / n.sum() for at, n in held]))
        rare = [model.rarity(at, n) for at, n in held]
        model.rarest = max(rare) + RARER * (max(rare) - model.usual)
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (the calibrated probability; of equal ones the first name in order).

    A null text or one without letters gets ``und`` with score 0, as does any text if nothing could be learnt. Repeated
    rows are judged alike; ids may be null; other columns are not read.
    """
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, model = NgramCounter(), shared.get()
        for block in blocks(batches, "text"):
            found = [model.predict(counter, t) for t in column_list(block, "text")]
            yield pa.RecordBatch.from_pydict({"doc_id": block.column(0), "lang_pred": pa.array([x for x, _ in found], pa.string()), "score": pa.array([s for _, s in found], pa.float64())})

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def keep_identified(docs: DataFrame, model: Model, min_score: float | None = None, text_col: str = "text", languages: Iterable[str] | None = None) -> DataFrame:
    """The documents, all columns and rows as they are, that are in a learned language (one of ``languages``, if given).

    A text goes if it is null or has no letter, if its n-grams are rarer than those of known rows can be (another language,
    code, random letters), or if its best language has less than ``min_score``; by default ``ABOVE_EVEN_SHARE`` times the
    even share of the learned languages (at most one half), so short clean texts stay. Without learned languages all go.
    """
    shared = Shared(docs.sparkSession, model)
    if min_score is None:
        min_score = min(0.5, ABOVE_EVEN_SHARE / max(1, len(model.languages)))
    wanted = None if languages is None else frozenset(languages)

    def judge():
        counter, model = NgramCounter(), shared.get()
        return lambda block, column: [model.identified(counter, t, min_score, wanted) for t in column_list(block, column)]

    return keep_rows(docs, text_col, judge)


def op2(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    return predict(docs, train(docs, ~held_out)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
