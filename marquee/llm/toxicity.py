"""Op 4, toxicity: a factorisation machine over hashed terms.

A document is the set of its hashed lower-cased words. Terms that separate the labels beyond chance, alone or in a pair,
get a weight and a short vector of factors; products of the vectors score pairs of terms, which single weights cannot (an
insult that is one only beside a mention of a group). A score is made of the weights and the factors alone. Learnt from a
bounded sample of labelled rows of which near copies are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import Shared, blocks, column_list, fold, keep_rows, table

#: Hash slots of terms, about how many labelled rows of each label are learnt from, terms that may get weights.
BITS, SAMPLE_TOXIC, SAMPLE_OTHER, MAX_TERMS, MIN_DOCS = 24, 4000, 8000, 1024, 3
#: Factors of a term, penalties of weights and factors, steps and their size.
FACTORS, L2_WEIGHT, L2_FACTOR, STEPS, RATE = 8, 0.00005, 0.0001, 400, 0.05
#: Labels are learnt from documents whose fold of FOLDS is not HELD_OUT.
FOLDS, HELD_OUT = 5, 0

_SPACED = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORDS_KEPT = 400_000


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACED).split()


def slot(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - BITS)


@dataclass
class Model:
    """``term``: hash slot to row of ``weights`` and ``factors``."""

    term: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, rows: list[int]) -> float:
        at = np.array(rows, np.int64)
        v = self.factors[at]
        total = v.sum(axis=0)
        x = self.bias + self.weights[at].sum() + 0.5 * float((total * total).sum() - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def score(self, text: str | None) -> float:
        """Every distinct word of the whole text takes part once."""
        known, term, rows = self.known, self.model.term, set()
        for w in set(words(text)):
            row = known.get(w)
            if row is None:
                row = term.get(slot(w), -1)
                if len(known) < _WORDS_KEPT:
                    known[w] = row
            if row >= 0:
                rows.add(row)
        return self.model.score(sorted(rows))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label, distinct term slots and three minimum hashes of five-word runs, to tell near copies."""
    for block in blocks(batches, "text"):
        slots, marks = [], []
        for text in column_list(block, "text"):
            found = words(text)
            slots.append(np.unique(np.array([slot(w) for w in set(found)], "<u4")).tobytes())
            runs = np.array([xxhash.xxh3_64_intdigest(b" ".join(found[k : k + 5])) for k in range(max(1, len(found) - 4))], np.uint64)
            marks.append([int((runs * np.uint64(m)).min() >> np.uint64(1)) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)])
        yield pa.RecordBatch.from_pydict({"toxic": block.column(block.schema.get_field_index("toxic")), "slots": pa.array(slots, pa.binary()), "marks": pa.array(marks, pa.list_(pa.int64()))})


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, sample: tuple[int, int] = (SAMPLE_TOXIC, SAMPLE_OTHER), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from labelled documents; ``learn_from`` is a condition on the id column of ``labels``.

    The labels are sampled first (about ``sample`` rows of label 1 and 0, by a hash of the id), so only their documents
    are read further; the sampled labels are bounded and go to every task. The bias is put right for the sampling.
    """
    known = labels.where(learn_from).select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("toxic")).where("id is not null and toxic in (0, 1)").distinct()
    n = {r["toxic"]: r["c"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("c")).collect()}
    share = {1: min(1.0, sample[0] / max(1, n.get(1, 0))), 0: min(1.0, sample[1] / max(1, n.get(0, 0)))}
    limit = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * (1 << 20)
    picked = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < limit)
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    rows = texts.join(F.broadcast(picked), "id").dropDuplicates(["id", "toxic"]).select("toxic", "text").mapInArrow(_features, "toxic int, slots binary, marks array<long>").collect()
    sets, y, seen = [], [], set()
    for r in sorted(rows, key=lambda r: (r["marks"], bytes(r["slots"]), r["toxic"])):
        if not seen.intersection(enumerate(r["marks"])):
            sets.append(np.frombuffer(bytes(r["slots"]), "<u4"))
            y.append(r["toxic"])
        seen.update(enumerate(r["marks"]))
    return fit(sets, np.array(y, np.float64), float(np.log(share[0] / share[1])))


def _ratio(both, with_a, with_b, n):
    """Log-likelihood ratio of the table of two marks on ``n`` rows: on both, on either, on none."""
    def part(k, total, p):
        e = total * p
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / np.maximum(e, 1e-9)), 0.0)

    p = with_b / n
    return 2 * (part(both, with_a, p) + part(with_a - both, with_a, 1 - p) + part(with_b - both, n - with_a, p) + part(n - with_a - with_b + both, n - with_a, 1 - p))


def _chosen(sets: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Terms whose log-likelihood ratio with the label, alone or in a pair, is beyond what the best of as many chance
    terms or pairs would reach."""
    flat, of = np.concatenate(sets), np.repeat(y, [len(s) for s in sets])
    terms, at = np.unique(flat, return_inverse=True)
    with_term, toxic = np.bincount(at), np.bincount(at, weights=of)
    n, n1 = len(y), y.sum()
    bound = 2 * np.log(max(2, (with_term >= MIN_DOCS).sum())) + 4
    alone = _ratio(toxic, with_term, n1, n)
    alone[(with_term < MIN_DOCS) | (alone < bound)] = 0
    ratio, pairs = _telling_pairs(sets, y, terms, with_term, toxic, bound)
    g = alone.copy()
    for column in pairs.T:
        np.maximum.at(g, column, ratio)
    order = np.lexsort((terms, -g))
    return terms[order[g[order] > 0][:MAX_TERMS]]


def _telling_pairs(sets: list[np.ndarray], y: np.ndarray, terms: np.ndarray, with_term: np.ndarray, toxic: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Ratios of the pairs of terms beyond chance, and the pairs as two columns of places in ``terms``.

    A pair tells what its second term adds among the rows of the first, or the other way round, whichever is less: a
    neutral term beside a telling one adds nothing. Pairs count that come together often enough to reach the bound, and
    the bound grows with their number. Pairs are counted term by term from the rows that have it, so a pair costs only
    where it occurs.
    """
    per_row = 2 * np.log(len(y) / min(y.sum(), len(y) - y.sum()))  # most that a row of the rarer label can add
    fewest = max(MIN_DOCS, int(np.ceil(bound / per_row)))
    often = np.flatnonzero(with_term >= fewest)
    if len(often) < 2:
        return np.zeros(0), np.zeros((0, 2), np.int64)
    place = np.full(len(terms), -1, np.int64)
    place[often] = np.arange(len(often))
    # toxic rows first, so that one cut of a term's rows parts the labels
    turn = np.argsort(-y, kind="stable")
    rows = [r[r >= 0] for r in (place[np.searchsorted(terms, sets[k])] for k in turn)]
    n1, sizes = int(y.sum()), np.array([len(r) for r in rows])
    of_row, of_term = np.repeat(np.arange(len(rows)), sizes), np.concatenate(rows)
    by_term = of_row[np.argsort(of_term, kind="stable")]
    ends = np.cumsum(with_term[often])
    c, t = with_term[often], toxic[often]
    together = np.zeros(len(y) + 1, np.int64)
    found = []  # (ratio, rows together, a, b)
    for a in range(len(often) - 1):
        mine = by_term[ends[a] - c[a] : ends[a]]
        cut = np.searchsorted(mine, n1)
        count = lambda ks: np.bincount(np.concatenate([rows[k] for k in ks]), minlength=len(often))[a + 1 :] if len(ks) else np.zeros(len(often) - a - 1, np.int64)
        ones = count(mine[:cut])
        both = ones + count(mine[cut:])
        b = np.flatnonzero(both >= fewest)
        both, ones, b = both[b], ones[b], b + a + 1
        together += np.bincount(both, minlength=len(together))
        ratio = np.minimum(_ratio(ones, both, t[a], c[a]), _ratio(ones, both, t[b], c[b]))
        ok = ratio >= bound
        found.append((ratio[ok], both[ok], np.full(ok.sum(), a), b[ok]))
    ratio, both, a, b = (np.concatenate(x) for x in zip(*found))
    # the least number of rows whose pairs could still reach the bound for as many pairs
    as_often = np.cumsum(together[::-1])[::-1]
    limits = 2 * np.log(np.maximum(as_often, 2)) + 4
    least = int(np.argmax(np.arange(len(limits)) * per_row >= limits))
    ok = (both >= least) & (ratio >= max(bound, limits[least]))
    return ratio[ok], often[np.column_stack([a[ok], b[ok]])]


def gradients(x: np.ndarray, y: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Of the mean log loss of the machine, with its penalties, by bias, weights and factors. ``x`` is 0 or 1."""
    xv = x @ v
    score = bias + x @ w + 0.5 * ((xv * xv).sum(axis=1) - x @ (v * v).sum(axis=1))
    error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - y) / len(y)
    ex, n = x.T @ error, max(1, len(w))
    return error.sum(), ex + L2_WEIGHT * w / n, x.T @ (error[:, None] * xv) - ex[:, None] * v + L2_FACTOR * v / n


def fit(sets: list[np.ndarray], y: np.ndarray, bias_shift: float = 0.0) -> Model:
    """Full-batch gradient steps with per-weight step sizes on the log loss of the machine."""
    if not len(y) or y.min() == y.max():
        constant = 0.0 if not len(y) else 4.0 * (2 * float(y[0]) - 1)
        return Model({}, constant, np.zeros(0), np.zeros((0, FACTORS)))
    terms = _chosen(sets, y)
    row = {int(t): k for k, t in enumerate(terms)}
    x = np.zeros((len(y), len(terms)), np.float32)
    for k, s in enumerate(sets):
        for t in s.tolist():
            if t in row:
                x[k, row[t]] = 1.0
    rng = np.random.default_rng(0)
    # start where each term alone, and their absence, score what the rows say; the steps fit them together
    log_odds = lambda ones, all_rows: np.log((ones + 0.5) / (all_rows - ones + 0.5))
    bare = x.sum(axis=1) == 0
    start = log_odds(y[bare].sum(), bare.sum())
    parts = [np.array([start]), log_odds(x.T @ y, x.sum(axis=0)) - start, rng.normal(0, 0.1, (len(terms), FACTORS))]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for t in range(1, STEPS + 1):
        for k, g in enumerate(gradients(x, y, *parts)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            parts[k] = parts[k] - RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return Model(row, float(parts[0][0]) - bias_shift, parts[1], parts[2])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (1 from 0.5 on). Null and empty texts have no terms and
    score as the bias says. Repeated rows score alike; ids may be null; other columns are not read."""
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.get())
        for block in blocks(batches, "text"):
            scores = [scorer.score(t) for t in column_list(block, "text")]
            yield pa.RecordBatch.from_pydict({"doc_id": block.column(0), "score": pa.array(scores, pa.float64()), "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32())})

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def keep_harmless(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents, all columns and rows as they are, that the model scores below 0.5. Null and empty texts score as the
    bias says, so they stay unless most documents are toxic."""
    shared = Shared(docs.sparkSession, model)

    def judge():
        scorer = Scorer(shared.get())
        return lambda block, column: [scorer.score(t) < 0.5 for t in column_list(block, column)]

    return keep_rows(docs, text_col, judge)


def op4(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), fold("doc_id", FOLDS) != HELD_OUT)
    return predict(docs, model).select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")
