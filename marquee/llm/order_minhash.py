"""Op 6, document fingerprints by Order MinHash.

Every k-mer of code points carries its occurrence number, so a text is a set of distinct (k-mer, number) pairs. Each
of the permutations picks the smallest ones, keeps them in text order and hashes the tuple: two signatures agree at a
place if the texts share the picked k-mers in the same order, which tracks the edit distance, not only the content.

The comparison with the next document needs neighbours by id: rows are dealt by ranges of the id and sorted, with the
first row of each range repeated at the end of the one before, so one shuffle of the rows serves and no range is long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import blocks, column_list, table

#: Code points of a k-mer, k-mers of a tuple, tuples of a fingerprint, k-mers handled at once.
KMER, TUPLE, SIGNATURES, STRIP = 12, 2, 64, 4096
#: Rows of a range of ids, about, and the most ranges.
RANGE_ROWS, MAX_RANGES = 1024, 20_000

_MULTIPLIERS = (np.random.default_rng(20).integers(0, 1 << 32, SIGNATURES, np.uint64) | np.uint64(1)).astype(np.uint32)
_TOP = np.uint32(0xFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def kmers(text: str) -> np.ndarray:
    """Hashes of the k-mers with their occurrence numbers, in text order; a short text is one k-mer."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if not len(codes):
        return codes
    size = min(KMER, len(codes))
    plain = np.zeros(len(codes) - size + 1, np.uint64)
    for k in range(size):
        plain = plain * np.uint64(0x5851F42D4C957F2D) + codes[k : len(codes) - size + 1 + k]
    plain = _mix(plain + np.uint64(size))
    ordered = np.sort(plain)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(again):
        at = np.flatnonzero(np.isin(plain, again))
        order = at[np.argsort(plain[at], kind="stable")]
        starts = np.concatenate([[True], plain[order][1:] != plain[order][:-1]])
        first = np.maximum.accumulate(np.where(starts, np.arange(len(order)), 0))
        number = (np.arange(len(order)) - first).astype(np.uint64)
        # number 0 hashes alike whether or not the k-mer comes again, so a hash depends on nothing further on in the text
        plain[order] = np.where(number > 0, _mix(plain[order] + number * np.uint64(0x9E3779B97F4A7C15)), plain[order])
    return plain


def smallest(hashes: np.ndarray, offset: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Under each permutation the TUPLE smallest values and their places (places from ``offset``), strip by strip."""
    values = np.full((SIGNATURES, 0), 0, np.uint64)
    places = np.zeros((SIGNATURES, 0), np.int64)
    rows = np.arange(SIGNATURES)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), STRIP):
        v = _MULTIPLIERS[:, None] * short[None, start : start + STRIP]
        for _ in range(min(TUPLE, v.shape[1])):
            at = v.argmin(axis=1)
            values = np.column_stack([values, v[rows, at].astype(np.uint64)])
            places = np.column_stack([places, at + start + offset])
            v[rows, at] = _TOP
        if values.shape[1] > 64 * TUPLE:
            values, places = _least(values, places)
    return _least(values, places)


def _least(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The TUPLE smallest of the candidates, equal values by place."""
    order = np.lexsort((places, values), axis=1)[:, :TUPLE]
    return np.take_along_axis(values, order, 1), np.take_along_axis(places, order, 1)


def signature(hashes: np.ndarray, picked: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Tuples in text order, hashed to 32 bits each."""
    places = np.sort(picked[1], axis=1)
    total = np.full(SIGNATURES, places.shape[1], np.uint64)
    for k in range(places.shape[1]):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[places[:, k]])
    return (total >> np.uint64(32)).astype(np.uint32)


def fingerprint(text: str) -> np.ndarray:
    hashes = kmers(text)
    return signature(hashes, smallest(hashes))


def fingerprints(text: str, edited: str, same: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of two texts whose first ``same`` code points are equal: their k-mers are searched once."""
    a, b = kmers(text), kmers(edited)
    shared = max(0, min(len(a), len(b), same - KMER + 1)) if same >= KMER else 0
    head = smallest(a[:shared])
    out = []
    for hashes in (a, b):
        tail = smallest(hashes[shared:], shared)
        out.append(signature(hashes, _least(np.column_stack([head[0], tail[0]]), np.column_stack([head[1], tail[1]]))))
    return out[0], out[1]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal signature places: an estimate between 0 and 1."""
    return float((a == b).mean())


def as_text(f: np.ndarray) -> str:
    return f.astype(">u4").tobytes().hex()


def order_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and fingerprint. Null text counts as empty; empty texts share one fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            yield pa.RecordBatch.from_pydict({"doc_id": block.column(0), "fingerprint": pa.array([as_text(fingerprint(t or "")) for t in column_list(block, "text")], pa.string())})

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


_NEIGHBOURS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])


def edited_with_next(text: str, following: str) -> tuple[str, int]:
    """The last quarter of the code points replaced by as many (or all) first ones of the next text; also how many
    code points stay."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut], len(text) - cut


_ARROW = pa.schema([
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and id. A row's edited form needs the next text, its last column the next fingerprint: at
    most two rows wait."""
    unread, unmatched = None, None  # (part, doc_id, text); (own fingerprint, finished columns)
    for block in blocks(batches, "text", 1 << 20):
        out = []
        for part, extra, doc_id, text in zip(*(column_list(block, c) for c in ("part", "extra", "doc_id", "text"))):
            text = text or ""
            if unread is not None and unread[0] == part:
                _, before_id, before = unread
                edited, same = edited_with_next(before, text)
                own, changed = fingerprints(before, edited, same)
                if unmatched is not None:
                    out.append((*unmatched[1], likeness(unmatched[0], own)))
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                unmatched = own, (before_id, len(before), digest, as_text(own), as_text(changed), likeness(own, changed))
                if extra:
                    out.append((*unmatched[1], likeness(own, fingerprint(text))))
                    unmatched = None
            unread = None if extra else (part, doc_id, text)
        yield pa.RecordBatch.from_pydict({f.name: [r[k] for r in out] for k, f in enumerate(_ARROW)}, schema=_ARROW)


def _part_of(cuts: list[int]):
    edges = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int32)
        out[known] = np.searchsorted(edges, ids[known].to_numpy(np.int64), side="left")
        return pd.Series(out)

    return part


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per input row: fingerprints of the text and of its edited form, and how like they are to each other and
    to the next document's (by ascending doc_id, the first after the last; null ids come first, equal ids by text).

    Null text counts as empty. A single document is its own next one.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    steps = min(MAX_RANGES, max(1, -(-rows.count() // range_rows)))
    cuts = sorted(set(rows.select(F.percentile_approx("doc_id", [k / steps for k in range(1, steps)], 100 * steps)).first()[0] or [])) if steps > 1 else []
    rows = rows.withColumn("part", _part_of(cuts)("doc_id"))
    heads = rows.groupBy("part").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("has_null")).orderBy("part").collect()
    if not heads:
        return spark.createDataFrame([], _NEIGHBOURS)
    # the first row of each range also ends the range before; one row a range, at most MAX_RANGES
    table_of = spark.createDataFrame(
        [(h["part"], None if h["has_null"] else h["least"], heads[k - 1]["part"]) for k, h in enumerate(heads)], "part int, least long, before int"
    )
    extra = (
        rows.join(F.broadcast(table_of), "part").where(F.col("doc_id").eqNullSafe(F.col("least")))
        .groupBy("before", "doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
        .select("doc_id", "text", F.col("before").alias("part"), F.lit(True).alias("extra"))
    )
    dealt = rows.withColumn("extra", F.lit(False)).unionByName(extra).repartition("part").sortWithinPartitions("part", "extra", F.col("doc_id").asc_nulls_first(), F.coalesce("text", F.lit("")))
    return dealt.select("part", "extra", "doc_id", "text").mapInArrow(_compare, _NEIGHBOURS)


def op6(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents", "doc_id", "text"))
