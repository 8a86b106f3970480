"""Helpers shared by the operators: table reads, bounded Arrow blocks, hashed folds and scratch tables."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import marquee.llm
from marquee.session import scratch_dir

# Executors get the package's functions by value, so they need no copy of this repository.
cloudpickle.register_pickle_by_value(marquee.llm)


class Shared:
    """A value sent once to every executor, with the code of its class: a plain broadcast names classes by module, which
    executors without this repository cannot import. ``get()`` gives a task its own copy."""

    def __init__(self, spark: SparkSession, value):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        return pickle.loads(self.sent.value)

    def drop(self) -> None:
        """Frees the copies on the executors; the driver's stays, for tasks that run again."""
        self.sent.unpersist()


#: Bytes of text that a Python task handles at once; only a single longer text exceeds it.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one table, read by Spark alone so that any store Spark knows will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def blocks(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches by rows so that each part holds at most ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, end - start)
            start = end


def column_list(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids fall into fold 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % F.lit(parts), F.lit(0)).cast("int")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write under the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_rows(docs: DataFrame, text_col: str, judge: Callable[[], Callable[[pa.RecordBatch, str], list[bool]]]) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that a judge keeps. ``judge()`` runs once a task and gives a
    function of (record batch, text column) to one boolean a row. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged = judge()
        for block in blocks(batches, text_col):
            yield block.filter(pa.array(judged(block, text_col), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


_CHUNK = 1 << 13


def vector_chunks(vector: np.ndarray) -> pa.RecordBatch:
    """The non-zero chunks of a task's counts as rows (chunk, counts)."""
    parts = [(k, vector[s : s + _CHUNK]) for k, s in enumerate(range(0, len(vector), _CHUNK))]
    parts = [(k, c.astype(np.int64).tobytes()) for k, c in parts if c.any()]
    return pa.RecordBatch.from_pydict({"chunk": pa.array([k for k, _ in parts], pa.int32()), "counts": pa.array([c for _, c in parts], pa.binary())})


def _add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(column_list(batch, "chunk"), column_list(batch, "counts")):
            counts = np.frombuffer(raw, np.int64)
            totals[k] = totals[k] + counts if k in totals else counts
    yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(totals), pa.int32()), "counts": pa.array([c.tobytes() for c in totals.values()], pa.binary())})


def summed_vector(chunks: DataFrame, size: int) -> np.ndarray:
    """Sum of the counts of all tasks: added up in Spark by chunk, one vector of a fixed size at the end."""
    out = np.zeros(size, np.int64)
    for r in chunks.repartition("chunk").mapInArrow(_add_chunks, "chunk int, counts binary").collect():
        part = np.frombuffer(r["counts"], np.int64)
        out[r["chunk"] * _CHUNK : r["chunk"] * _CHUNK + len(part)] = part
    return out
