"""The interaction table kept up to date as rating and tag files arrive.

The state has one row per (user, movie): the place of its latest record and the rating there. It lies in buckets by user; a
batch merges its records into the buckets it touches and writes those anew, the others stay as they are. A manifest names
the folder of every bucket and the last batch of every source, and is committed last, by a rename: a batch that fails
halfway changes nothing, a batch that comes again is known by its number, and a reader sees whole batches only. Merging
keeps the greatest place, so neither the order of batches nor late records matter.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators.model import keyed_records, latest_of_pairs
from marquee.sinks import commit_manifest, read_manifest, snapshot_version
from marquee.streaming.ingest import clean_stream

STATE = "userId int, movieId int, place decimal(35,6), rating float"
_RATINGS, _TAGS = "userId int, movieId int, rating float, timestamp string, watching_date string", "userId int, movieId int, tag string"


class InteractionStore:
    """The state under ``base_path``; ``buckets`` is fixed by the first batch (some per core of the cluster that writes)."""

    def __init__(self, spark: SparkSession, base_path: str, buckets: int = 64):
        self.spark, self.base, self.buckets = spark, base_path.rstrip("/"), buckets

    def _manifest(self) -> tuple[int, dict]:
        number = snapshot_version(self.spark, self.base)
        return number, read_manifest(self.spark, self.base, number) if number else {"buckets": self.buckets, "batches": {}, "folders": {}}

    def _state(self, folders: dict[str, str]) -> DataFrame:
        paths = [f"{self.base}/{f}" for f in folders.values()]
        return self.spark.read.schema(STATE).parquet(*paths) if paths else self.spark.createDataFrame([], STATE)

    def apply(self, source: str, batch_id: int, ratings: DataFrame | None = None, tags: DataFrame | None = None) -> bool:
        """Merge one batch of cleaned records of a source (any name; its batches are numbered). False if that batch, or a
        later one, was merged before. Two sources may write at once: the slower one merges again on top of the other."""
        none = lambda schema: self.spark.createDataFrame([], schema)
        records = latest_of_pairs(keyed_records(ratings if ratings is not None else none(_RATINGS), tags if tags is not None else none(_TAGS)))
        while True:
            number, manifest = self._manifest()
            if manifest["batches"].get(source, -1) >= batch_id:
                return False
            bucket = F.pmod(F.hash("userId"), F.lit(manifest["buckets"]))
            touched = [str(r["bucket"]) for r in records.select(bucket.alias("bucket")).distinct().collect()]  # at most the number of buckets
            folders, version = dict(manifest["folders"]), f"data/{uuid.uuid4().hex}"
            if touched:
                old = self._state({b: folders[b] for b in touched if b in folders})
                merged = latest_of_pairs(old.unionByName(records)).withColumn("bucket", bucket)
                merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.base}/{version}")
                folders |= {b: f"{version}/bucket={b}" for b in touched}
            batches = manifest["batches"] | {source: batch_id}
            if commit_manifest(self.spark, self.base, {"buckets": manifest["buckets"], "batches": batches, "folders": folders}, number + 1):
                return True

    def interactions(self) -> DataFrame:
        """``userId, movieId, rating`` of all batches so far, as ``operators.model.interactions`` gives them."""
        return self._state(self._manifest()[1]["folders"]).select("userId", "movieId", "rating")


def upsert_stream(store: InteractionStore, source_path: str, table: str, checkpoint_path: str, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Merge the CSV files of a folder (``ratings`` or ``tags``) into a store, batch by batch, until none is left. The
    checkpoint belongs to the store and the folder; a batch that is run again after a failure is merged once."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        store.apply(f"{table}:{source_path}", batch_id, **{table: batch})

    stream = clean_stream(store.spark, source_path, table, max_files_per_trigger)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
