"""Writers: CSV (with header) and Parquet, always distributed.

Nothing is collected to the driver and nothing is squeezed into one task: a summary is written as ordered part
files (a sort before the write range-partitions the rows, so part-00000, part-00001, ... read back in order).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from marquee.schemas import CSV_OPTIONS


def save_as_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One frame as CSV with a header. Outer spaces, quotes, empty text and nulls read back unchanged by ``read_csv``
    (text with line feeds too, with its ``multi_line``)."""
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "mode"}
    df.write.mode(mode).options(**options).csv(path)


def read_csv(spark: SparkSession, path: str, schema, multi_line: bool = False) -> DataFrame:
    """A folder that ``save_as_csv`` wrote. ``multi_line`` is needed if some text holds line feeds; it keeps a file in
    one task."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", multi_line).csv(path)


def save_tables(tables: Mapping[str, DataFrame], base_path: str, fmt: str = "parquet", mode: str = "overwrite") -> dict[str, str]:
    """Write named frames under ``base_path/<name>``; returns the path of each."""
    paths = {}
    for name, df in tables.items():
        path = f"{base_path.rstrip('/')}/{name}"
        if fmt == "csv":
            save_as_csv(df, path, mode)
        else:
            df.write.mode(mode).format(fmt).save(path)
        paths[name] = path
    return paths


def save_by_id(df: DataFrame, path: str, key: str, *then: str, files: int | None = None, mode: str = "overwrite") -> str:
    """A table laid out for lookups of one id: rows sorted by ``key`` (then by other columns) over all files, so a filter on
    the id reads the few row groups and pages that span it, with a Parquet bloom filter on the key, so a file without
    the id is not read at all. An id of very many rows spans several files if ``then`` names further columns."""
    parts = [files] if files else []
    rows = df.repartitionByRange(*parts, key, *then).sortWithinPartitions(key, *then)
    # a column chunk that is all dictionary gets no bloom filter
    options = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.enable.dictionary#{key}": "false"}
    rows.write.mode(mode).options(**options).parquet(path)
    return path


def export_summaries(summaries: Mapping[str, DataFrame], base_path: str) -> dict[str, str]:
    """Each summary to its own CSV folder. Frames keep the order they were given (their own ``orderBy``)."""
    return save_tables(summaries, base_path, fmt="csv")


_MANIFESTS = "_manifests"


def save_snapshot(tables: Mapping[str, DataFrame], base_path: str) -> int:
    """Write named frames as one new version under ``base_path`` and return its number, from 1.

    Every version has folders of its own, and its manifest (which folder holds which table) comes last, by a rename to the
    next free number. So a reader sees the tables of one version, whole, or the version before; a write that fails
    leaves folders that no manifest names. Two writers at once get two numbers.
    """
    spark = next(iter(tables.values())).sparkSession
    base, version = base_path.rstrip("/"), f"data/{uuid.uuid4().hex}"
    folders = {}
    for name, df in tables.items():
        folders[name] = f"{version}/{name}"
        df.write.parquet(f"{base}/{folders[name]}")
    number = snapshot_version(spark, base) + 1
    while not commit_manifest(spark, base, folders, number):
        number += 1
    return number


def commit_manifest(spark: SparkSession, base_path: str, content: dict, number: int) -> bool:
    """Make ``content`` version ``number`` by a rename; false, and nothing changed, if that number is taken."""
    folder, path_of = f"{base_path.rstrip('/')}/{_MANIFESTS}", spark._jvm.org.apache.hadoop.fs.Path
    fs = path_of(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path_of(folder))
    draft, final = path_of(f"{folder}/_{uuid.uuid4().hex}"), path_of(f"{folder}/{number}.json")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    done = not fs.exists(final) and fs.rename(draft, final)
    if not done:
        fs.delete(draft, False)
    return done


def read_manifest(spark: SparkSession, base_path: str, number: int) -> dict:
    return json.loads(spark.read.text(f"{base_path.rstrip('/')}/{_MANIFESTS}/{number}.json", wholetext=True).first()["value"])


def snapshot_version(spark: SparkSession, base_path: str) -> int:
    """Number of the newest version under ``base_path``; 0 if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base_path.rstrip('/')}/{_MANIFESTS}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return max((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), default=0)


def read_snapshot(spark: SparkSession, base_path: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of one version (the newest by default), all of the same write."""
    base, number = base_path.rstrip("/"), version or snapshot_version(spark, base_path)
    if not number:
        raise FileNotFoundError(f"no snapshot under {base}")
    return {name: spark.read.parquet(f"{base}/{folder}") for name, folder in read_manifest(spark, base, number).items()}
