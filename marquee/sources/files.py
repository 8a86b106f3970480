"""Scans of the three source tables (movies, ratings, tags) from a data-set folder.

Schemas are always given, never inferred: one pass over the files, and the column types do not depend on the
data. CSV files are read as text with a header, as the sources ship; Parquet copies keep their own types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from marquee import schemas
from marquee.operators.quarantine import CORRUPT
from marquee.schemas import CSV_OPTIONS

# Fixed file names of a data-set folder.
MOVIES_FILE = "movies.csv"
RATINGS_FILE = "ratings.csv"
TAGS_FILE = "tags.csv"

_RAW = {"movies": schemas.RAW_MOVIES, "ratings": schemas.RAW_RATINGS, "tags": schemas.RAW_TAGS}


def scan_csv(spark: SparkSession, path: str, table: str, multi_line: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """Raw string columns of one source table from CSV with a header row.

    Leading and trailing spaces are kept (a title may end in spaces), doubled quotes inside a quoted field are one
    quote, and an empty field reads as null. ``multi_line`` allows line feeds inside quoted fields; such files cannot
    be split among tasks, so it is off unless asked for. ``keep_corrupt`` adds the text of lines with too few or too many
    fields as the column that ``operators.quarantine`` reads.
    """
    if keep_corrupt:
        schema = StructType([*_RAW[table].fields, StructField(CORRUPT, StringType())])
        return spark.read.schema(schema).options(**CSV_OPTIONS).option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line).csv(path)
    return spark.read.schema(_RAW[table]).options(**CSV_OPTIONS).option("multiLine", multi_line).csv(path)


def scan_movies(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return scan_csv(spark, path, "movies", multi_line)


def scan_ratings(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return scan_csv(spark, path, "ratings", multi_line)


def scan_tags(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return scan_csv(spark, path, "tags", multi_line)


def load_dataset(spark: SparkSession, base_path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(ratings, movies, tags)`` raw frames of a folder holding ``movies.csv``, ``ratings.csv``, ``tags.csv``.

    The folder choice (small or full data set) is just the argument.
    """
    base = base_path.rstrip("/")
    return (
        scan_ratings(spark, f"{base}/{RATINGS_FILE}", multi_line),
        scan_movies(spark, f"{base}/{MOVIES_FILE}", multi_line),
        scan_tags(spark, f"{base}/{TAGS_FILE}", multi_line),
    )
