"""Records that cleaning drops or changes, set aside with the reason instead of being lost silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import epoch_seconds

#: The column of ``sources.files.scan_csv`` that holds the text of a line whose fields do not fit the schema.
CORRUPT = "_corrupt"

_IDS = {"ratings": ("userId", "movieId"), "movies": ("movieId",), "tags": ("userId", "movieId")}
#: Columns whose nulls make cleaning drop a row.
_NEEDED = {"ratings": ("userId", "movieId", "rating", "timestamp"), "movies": ("movieId", "title", "genres"), "tags": ("userId", "movieId")}


def dropping(table: str) -> list[tuple[str, Column]]:
    """(reason, condition) of what makes cleaning drop a row of a raw table."""
    missing = [(f"missing {c}", F.col(c).isNull()) for c in _NEEDED[table]]
    return missing + [(f"malformed {c}", F.col(c).isNotNull() & F.col(c).try_cast("int").isNull()) for c in _IDS[table]]


def changing(table: str) -> list[tuple[str, Column]]:
    """(reason, condition) of what cleaning keeps with a null in place of the value."""
    if table != "ratings":
        return []
    return [
        ("malformed rating", F.col("rating").isNotNull() & F.col("rating").try_cast("float").isNull()),
        ("malformed timestamp", F.col("timestamp").isNotNull() & epoch_seconds("timestamp").isNull()),
    ]


def with_problems(raw: DataFrame, table: str) -> DataFrame:
    """The raw rows with ``problems`` (all reasons, in a fixed order) and ``kept`` (whether cleaning keeps the row).

    A line that does not fit the schema (see ``CORRUPT``) has the reason "corrupt line"; cleaning judges it by its fields.
    """
    reasons = dropping(table) + changing(table)
    if CORRUPT in raw.columns:
        reasons.append(("corrupt line", F.col(CORRUPT).isNotNull()))
    drops = [condition for _, condition in dropping(table)]
    none = F.lit(False)
    for condition in drops:
        none = none | condition
    listed = F.array_compact(F.array(*[F.when(condition, F.lit(reason)) for reason, condition in reasons]))
    return raw.withColumns({"problems": listed, "kept": ~none})


def counts_by_reason(raw: DataFrame, table: str) -> DataFrame:
    """``reason, num_rows, num_dropped``: rows with each problem, and those of them that cleaning drops. A row with several
    problems counts in each; "none" counts the rows without any."""
    rows = with_problems(raw, table).select("kept", F.explode(F.when(F.size("problems") == 0, F.array(F.lit("none"))).otherwise(F.col("problems"))).alias("reason"))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("num_rows"), F.count_if(~F.col("kept")).alias("num_dropped"))


def sort_out(raw: DataFrame, table: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Write the raw rows once, in folders by their first problem, and return ``(kept, quarantine)``: the raw rows that
    cleaning keeps, and the rows with any problem, with their ``problems`` and ``reason`` (the first).

    One pass over the source. Reading one reason reads its folder only.
    """
    rows = with_problems(raw, table).withColumn("reason", F.coalesce(F.get("problems", F.lit(0)), F.lit("none")))
    rows.write.mode("overwrite").partitionBy("reason").parquet(path)
    saved = raw.sparkSession.read.schema(rows.schema).parquet(path)
    plain = [c for c in raw.columns if c != CORRUPT]
    return saved.where("kept").select(*plain), saved.where(F.col("reason") != "none").select(*raw.columns, "problems", "kept", "reason")
