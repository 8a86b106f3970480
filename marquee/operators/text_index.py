"""Text lookups by an index of trigrams, for tables where a scan of every text is too much.

``build`` writes, under one folder, a posting (trigram, id) for every distinct trigram of every text, sorted by trigram over
all files, and how many ids each trigram has. A lookup reads the postings of the rarest trigrams of the fragment only (a
pushed filter on a sorted column), intersects them, and verifies the candidates on the texts, so its rows are those of
the scan. Texts are padded at the end, so every character begins a trigram: fragments of one or two characters are
prefixes of trigrams, and a fragment with the padding behind it matches at the end of a text only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of a gram, what texts are padded with, and trigrams of a fragment whose postings are read.
GRAM, PAD, PROBES = 3, "\0", 3


def grams(text: Column) -> Column:
    """Distinct trigrams of a text with its padding; none of an empty text."""
    padded = F.concat(text, F.lit(PAD * (GRAM - 1)))
    at = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda k: F.substr(padded, k, F.lit(GRAM))))


def build(frame: DataFrame, id_col: str, text_col: str, path: str, files: int | None = None) -> str:
    """Write the index of a frame under ``path``. Null ids and null texts are not in it; an id may have several texts.

    A trigram of very many texts spans several files, since the sort is by trigram and id.
    """
    postings = (
        frame.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.explode(grams(F.col(text_col))).alias("gram"), F.col(id_col).alias("id"))
        .distinct()
    )
    parts = [files] if files else []
    postings.repartitionByRange(*parts, "gram", "id").sortWithinPartitions("gram", "id").write.mode("overwrite").parquet(f"{path}/postings")
    counts = frame.sparkSession.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("num_ids"))
    counts.orderBy("gram").write.mode("overwrite").parquet(f"{path}/grams")
    return path


def candidates(spark: SparkSession, path: str, probe: str) -> DataFrame | None:
    """Ids of texts that may hold ``probe`` (padding included): a superset of those that do; None means all."""
    postings = spark.read.parquet(f"{path}/postings")
    if not probe:
        return None
    if len(probe) < GRAM:
        return postings.where(F.col("gram").startswith(probe)).select("id").distinct()
    wanted = {probe[k : k + GRAM] for k in range(len(probe) - GRAM + 1)}
    counts = spark.read.parquet(f"{path}/grams").where(F.col("gram").isin(sorted(wanted))).collect()  # as many as the fragment has
    if len(counts) < len(wanted):
        return postings.where(F.lit(False)).select("id")
    rarest = [r["gram"] for r in sorted(counts, key=lambda r: (r["num_ids"], r["gram"]))[:PROBES]]
    found = postings.where(F.col("gram").isin(rarest)).select("gram", "id")
    if len(rarest) == 1:
        return found.select("id")
    return found.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") == len(rarest)).select("id")


def _picked(frame: DataFrame, id_col: str, ids: DataFrame | None, holds: Column) -> DataFrame:
    rows = frame.where(holds)
    return rows if ids is None else rows.join(ids.select(F.col("id").alias(id_col)), id_col, "left_semi").select(*frame.columns)


def contains(frame: DataFrame, id_col: str, text_col: str, path: str, fragment: str) -> DataFrame:
    """Rows of the indexed frame whose text contains a fragment, as a scan with ``contains`` gives them."""
    return _picked(frame, id_col, candidates(frame.sparkSession, path, fragment), F.col(text_col).contains(F.lit(fragment)))


def ends_with(frame: DataFrame, id_col: str, text_col: str, path: str, fragment: str) -> DataFrame:
    """Rows of the indexed frame whose text ends with a fragment, as a scan with ``endswith`` gives them."""
    return _picked(frame, id_col, candidates(frame.sparkSession, path, fragment + PAD if fragment else ""), F.col(text_col).endswith(F.lit(fragment)))
