"""The data-set report: totals plus the yearly and per-genre summaries, and its CSV export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import summary
from marquee.plans.tables import MovieTables
from marquee.session import scratch_dir
from marquee.sinks import export_summaries

# Fixed names of the exported summaries (the active-user summary is shown, not exported).
EXPORTED = ("yearly_movies", "yearly_genres_movies", "genres_movies", "yearly_watchings", "genres_watchings")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def summary_report(t: MovieTables) -> dict[str, DataFrame]:
    """All parts of the report. The ratings are read once: their grouping sets are written to the shared folder, and every
    part reads those, also after the loss of executors. The movies are read for their grouping sets and genres."""
    return summary.summaries_of(_written(summary.rating_sets(t.ratings), "rating-sets"), _written(summary.movie_sets(t.movies), "movie-sets"), t.movies)


def report_rows(t: MovieTables) -> DataFrame:
    """Every row of every part in one shape: ``summary, row_key`` (key columns joined by ``#``), ``row_value`` (the last
    column). The totals have a row each."""
    report = summary_report(t)
    totals = report.pop("totals")
    out = [totals.select(F.lit("totals").alias("summary"), F.posexplode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("v")) for c in totals.columns])).alias("pos", "x")).select("summary", F.col("x.k").alias("row_key"), F.col("x.v").cast("double").alias("row_value"))]
    for name, df in report.items():
        out.append(df.select(F.lit(name).alias("summary"), F.concat_ws("#", *df.columns[:-1]).alias("row_key"), F.col(df.columns[-1]).cast("double").alias("row_value")))
    return reduce(DataFrame.unionByName, out)


def export_report(t: MovieTables, base_path: str) -> dict[str, str]:
    """Write the five exported summaries as CSV folders under ``base_path``; returns their paths."""
    report = summary_report(t)
    return export_summaries({name: report[name] for name in EXPORTED}, base_path)
