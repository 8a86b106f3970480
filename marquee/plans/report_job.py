"""The data-set report as a batch job (the console's summary choice, without the console).

    spark-submit marquee/plans/report_job.py --data <folder with movies.csv, ratings.csv, tags.csv> --out <folder>
    python -m marquee.plans.report_job --data ... --out ...          (local)

Writes ``<out>/totals`` and the five exported summaries as CSV folders with headers. The tables are kept with
``reuse`` (persist, or checkpoint to ``spark.checkpoint.dir`` with ``--checkpoint``) because all summaries read
them; nothing is collected to the driver.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from marquee.plans.report import EXPORTED, summary_report
from marquee.plans.tables import MovieTables
from marquee.sinks import export_summaries


def run(spark: SparkSession, data: str, out: str, checkpoint: bool = False) -> dict[str, str]:
    t = MovieTables.from_csv(spark, data).reuse("checkpoint" if checkpoint else "persist", ("movies", "ratings"))
    try:
        report = summary_report(t)
        return export_summaries({"totals": report["totals"], **{n: report[n] for n in EXPORTED}}, out)
    finally:
        t.release()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--data", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--checkpoint", action="store_true", help="cut lineage in spark.checkpoint.dir")
    args = parser.parse_args(argv)
    from marquee.session import build_session

    run(build_session(app_name="marquee-report"), args.data, args.out, args.checkpoint)


if __name__ == "__main__":
    main()
