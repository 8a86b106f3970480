"""Raw path (CSV files -> scan -> clean), sinks, and the streaming ingestion."""

import os
import tempfile

from conftest import SMALL, rows
from marquee import schemas
from marquee.operators import clean
from marquee.plans.tables import MovieTables
from marquee.sinks import read_csv, save_as_csv
from marquee.sources import adapter
from marquee.sources.files import MOVIES_FILE, RATINGS_FILE, TAGS_FILE
from marquee.streaming.ingest import clean_stream, ingest


def _write_dataset(spark, dirty):
    base = tempfile.mkdtemp(prefix="marquee-ds-")
    save_as_csv(adapter.raw_movies(spark, SMALL, dirty), os.path.join(base, MOVIES_FILE))
    save_as_csv(adapter.raw_ratings(spark, SMALL, dirty), os.path.join(base, RATINGS_FILE))
    save_as_csv(adapter.raw_tags(spark, SMALL), os.path.join(base, TAGS_FILE))
    return base


def test_csv_dataset_cleans_like_the_direct_path(spark):
    base = _write_dataset(spark, dirty=True)
    from_csv = MovieTables.from_csv(spark, base)
    direct = MovieTables.from_driver_tables(spark, SMALL, dirty=True)
    assert rows(from_csv.ratings) == rows(direct.ratings)
    assert rows(from_csv.movies) == rows(direct.movies)
    assert rows(from_csv.tags) == rows(direct.tags)
    assert from_csv.ratings.count() == 5933


def test_csv_keeps_trailing_spaces(spark):
    path = tempfile.mkdtemp(prefix="marquee-csv-") + "/m"
    df = spark.createDataFrame([(1, "Heat (1995)  ", "Action", "1995")], schemas.MOVIES)
    save_as_csv(df, path)
    assert rows(read_csv(spark, path, schemas.MOVIES)) == [(1, "Heat (1995)  ", "Action", "1995")]


def test_streaming_ingest_matches_batch_cleaning(spark):
    src = tempfile.mkdtemp(prefix="marquee-in-")
    raw = adapter.raw_ratings(spark, SMALL, dirty=True)
    save_as_csv(raw, src + "/batch1")
    target = tempfile.mkdtemp(prefix="marquee-out-") + "/ratings"
    stream = clean_stream(spark, src + "/batch1", "ratings")
    assert stream.isStreaming and stream.columns == clean.clean_ratings(raw).columns
    q = ingest(spark, src + "/batch1", "ratings", target, checkpoint_path=tempfile.mkdtemp(prefix="marquee-ck-"))
    q.awaitTermination(120)
    got = spark.read.parquet(target)
    assert rows(got) == rows(clean.clean_ratings(raw))


def test_report_job_writes_every_summary(spark):
    from marquee.plans.report import EXPORTED
    from marquee.plans.report_job import run

    base = _write_dataset(spark, dirty=False)
    out = tempfile.mkdtemp(prefix="marquee-report-") + "/report"
    paths = run(spark, base, out)
    assert set(paths) == {"totals", *EXPORTED}
    totals = spark.read.option("header", True).csv(paths["totals"]).first()
    assert int(totals.num_movies) == 200 and int(totals.num_ratings) == 6000
    years = [r.watching_year for r in spark.read.option("header", True).csv(paths["yearly_watchings"]).collect()]
    assert years == sorted(years) and len(years) == 7


def test_clean_once_then_filters_reach_the_parquet_reader(spark, small):
    from marquee.operators import lookup

    base = tempfile.mkdtemp(prefix="marquee-clean-") + "/tables"
    small.save_clean(base)
    t = MovieTables.from_clean_tables(spark, base)
    assert rows(t.ratings) == rows(small.ratings) and rows(t.interactions) == rows(small.interactions)
    q = lookup.user_ratings(t.ratings, t.movies, 1)
    assert rows(q) == rows(lookup.user_ratings(small.ratings, small.movies, 1))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(userId,1)" in plan


def test_quotes_empty_text_nulls_and_line_feeds_survive(spark):
    path = tempfile.mkdtemp(prefix="marquee-csv-") + "/m"
    titles = ['He Said, "No", Twice (1999)', "", None, "two\nlines (2000)", "back\\slash", "\\N"[:1], '"', " a, b "]
    df = spark.createDataFrame([(k, t, "Drama|Comedy", None) for k, t in enumerate(titles)], schemas.MOVIES)
    save_as_csv(df, path)
    assert rows(read_csv(spark, path, schemas.MOVIES, multi_line=True)) == rows(df)
    save_as_csv(df.where("movieId != 3"), path + "-plain")
    assert rows(read_csv(spark, path + "-plain", schemas.MOVIES)) == rows(df.where("movieId != 3"))


def test_scan_of_a_foreign_file_with_quotes(spark):
    folder = tempfile.mkdtemp(prefix="marquee-csv-")
    with open(f"{folder}/movies.csv", "w") as f:
        f.write('movieId,title,genres\n1,"He Said, ""No"", Twice (1999)",Drama|Comedy\n2,,Drama\n')
    from marquee.sources.files import scan_movies

    assert rows(scan_movies(spark, f"{folder}/movies.csv")) == [("1", 'He Said, "No", Twice (1999)', "Drama|Comedy"), ("2", None, "Drama")]


def test_a_second_ingest_takes_up_new_files(spark):
    src, target = tempfile.mkdtemp(prefix="marquee-in-"), tempfile.mkdtemp(prefix="marquee-out-") + "/ratings"
    raw = adapter.raw_ratings(spark, SMALL).limit(1000)
    part = [raw.where("crc32(cast(movieId as binary)) % 2 = " + str(k)).coalesce(1) for k in range(2)]
    for k in range(2):
        part[k].write.mode("append").options(header=True).csv(src)
        ingest(spark, src, "ratings", target).awaitTermination(120)
        assert spark.read.parquet(target).count() == sum(p.count() for p in part[: k + 1])


def test_epochs_beyond_the_calendar_have_no_date(spark):
    from pyspark.sql import functions as F

    from marquee.functions.columns import epoch_seconds, epoch_to_date_text

    texts = ["9223372036854775807", "-9223372036854775808", "n/a", "0", "-1", "-86400", "86399", "253402300799", "253402300800", "-62135596800", "-62135596801"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", epoch_to_date_text(epoch_seconds(F.col("t"))).alias("d"))
    assert {r.t: r.d for r in df.collect()} == dict(zip(texts, [None, None, None, "1970-01-01", "1969-12-31", "1969-12-31", "1970-01-01", "9999-12-31", None, "0001-01-01", None]))


def test_scratch_folders_are_removed(spark):
    import os.path

    from marquee.session import clear_scratch, scratch_dir

    path = scratch_dir(spark, "kept-for-a-while")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file:"))
    assert clear_scratch(spark) >= 1 and not os.path.isdir(path.removeprefix("file:"))


def test_local_cluster_is_a_cluster():
    from types import SimpleNamespace

    from marquee.session import _is_local

    of = lambda m: _is_local(SimpleNamespace(sparkContext=SimpleNamespace(master=m)))
    assert [of(m) for m in ("local", "local[4]", "local[*]", "local-cluster[2,1,1024]", "spark://x:7077", "yarn")] == [True, True, True, False, False, False]


def test_cluster_settings_scale_with_cores_and_bytes():
    from marquee.session import cluster_settings

    conf = cluster_settings(8000)
    assert conf["spark.sql.shuffle.partitions"] == "32000"
    assert cluster_settings(8000, 100 * 10**12)["spark.sql.shuffle.partitions"] == str(-(-(100 * 10**12) // (256 << 20)))
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "32000"
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
