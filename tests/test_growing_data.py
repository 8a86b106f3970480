"""Malformed records set aside, versions of tables, and sketches of growing data."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from marquee.operators import clean, quarantine, sketches, summary
from marquee.sinks import read_snapshot, save_as_csv, save_snapshot, snapshot_version
from marquee.sources import adapter
from marquee.sources.files import scan_csv


def test_corrupt_lines_are_set_aside_by_reason(spark, tmp_path):
    """Too few fields, too many, bad ids, bad numbers, empty fields; nothing is lost."""
    lines = ["userId,movieId,rating,timestamp", "1,2,3.5,100", "1,2", "1,2,3.5,100,extra", "x,2,3.5,100", "1,y,n/a,zz", "1,2,n/a,100", ",2,3.5,100", "7,8,4.0,later", '9,9,"4.0",100']
    (tmp_path / "ratings.csv").write_text("\n".join(lines) + "\n")
    raw = scan_csv(spark, str(tmp_path / "ratings.csv"), "ratings", keep_corrupt=True)
    kept, aside = quarantine.sort_out(raw, "ratings", str(tmp_path / "out"))
    assert rows(clean.clean_ratings(kept)) == rows(clean.clean_ratings(scan_csv(spark, str(tmp_path / "ratings.csv"), "ratings")))
    found = {(r.userId, r.movieId, r.rating, r.timestamp): (r.problems, r.kept, r[quarantine.CORRUPT]) for r in aside.collect()}
    assert found["1", "2", None, None] == (["missing rating", "missing timestamp", "corrupt line"], False, "1,2")
    assert found["1", "2", "3.5", "100"] == (["corrupt line"], True, "1,2,3.5,100,extra")
    assert found["x", "2", "3.5", "100"][0] == ["malformed userId"] and not found["x", "2", "3.5", "100"][1]
    assert found["1", "y", "n/a", "zz"][0] == ["malformed movieId", "malformed rating", "malformed timestamp"]
    assert found["1", "2", "n/a", "100"] == (["malformed rating"], True, None)
    assert found[None, "2", "3.5", "100"][0] == ["missing userId"] and found["7", "8", "4.0", "later"] == (["malformed timestamp"], True, None)
    assert len(found) == 7 and kept.count() == 5
    counts = {r.reason: (r.num_rows, r.num_dropped) for r in quarantine.counts_by_reason(raw.cache(), "ratings").collect()}
    assert counts["none"] == (2, 0) and counts["corrupt line"] == (2, 1) and counts["malformed rating"] == (2, 1)
    assert {f for f in os.listdir(tmp_path / "out") if "=" in f} >= {"reason=none", "reason=missing rating", "reason=malformed userId"}


@pytest.mark.parametrize("table", ["ratings", "movies", "tags"])
def test_what_is_kept_is_what_cleaning_keeps(spark, table):
    raw = {"ratings": adapter.raw_ratings, "movies": adapter.raw_movies}.get(table, lambda s, d, _: adapter.raw_tags(s, d))(spark, SMALL, True)
    cleaned = {"ratings": clean.clean_ratings, "movies": clean.clean_movies, "tags": clean.clean_tags}[table]
    marked = quarantine.with_problems(raw, table)
    assert rows(cleaned(marked.where("kept").select(*raw.columns))) == rows(cleaned(raw))
    assert marked.where("kept").count() == cleaned(raw).count()


def test_a_failed_write_is_never_seen(spark, tmp_path):
    base = str(tmp_path / "tables")
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, base)
    a, b = spark.range(5).withColumn("v", F.lit(1)), spark.range(7).withColumn("v", F.lit(1))
    assert save_snapshot({"a": a, "b": b}, base) == 1
    bad = spark.range(3).select("id", F.raise_error(F.lit("no")).alias("v"))
    with pytest.raises(Exception, match="no"):
        save_snapshot({"a": spark.range(50).withColumn("v", F.lit(2)), "b": bad}, base)
    seen = read_snapshot(spark, base)
    assert snapshot_version(spark, base) == 1 and (seen["a"].count(), seen["b"].count()) == (5, 7)
    assert save_snapshot({"a": a.withColumn("v", F.lit(2)), "b": b.withColumn("v", F.lit(2))}, base) == 2
    now = read_snapshot(spark, base)
    assert {r.v for r in now["a"].union(now["b"]).select("v").distinct().collect()} == {2}
    old = read_snapshot(spark, base, 1)
    assert {r.v for r in old["a"].union(old["b"]).select("v").distinct().collect()} == {1}
    assert {r.v for r in seen["a"].union(seen["b"]).select("v").distinct().collect()} == {1}  # a reader at work goes on


def test_writers_at_once_get_versions_of_their_own(spark, tmp_path):
    base, numbers = str(tmp_path / "tables"), []

    def write(v):
        numbers.append((v, save_snapshot({"a": spark.range(3).withColumn("v", F.lit(v)), "b": spark.range(4).withColumn("v", F.lit(v))}, base)))

    workers = [threading.Thread(target=write, args=(v,)) for v in range(4)]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    assert sorted(n for _, n in numbers) == [1, 2, 3, 4]
    for v, n in numbers:
        t = read_snapshot(spark, base, n)
        assert {r.v for r in t["a"].union(t["b"]).select("v").distinct().collect()} == {v}


def test_sketches_merge_to_the_count_of_all_rows(spark, small, tmp_path):
    """Several appends, days in parts, repeated parts: the estimate is that of all rows, within its error of the exact one."""
    path = str(tmp_path / "days")
    for k in range(4):
        sketches.append_days(small.ratings.where(F.pmod(F.xxhash64("userId", "movieId"), F.lit(4)) == k), path)
    sketches.append_days(small.ratings.limit(100), path)  # counted twice
    stored = spark.read.parquet(path)
    whole = sketches.daily_sketches(small.ratings)
    got = {r.watching_year: r.num_users for r in sketches.users_per_year(stored).collect()}
    assert got == {r.watching_year: r.num_users for r in sketches.users_per_year(whole).collect()}
    exact = {r.watching_year: r.num_of_users for r in summary.active_users_per_year(small.ratings).collect()}
    assert got.keys() == exact.keys() and all(abs(got[y] - exact[y]) <= 0.04 * exact[y] + 1 for y in exact)
    year = max(y for y in exact if y)
    assert sketches.users_between(stored, f"{year}-01-01", f"{year}-12-31").first().num_users == got[year]
    assert sketches.users_between(stored, "2999-01-01").first() == (0, 0)


def test_error_over_many_merges(spark, tmp_path):
    """200 days of 1,000 of 50,000 users."""
    visits = spark.range(200_000).select((F.xxhash64("id") % 50_000).cast("int").alias("userId"), F.date_format(F.date_add(F.lit("2020-01-01"), (F.col("id") % 200).cast("int")), "yyyy-MM-dd").alias("watching_date"))
    sketches.append_days(visits, str(tmp_path / "days"))
    exact = visits.select("userId").distinct().count()
    assert abs(sketches.users_between(spark.read.parquet(str(tmp_path / "days"))).first().num_users - exact) <= 0.035 * exact


def test_csv_copy_of_clean_rows_has_no_corrupt_line(spark, tmp_path):
    raw = adapter.raw_movies(spark, SMALL, True)
    save_as_csv(raw, str(tmp_path / "movies"))
    read = scan_csv(spark, str(tmp_path / "movies"), "movies", keep_corrupt=True).cache()
    assert read.where(F.col(quarantine.CORRUPT).isNotNull()).count() == 0 and read.count() == raw.count()


def test_a_day_s_sketches_do_not_grow_with_the_tasks(small):
    """Records are dealt by day and slice below the partial aggregate, so a day has at most one sketch for each slice."""
    plan = sketches.daily_sketches(small.ratings.repartition(40))._jdf.queryExecution().sparkPlan().toString()
    rows = sketches.daily_sketches(small.ratings.repartition(40)).select("watching_date", "num_ratings").collect()
    want = small.ratings.groupBy("watching_date").agg(F.count(F.lit(1)).alias("n")).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, want))
    assert -1 < plan.find("partial_hll_sketch_agg") < plan.find("REPARTITION_BY_COL")
