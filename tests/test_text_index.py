"""Indexed text lookups (title, genre and year lookups of the source) against scans."""

import glob
import random

import pyarrow.parquet as pq
import pytest

from conftest import rows
from marquee.operators import lookup, text_index
from marquee.sinks import save_by_id


@pytest.fixture(scope="module")
def titles(spark, small, tmp_path_factory):
    odd = [(9001, ""), (9002, None), (None, "no id (1975)"), (9003, "a"), (9004, "ab"), (9005, "日本 (1975)"), (9006, "x\0y"), (9007, "🎬 film"), (9001, "two texts (1975)"), (9008, "50%_off's (1975) ")]
    movies = small.movies.select("movieId", "title").union(spark.createDataFrame(odd, "movieId int, title string")).cache()
    return movies, text_index.build(movies, "movieId", "title", str(tmp_path_factory.mktemp("titles")), files=6)


def scan(movies, f):
    return rows(movies.where("movieId is not null").where(movies.title.contains(f)))


def test_same_rows_as_a_scan(titles):
    movies, path = titles
    texts = [r.title for r in movies.where("title is not null").collect()]
    rng = random.Random(3)
    fragments = ["", "a", "zz", "(", "ab", "\0", "日", "日本", "日本 ", "🎬", "%", "_", "'", "widget", "no such fragment", "(1975)", "y\0", "a\0"]
    for _ in range(25):
        t = rng.choice([t for t in texts if t])
        at = rng.randrange(len(t))
        fragments.append(t[at : at + rng.randint(1, 12)])
    for f in fragments:
        got = rows(text_index.contains(movies.where("movieId is not null"), "movieId", "title", path, f))
        assert got == scan(movies, f), f
        ends = rows(text_index.ends_with(movies.where("movieId is not null"), "movieId", "title", path, f))
        assert ends == rows(movies.where("movieId is not null").where(movies.title.endswith(f))), f


def reads(folder, low, high, column):
    """(bytes, all bytes) of the row groups whose values may lie from low to high."""
    mine = total = 0
    for file in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            at = next(c for c in range(group.num_columns) if group.column(c).path_in_schema == column)
            stats = group.column(at).statistics
            total += group.total_byte_size
            if not (stats.max < low or stats.min > high):
                mine += group.total_byte_size
    return mine, total


def test_a_lookup_reads_a_part_of_the_postings(titles):
    movies, path = titles
    mine, total = reads(f"{path}/postings", "wid", "wid", "gram")
    assert mine < total / 2
    plan = text_index.contains(movies, "movieId", "title", path, "widget")._jdf.queryExecution().executedPlan().toString()
    assert "In(gram, [" in plan or "EqualTo(gram," in plan
    short = text_index.contains(movies, "movieId", "title", path, "wi")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(gram,wi)" in short


def test_empty_frame(spark, small, tmp_path):
    none = small.movies.limit(0)
    path = text_index.build(none, "movieId", "title", str(tmp_path / "none"))
    assert text_index.contains(none, "movieId", "title", path, "abc").count() == 0 == text_index.contains(none, "movieId", "title", path, "a").count()


def test_rows_saved_by_id(spark, small, tmp_path):
    """Same rows; an id's rows lie in few row groups, which have bloom filters for ids that are not there."""
    path = str(tmp_path / "ratings")
    save_by_id(small.ratings, path, "userId", files=6)
    saved = spark.read.parquet(path)
    assert rows(saved) == rows(small.ratings)
    assert rows(lookup.user_ratings(saved, small.movies, 1)) == rows(lookup.user_ratings(small.ratings, small.movies, 1))
    assert lookup.user_ratings(saved, small.movies, 99999999).count() == 0
    mine, total = reads(path, 1, 1, "userId")
    assert 0 < mine < total / 2
    plain = str(tmp_path / "plain")
    small.ratings.repartition(6).write.parquet(plain)
    scattered, whole = reads(plain, 1, 1, "userId")
    assert scattered == whole
    names = {f.split("/")[-1] for f in glob.glob(f"{path}/*.parquet")}
    assert names and all(has_bloom_filter(spark, f"{path}/{n}", "userId") for n in names)
    assert not has_bloom_filter(spark, glob.glob(f"{plain}/*.parquet")[0], "userId")


def has_bloom_filter(spark, file, column):
    """Whether every row group of a file has a bloom filter of a column, by the footer."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    blocks = reader.getFooter().getBlocks()
    found = all(c.getBloomFilterOffset() > 0 for k in range(blocks.size()) for c in list(blocks.get(k).getColumns()) if c.getPath().toDotString() == column)
    reader.close()
    return found
