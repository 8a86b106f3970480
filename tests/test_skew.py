"""A hot key: one user holds a third of all rating and tag rows (derived from the driver's tables). Results
must stay whole and equal a plain pandas computation of the same rules."""

import pytest
from pyspark.sql import functions as F

from marquee.operators import model, profile

HOT = 1


@pytest.fixture(scope="module")
def skewed(small):
    def hot(df):
        third = F.pmod(F.xxhash64(*df.columns), F.lit(3)) == 0
        return df.withColumn("userId", F.when(third, F.lit(HOT)).otherwise(F.col("userId")))

    return hot(small.ratings), hot(small.tags), small.movies


def _pdf(df):
    return df.toPandas()


def test_hot_user_holds_a_third(skewed):
    ratings, _, _ = skewed
    share = ratings.where(F.col("userId") == HOT).count() / ratings.count()
    assert 0.3 < share < 0.37


def test_interactions_under_skew_match_brute_force(skewed):
    ratings, tags, _ = skewed
    got = _pdf(model.interactions(ratings, tags)).sort_values(["userId", "movieId"]).reset_index(drop=True)
    r = _pdf(ratings)
    r["ts"] = r["timestamp"].astype("int64")
    latest = (
        r.sort_values(["userId", "movieId", "ts", "rating"]).groupby(["userId", "movieId"], as_index=False).last()
    )[["userId", "movieId", "rating"]]
    t = _pdf(tags)[["userId", "movieId"]].drop_duplicates()
    want = latest.merge(t, on=["userId", "movieId"], how="outer").sort_values(["userId", "movieId"]).reset_index(drop=True)
    assert len(got) == len(want)
    assert (got[["userId", "movieId"]].values == want[["userId", "movieId"]].values).all()
    assert got["rating"].fillna(-1).tolist() == want["rating"].fillna(-1).tolist()


def test_genre_stats_and_profile_under_skew_match_brute_force(skewed):
    ratings, tags, movies = skewed
    inter = model.interactions(ratings, tags)
    folded = model.interaction_genres(inter, movies)
    got = _pdf(profile.genre_stats(folded)).sort_values(["userId", "genre"]).reset_index(drop=True)

    m = _pdf(movies)
    parts = m.assign(genre=m["genres"].str.split("|")).explode("genre")[["movieId", "genre"]]
    wide = _pdf(inter).astype({"rating": "float64"}).merge(parts, on="movieId")
    want = (
        wide.groupby(["userId", "genre"])
        .agg(avgRating=("rating", "mean"), watchCount=("movieId", "nunique"))
        .reset_index()
        .sort_values(["userId", "genre"])
        .reset_index(drop=True)
    )
    assert len(got) == len(want)
    assert (got["watchCount"].values == want["watchCount"].values).all()
    assert ((got["avgRating"] - want["avgRating"]).abs().fillna(0) < 1e-12).all()

    prof = _pdf(profile.user_genre_profile(ratings, movies)).sort_values(["userId", "genre"]).reset_index(drop=True)
    rg = _pdf(ratings).merge(parts, on="movieId")
    want_p = rg.groupby(["userId", "genre"]).agg(n=("rating", "size")).reset_index().sort_values(["userId", "genre"])
    assert prof["watchings"].tolist() == want_p["n"].tolist()
    assert prof.loc[prof.userId == HOT, "watchings"].sum() == len(rg[rg.userId == HOT])


def test_hot_movie_join_partition_is_split(spark, small):
    """Movies too big to broadcast: the sort-merge join of ratings to genres meets a movie holding a third of
    all ratings, and AQE's skew join splits that partition in the profile (thresholds lowered to the test's
    size). Results stay whole."""
    third = F.pmod(F.xxhash64("userId", "timestamp"), F.lit(3)) == 0
    hot_ratings = small.ratings.withColumn("movieId", F.when(third, F.lit(1)).otherwise(F.col("movieId")))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        prof = profile.user_genre_profile(hot_ratings, small.movies)
        got_prof = prof.collect()
        prof_plan = prof._jdf.queryExecution().executedPlan().toString()
        got = model.rated_genres(hot_ratings, small.movies).groupBy("movieId").count()
        counts = {r.movieId: r["count"] for r in got.collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in prof_plan  # the hot movie's join partition is split across tasks
    assert sum(r.watchings for r in got_prof) == hot_ratings.count() * 4
    assert counts[1] == hot_ratings.where("movieId = 1").count() * 4
    assert sum(counts.values()) == hot_ratings.count() * 4


def test_dealt_rows_give_the_same_and_are_spread_before_they_multiply(skewed, monkeypatch):
    """A hot user and a hot movie: each task has its share of the pairs, and results are those of the plain join. Two rows
    of a movie, repeated and empty genre parts and null genres among them."""
    from marquee.plans import tables

    ratings, tags, movies = skewed
    third = F.pmod(F.xxhash64("userId", "timestamp", "movieId"), F.lit(3)) == 0
    ratings = ratings.withColumn("movieId", F.when(third, F.lit(1)).otherwise(F.col("movieId")))
    odd = movies.where("movieId <= 4").withColumn("genres", F.when(F.col("movieId") == 4, F.lit(None)).otherwise(F.lit("A|A||B")))
    movies = movies.unionByName(odd)
    inter = model.interactions(ratings, tags)
    dealt = model.interaction_genres(inter, movies, tasks=12)
    assert sorted(dealt.collect(), key=repr) == sorted(model.interaction_genres(inter, movies).collect(), key=repr)
    records = model.rated_genres(ratings, movies.where("genres is not null"), tasks=12)
    plain = model.rated_genres(ratings, movies.where("genres is not null"))
    assert records.columns == plain.columns and sorted(records.collect(), key=repr) == sorted(plain.collect(), key=repr)
    for rows in (dealt, records):
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 12 and max(sizes) < 4 * sum(sizes) / len(sizes)
    monkeypatch.setattr(tables, "RECORDS_PER_TASK", 500)
    monkeypatch.setattr(tables, "FEW_RECORDS", 1000)
    found = tables.MovieTables(None, movies, None, (ratings, tags))
    assert found.tasks == -(-(ratings.count() + tags.count()) // 500)
    monkeypatch.setattr(tables, "FEW_RECORDS", 10**9)
    assert tables.MovieTables(None, movies, None, (ratings, tags)).tasks is None and tables.MovieTables(None, movies, None).tasks is None
