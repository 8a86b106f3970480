"""DuckDB SQL for every registered query, written independently of the Spark code.

The CTEs restate the adapter rules over the driver's views (``part``, ``orders``, ``lineitem``, ``events``) and
the operator semantics in plain SQL. Where the Spark side uses a cheaper plan (aggregate before join, union +
group instead of a full outer join, windows instead of self-joins) the SQL keeps the literal form, so a match
checks the rewrite too.
"""

from __future__ import annotations

from marquee.plans import params as P

CTES: dict[str, str] = {
    "movies": """movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS movieId,
         p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' AS title,
         replace(p_name, ' ', '|') || '|' || p_type || '|' || p_brand AS genres,
         substring(rtrim(p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')'), -5, 4) AS production_year
  FROM part)""",
    "movie_genres": """movie_genres AS (
  SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM movies)""",
    "ratings": """ratings AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS userId,
         CAST(l.l_partkey AS INTEGER) AS movieId,
         CAST(((CAST(l.l_quantity AS INTEGER) - 1) % 10 + 1) / 2 AS FLOAT) AS rating,
         CAST(CAST(epoch(l.l_shipdate) AS BIGINT) AS VARCHAR) AS "timestamp",
         strftime(l.l_shipdate, '%Y-%m-%d') AS watching_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "tags": """tags AS (
  SELECT CAST(user_id AS INTEGER) AS userId,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS movieId,
         event_type AS tag
  FROM events)""",
    "rating_latest": """rating_latest AS (
  SELECT userId, movieId, rating FROM (
    SELECT userId, movieId, rating,
           row_number() OVER (PARTITION BY userId, movieId
                              ORDER BY CAST("timestamp" AS BIGINT) DESC NULLS LAST, rating DESC NULLS LAST) AS rn
    FROM ratings) WHERE rn = 1)""",
    "tag_pairs": """tag_pairs AS (SELECT DISTINCT userId, movieId FROM tags)""",
    "interactions": """interactions AS (
  SELECT coalesce(r.userId, t.userId) AS userId, coalesce(r.movieId, t.movieId) AS movieId, r.rating AS rating
  FROM tag_pairs t FULL OUTER JOIN rating_latest r ON t.userId = r.userId AND t.movieId = r.movieId)""",
    "wide": """wide AS (
  SELECT i.rating, i.userId, i.movieId, m.title, unnest(string_split(m.genres, '|')) AS genre
  FROM interactions i LEFT JOIN movies m ON i.movieId = m.movieId)""",
    # rating meaning: ratings x cleaned movies x (movie, genre)
    "rated_genres": """rated_genres AS (
  SELECT r.*, g.genre FROM ratings r JOIN movies m ON r.movieId = m.movieId JOIN movie_genres g ON r.movieId = g.movieId)""",
    "genre_stats": """genre_stats AS (
  SELECT userId, genre, avg(rating) AS avgRating, count(DISTINCT movieId) AS watchCount FROM wide GROUP BY userId, genre)""",
    "profile": """profile AS (
  SELECT userId, genre,
         CAST(round(CAST(avg(rating) AS DECIMAL(18,6)), 2) AS DOUBLE) AS Average_Rating,
         count(userId) AS watchings
  FROM rated_genres GROUP BY userId, genre)""",
    "thresholds": """thresholds AS (
  SELECT userId, count(*) AS num_genres, count(Average_Rating) AS num_rated,
         sum(CAST(Average_Rating AS DECIMAL(18,2))) AS rating_sum,
         sum(watchings) AS watchings_sum
  FROM profile GROUP BY userId)""",
    "flags": """flags AS (
  SELECT p.userId, p.genre, p.Average_Rating, p.watchings,
         coalesce(CAST(p.Average_Rating AS DECIMAL(18,2)) * t.num_rated >= t.rating_sum
                  AND p.watchings * t.num_genres >= t.watchings_sum, false) AS likes,
         coalesce(CAST(p.Average_Rating AS DECIMAL(18,2)) * t.num_rated < t.rating_sum
                  AND p.watchings * t.num_genres < t.watchings_sum, false) AS dislikes
  FROM profile p JOIN thresholds t ON p.userId = t.userId)""",
    "cutoff": """cutoff AS (
  SELECT userId, avg(watchCount) AS avgWatchCount FROM genre_stats GROUP BY userId)""",
    "above_cutoff": """above_cutoff AS (
  SELECT s.userId, s.genre, s.avgRating, s.watchCount, c.avgWatchCount
  FROM genre_stats s LEFT JOIN cutoff c ON s.userId = c.userId WHERE s.watchCount >= c.avgWatchCount)""",
    "favourites": """favourites AS (
  SELECT a.*, h.maxAvgRating FROM above_cutoff a
  LEFT JOIN (SELECT userId, max(avgRating) AS maxAvgRating FROM above_cutoff GROUP BY userId) h ON a.userId = h.userId
  WHERE h.maxAvgRating >= a.avgRating)""",
    # the driver's dirty raw tables, as text
    "raw_ratings_dirty": """raw_ratings_dirty AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS userId,
         CAST(l.l_partkey AS VARCHAR) AS movieId,
         CASE WHEN l.l_orderkey % 97 = 0 THEN NULL
              WHEN l.l_orderkey % 101 = 0 THEN 'n/a'
              ELSE CAST(((CAST(l.l_quantity AS INTEGER) - 1) % 10 + 1) / 2 AS VARCHAR) END AS rating,
         CAST(CAST(epoch(l.l_shipdate) AS BIGINT) AS VARCHAR) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "raw_movies_dirty": """raw_movies_dirty AS (
  SELECT CAST(p_partkey AS VARCHAR) AS movieId,
         CASE WHEN p_partkey % 41 = 0 THEN p_name
              ELSE p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' END AS title,
         CASE WHEN p_partkey % 37 = 0 THEN NULL
              ELSE replace(p_name, ' ', '|') || '|' || p_type || '|' || p_brand END AS genres
  FROM part)""",
    "raw_tags": """raw_tags AS (
  SELECT CAST(user_id AS VARCHAR) AS userId,
         json_extract_string(props, '$.k') AS movieId,
         event_type AS tag,
         CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS "timestamp"
  FROM events)""",
}

# Which CTEs each CTE reads, so a query lists only its leaves.
DEPENDS: dict[str, tuple[str, ...]] = {
    "movie_genres": ("movies",),
    "rating_latest": ("ratings",),
    "tag_pairs": ("tags",),
    "interactions": ("rating_latest", "tag_pairs"),
    "wide": ("interactions", "movies"),
    "rated_genres": ("ratings", "movies", "movie_genres"),
    "genre_stats": ("wide",),
    "profile": ("rated_genres",),
    "thresholds": ("profile",),
    "flags": ("profile", "thresholds"),
    "cutoff": ("genre_stats",),
    "above_cutoff": ("genre_stats", "cutoff"),
    "favourites": ("above_cutoff",),
}


def _ordered(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, ()):
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(body: str, *ctes: str, extra: tuple[str, ...] = ()) -> str:
    parts = [CTES[n] for n in _ordered(ctes)] + list(extra)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values)


def _histogram(values_sql: str, key_name: str, bins: int) -> str:
    """Equal-width bins over per-key values ``(k, v)``; the range widens by 0.5 each side when min = max."""
    return f"""WITH {{ctes}}
vals AS ({values_sql}),
rng AS (
  SELECT k, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
            CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
  FROM vals WHERE v IS NOT NULL GROUP BY k),
base AS (
  SELECT vals.k, vals.v, rng.lo, rng.hi,
         CAST(least(floor((vals.v - rng.lo) / (rng.hi - rng.lo) * {bins}), {bins - 1}) AS INTEGER) AS b0
  FROM vals JOIN rng ON vals.k = rng.k WHERE vals.v IS NOT NULL),
placed AS (
  SELECT k, CASE WHEN v < b0 * ((hi - lo) / {bins}) + lo THEN b0 - 1
                 WHEN b0 <> {bins - 1} AND v >= (CASE WHEN b0 + 1 >= {bins} THEN hi
                                                 ELSE (b0 + 1) * ((hi - lo) / {bins}) + lo END) THEN b0 + 1
                 ELSE b0 END AS b
  FROM base),
cnt AS (SELECT k, b, count(*) AS n FROM placed GROUP BY 1, 2),
edges AS (
  SELECT rng.k, t.b, t.b * ((rng.hi - rng.lo) / {bins}) + rng.lo AS bin_start,
         CASE WHEN t.b + 1 >= {bins} THEN rng.hi ELSE (t.b + 1) * ((rng.hi - rng.lo) / {bins}) + rng.lo END AS bin_end
  FROM rng, range({bins}) t(b))
SELECT edges.k AS {key_name}, CAST(edges.b AS INTEGER) AS bin, edges.bin_start, edges.bin_end,
       coalesce(cnt.n, 0) AS num_users
FROM edges LEFT JOIN cnt ON edges.k = cnt.k AND edges.b = cnt.b"""


def _with(template: str, *ctes: str) -> str:
    return template.replace("{ctes}", ",\n".join(CTES[n] for n in _ordered(ctes)) + ",")


def oracle_sql() -> dict[str, str]:
    user, (u1, u2) = P.USER, P.PAIR
    users = _list(P.USER_LIST)
    genres = _list(P.GENRE_LIST)
    frag, year, tfrag, mid = _q(P.GENRE_FRAGMENT), P.YEAR, _q(P.TITLE_FRAGMENT), P.MOVIE_ID
    exact_title = f"(SELECT title FROM movies WHERE movieId = {mid})"
    n_top, bins = P.TOP_N, P.HISTOGRAM_BINS
    round2 = "CAST(round(CAST({x} AS DECIMAL(18,6)), 2) AS DOUBLE)"
    q: dict[str, str] = {}

    # sources and sinks -------------------------------------------------------------------------
    q["scan_movies"] = sql("SELECT * FROM raw_movies_dirty", "raw_movies_dirty")
    q["scan_ratings"] = sql("SELECT * FROM raw_ratings_dirty", "raw_ratings_dirty")
    q["scan_tags"] = sql("SELECT * FROM raw_tags", "raw_tags")
    q["sink_csv_roundtrip"] = sql("SELECT * FROM movies", "movies")
    q["save_tables"] = sql(
        """SELECT 'movies' AS table_name, movieId, CAST(NULL AS INTEGER) AS userId, title || '#' || genres AS text,
       production_year AS day, CAST(NULL AS FLOAT) AS rating FROM movies
UNION ALL SELECT 'ratings', movieId, userId, "timestamp", watching_date, rating FROM ratings
UNION ALL SELECT 'movie_genres', movieId, NULL, genre, NULL, NULL FROM movie_genres""",
        "movies", "ratings", "movie_genres",
    )
    q["export_summaries"] = sql(
        """SELECT 'yearly_movies' AS summary, production_year AS row_key, CAST(count(*) AS DOUBLE) AS row_value FROM movies GROUP BY 2
UNION ALL SELECT 'yearly_genres_movies', production_year || '#' || genre, count(*) FROM
  (SELECT g.genre, m.production_year FROM movies m JOIN movie_genres g ON m.movieId = g.movieId) GROUP BY 2
UNION ALL SELECT 'genres_movies', genre, count(*) FROM movie_genres GROUP BY 2
UNION ALL SELECT 'yearly_watchings', substring(watching_date, 1, 4), count(*) FROM ratings GROUP BY 2
UNION ALL SELECT 'genres_watchings', genre || '#' || n, mean FROM
  (SELECT g.genre, count(*) AS n, CAST(round(CAST(avg(r.rating) AS DECIMAL(18,6)), 2) AS DOUBLE) AS mean
   FROM ratings r JOIN movie_genres g ON r.movieId = g.movieId GROUP BY 1)""",
        "movies", "ratings", "movie_genres",
    )

    # cleaning and model ------------------------------------------------------------------------
    q["clean_ratings"] = sql(
        """SELECT TRY_CAST(userId AS INTEGER) AS userId, TRY_CAST(movieId AS INTEGER) AS movieId,
       TRY_CAST(rating AS FLOAT) AS rating, "timestamp",
       strftime(epoch_ms(TRY_CAST("timestamp" AS BIGINT) * 1000), '%Y-%m-%d') AS watching_date
FROM raw_ratings_dirty
WHERE userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL AND "timestamp" IS NOT NULL
  AND TRY_CAST(userId AS INTEGER) IS NOT NULL AND TRY_CAST(movieId AS INTEGER) IS NOT NULL""",
        "raw_ratings_dirty",
    )
    q["clean_movies"] = sql(
        """SELECT TRY_CAST(movieId AS INTEGER) AS movieId, title, genres,
       substring(rtrim(title), -5, 4) AS production_year
FROM raw_movies_dirty
WHERE movieId IS NOT NULL AND title IS NOT NULL AND genres IS NOT NULL AND TRY_CAST(movieId AS INTEGER) IS NOT NULL""",
        "raw_movies_dirty",
    )
    q["clean_tags"] = sql("SELECT userId, movieId, tag FROM tags WHERE userId IS NOT NULL AND movieId IS NOT NULL", "tags")
    q["movie_genres"] = sql("SELECT movieId, genre FROM movie_genres", "movie_genres")
    q["interactions"] = sql("SELECT userId, movieId, rating FROM interactions", "interactions")
    q["interactions_wide"] = sql("SELECT rating, userId, movieId, title, genre FROM wide", "wide")

    # lookups -----------------------------------------------------------------------------------
    user_rows = """SELECT r.movieId, r.userId, r.rating, r."timestamp", r.watching_date, m.title, m.genres, m.production_year
FROM ratings r JOIN movies m ON r.movieId = m.movieId WHERE r.userId {cond}"""
    q["user_ratings"] = sql(user_rows.format(cond=f"= {user}"), "ratings", "movies")
    q["user_ratings_unknown"] = sql(user_rows.format(cond=f"= {P.UNKNOWN_USER}"), "ratings", "movies")
    q["users_ratings"] = sql(user_rows.format(cond=f"IN ({users})"), "ratings", "movies")
    q["movie_by_id"] = sql(f"SELECT * FROM movies WHERE movieId = {mid}", "movies")
    q["movie_title_contains"] = sql(f"SELECT * FROM movies WHERE strpos(title, {tfrag}) > 0", "movies")
    q["movie_title_exact"] = sql(f"SELECT * FROM movies WHERE title = {exact_title}", "movies")
    q["genre_contains"] = sql(f"SELECT * FROM movies WHERE strpos(genres, {frag}) > 0", "movies")
    q["movies_in_genre_list"] = sql(
        f"""SELECT g.movieId, g.genre, m.title, m.genres, m.production_year
FROM movie_genres g JOIN movies m ON g.movieId = m.movieId WHERE g.genre IN ({genres})""",
        "movies", "movie_genres",
    )
    frag_values = ", ".join(f"({_q(g)})" for g in P.FRAGMENT_LIST)
    q["genre_counts_samples"] = sql(
        f"""SELECT f.fragment, (SELECT count(*) FROM movies c WHERE strpos(c.genres, f.fragment) > 0) AS num_movies,
       s.sample_rank, s.movieId, s.title, s.genres, s.production_year
FROM (VALUES {frag_values}) f(fragment)
LEFT JOIN (SELECT f.fragment, m.*, CAST(row_number() OVER (PARTITION BY f.fragment ORDER BY m.movieId) AS INTEGER) AS sample_rank
      FROM (VALUES {frag_values}) f(fragment) JOIN movies m ON strpos(m.genres, f.fragment) > 0) s
  ON s.fragment = f.fragment AND s.sample_rank <= {P.SAMPLES_PER_GENRE}""",
        "movies",
    )
    q["movies_by_year"] = sql(f"SELECT * FROM movies WHERE ends_with(title, '({year})')", "movies")
    q["titles_by_users"] = sql(f"SELECT DISTINCT title FROM wide WHERE userId IN ({users})", "wide")
    q["titles_in_genres"] = sql(f"SELECT title FROM wide WHERE genre IN ({genres})", "wide")
    q["titles_in_genres_distinct"] = sql(f"SELECT DISTINCT title FROM wide WHERE genre IN ({genres})", "wide")
    asked = ", ".join(f"({u})" for u in P.DETAIL_USERS)
    q["user_detail_totals"] = sql(
        f"""SELECT CAST(a.userId AS INTEGER) AS userId,
       (SELECT count(*) FROM profile g WHERE g.userId = a.userId) AS num_genres,
       (SELECT count(*) FROM ratings r JOIN movies m ON r.movieId = m.movieId WHERE r.userId = a.userId) AS num_movies
FROM (VALUES {asked}) a(userId)""",
        "profile", "ratings", "movies",
    )
    q["user_history"] = sql(
        f"""SELECT r.userId, m.title, r.watching_date, r.rating
FROM ratings r JOIN movies m ON r.movieId = m.movieId WHERE r.userId = {user}""",
        "ratings", "movies",
    )
    q["genre_detail_totals"] = sql(
        f"SELECT {frag} AS genre, count(*) AS num_movies FROM movies WHERE strpos(genres, {frag}) > 0", "movies"
    )

    # aggregations, interaction meaning ---------------------------------------------------------
    q["user_movie_count"] = sql(
        f"SELECT userId, count(DISTINCT movieId) AS moviesWatched FROM wide WHERE userId = {user} GROUP BY userId", "wide"
    )
    q["user_movie_count_all"] = sql("SELECT userId, count(DISTINCT movieId) AS moviesWatched FROM wide GROUP BY userId", "wide")
    q["user_genre_count"] = sql(
        f"SELECT userId, count(DISTINCT genre) AS genresWatched FROM wide WHERE userId = {user} GROUP BY userId", "wide"
    )
    q["user_genre_count_all"] = sql("SELECT userId, count(DISTINCT genre) AS genresWatched FROM wide GROUP BY userId", "wide")
    watch_summary = """SELECT movieId, title, count(DISTINCT userId) AS usersWatchedMovie, avg(rating) AS averageRating
FROM wide WHERE {cond} GROUP BY movieId, title"""
    q["movie_summary_by_id"] = sql(watch_summary.format(cond=f"movieId = {mid}"), "wide")
    q["movie_summary_by_title"] = sql(watch_summary.format(cond=f"strpos(title, {tfrag}) > 0"), "wide")
    q["user_genre_stats"] = sql("SELECT userId, genre, avgRating, watchCount FROM genre_stats", "genre_stats")
    q["user_watch_cutoff"] = sql(
        """SELECT s.userId, s.genre, s.avgRating, s.watchCount, c.avgWatchCount
FROM genre_stats s JOIN cutoff c ON s.userId = c.userId""",
        "genre_stats", "cutoff",
    )
    q["favourite_genres"] = sql(
        "SELECT userId, genre, avgRating, watchCount, avgWatchCount, maxAvgRating FROM favourites", "favourites"
    )
    q["favourite_genres_strict"] = sql(
        """SELECT userId, genre, avgRating, watchCount, avgWatchCount FROM (
  SELECT a.*, rank() OVER (PARTITION BY userId ORDER BY avgRating DESC) AS rk
  FROM above_cutoff a WHERE avgRating IS NOT NULL) WHERE rk = 1""",
        "above_cutoff",
    )
    favourite_one = """SELECT userId, genre AS favouriteGenre FROM (
  SELECT userId, genre, row_number() OVER (PARTITION BY userId ORDER BY watchCount DESC, genre ASC) AS rn
  FROM favourites) WHERE rn = 1"""
    q["favourite_genre_of_user"] = sql(favourite_one + f" AND userId = {user}", "favourites")
    q["favourite_genre_all_users"] = sql(favourite_one, "favourites")
    q["favourite_genre_counts"] = sql(
        "SELECT genre, count(userId) AS favouriteGenreCount FROM favourites GROUP BY genre", "favourites"
    )
    q["genre_user_counts"] = sql('SELECT genre, count(DISTINCT userId) AS "Count" FROM wide GROUP BY genre', "wide")
    q["user_genre_ratings"] = sql(f"SELECT userId, genre, avgRating FROM genre_stats WHERE userId = {user}", "genre_stats")
    q["user_genre_watches"] = sql(f"SELECT userId, genre, watchCount FROM genre_stats WHERE userId = {user}", "genre_stats")
    q["genre_rating_histogram"] = _with(
        _histogram(f"SELECT genre AS k, avgRating AS v FROM genre_stats WHERE genre = {_q(P.HISTOGRAM_GENRE)}", "genre", bins),
        "genre_stats",
    )
    q["genre_rating_histogram_all"] = _with(
        _histogram("SELECT genre AS k, avgRating AS v FROM genre_stats", "genre", bins), "genre_stats"
    )
    q["movie_rating_histogram"] = _with(
        _histogram(
            f"SELECT title AS k, avg(rating) AS v FROM wide WHERE title = {exact_title} GROUP BY userId, title",
            "title",
            bins,
        ),
        "wide", "movies",
    )

    # aggregations, rating meaning --------------------------------------------------------------
    q["movie_summary"] = sql(
        """SELECT r.movieId, avg(r.rating) AS Average_Rating, count(r.movieId) AS Number_OF_Watchings
FROM movies m JOIN ratings r ON m.movieId = r.movieId GROUP BY r.movieId""",
        "movies", "ratings",
    )
    q["movie_summary_detail"] = sql(
        f"""SELECT m.movieId, m.title, m.genres, {round2.format(x="avg(r.rating)")} AS Average_Rating,
       count(r.movieId) AS Number_OF_Watchings
FROM movies m JOIN ratings r ON m.movieId = r.movieId GROUP BY m.movieId, m.title, m.genres""",
        "movies", "ratings",
    )
    q["genre_summary"] = sql(
        """SELECT g.genre, count(g.movieId) AS Number_OF_Watchings, avg(r.rating) AS Average_Rating
FROM movie_genres g JOIN ratings r ON g.movieId = r.movieId GROUP BY g.genre""",
        "movie_genres", "ratings",
    )
    q["user_genre_profile"] = sql(f"SELECT * FROM profile WHERE userId = {user}", "profile")
    q["user_genre_profile_all"] = sql("SELECT * FROM profile", "profile")
    q["user_taste_thresholds"] = sql(
        """SELECT userId, count(*) AS num_genres,
       CASE WHEN count(Average_Rating) > 0
            THEN CAST(sum(CAST(Average_Rating AS DECIMAL(18,2))) AS DOUBLE) / count(Average_Rating) END
         AS avg_rating_threshold,
       CAST(sum(watchings) AS DOUBLE) / count(*) AS avg_watchings_threshold
FROM profile GROUP BY userId""",
        "profile",
    )
    q["movies_per_year"] = sql(
        "SELECT production_year, count(production_year) AS num_of_movies FROM movies GROUP BY production_year", "movies"
    )
    q["genre_movies_per_year"] = sql(
        """SELECT m.production_year, g.genre, count(m.production_year) AS num_of_movies
FROM movies m JOIN movie_genres g ON m.movieId = g.movieId GROUP BY m.production_year, g.genre""",
        "movies", "movie_genres",
    )
    q["movies_per_genre"] = sql(
        """SELECT g.genre, count(g.genre) AS num_of_movies
FROM movie_genres g JOIN movies m ON g.movieId = m.movieId GROUP BY g.genre""",
        "movies", "movie_genres",
    )
    q["ratings_per_year"] = sql(
        """SELECT substring(watching_date, 1, 4) AS watching_year, count(substring(watching_date, 1, 4)) AS num_of_watchings
FROM ratings GROUP BY 1""",
        "ratings",
    )
    q["active_user_days_per_year"] = sql(
        """SELECT substring(watching_date, 1, 4) AS watching_year, count(userId) AS num_of_users
FROM (SELECT DISTINCT userId, watching_date FROM ratings) GROUP BY 1""",
        "ratings",
    )
    q["active_users_per_year"] = sql(
        "SELECT substring(watching_date, 1, 4) AS watching_year, count(DISTINCT userId) AS num_of_users FROM ratings GROUP BY 1",
        "ratings",
    )
    q["ratings_per_genre"] = sql(
        f"""SELECT g.genre, count(g.genre) AS num_of_watchings, {round2.format(x="avg(r.rating)")} AS average_rating
FROM ratings r JOIN movie_genres g ON r.movieId = g.movieId GROUP BY g.genre""",
        "ratings", "movie_genres",
    )
    q["dataset_totals"] = sql(
        """SELECT (SELECT count(DISTINCT userId) FROM ratings) AS num_users,
       (SELECT count(DISTINCT movieId) FROM movies) AS num_movies,
       (SELECT count(DISTINCT genre) FROM movie_genres) AS num_genres,
       (SELECT count(*) FROM ratings) AS num_ratings""",
        "ratings", "movies", "movie_genres",
    )

    # top-k -------------------------------------------------------------------------------------
    q["top_watched"] = sql(
        f"""SELECT r.movieId, r.Number_OF_Watchings, m.title, m.genres, m.production_year
FROM (SELECT movieId, count(movieId) AS Number_OF_Watchings FROM ratings GROUP BY movieId) r
JOIN movies m ON r.movieId = m.movieId
ORDER BY r.Number_OF_Watchings DESC NULLS LAST, r.movieId ASC LIMIT {n_top}""",
        "ratings", "movies",
    )
    q["top_rated"] = sql(
        f"""SELECT r.movieId, r.Average_Rating, m.title, m.genres, m.production_year
FROM (SELECT movieId, avg(rating) AS Average_Rating FROM ratings GROUP BY movieId) r
JOIN movies m ON r.movieId = m.movieId
ORDER BY r.Average_Rating DESC NULLS LAST, r.movieId ASC LIMIT {n_top}""",
        "ratings", "movies",
    )

    # taste -------------------------------------------------------------------------------------
    q["liked_genres"] = sql("SELECT userId, genre, Average_Rating, watchings FROM flags WHERE likes", "flags")
    q["disliked_genres"] = sql("SELECT userId, genre, Average_Rating, watchings FROM flags WHERE dislikes", "flags")
    shared = f"""SELECT a.genre, a.userId AS first_user, b.userId AS second_user,
       a.watchings AS first_watchings, b.watchings AS second_watchings,
       a.Average_Rating AS first_rating, b.Average_Rating AS second_rating
FROM profile a JOIN profile b ON a.genre = b.genre WHERE a.userId = {u1} AND b.userId = {u2}"""
    q["taste_shared"] = sql(shared, "profile")
    only = """SELECT userId, genre, Average_Rating, watchings FROM profile WHERE userId = {a}
  AND genre IN (SELECT genre FROM profile WHERE userId = {a} EXCEPT SELECT genre FROM profile WHERE userId = {b})"""
    q["taste_only_first"] = sql(only.format(a=u1, b=u2), "profile")
    q["taste_only_second"] = sql(only.format(a=u2, b=u1), "profile")
    q["genre_set_except"] = sql(
        f"SELECT genre FROM profile WHERE userId = {u1} EXCEPT SELECT genre FROM profile WHERE userId = {u2}", "profile"
    )
    for key, f1, f2 in (
        ("taste_both_like", "likes", "likes"),
        ("taste_both_dislike", "dislikes", "dislikes"),
        ("taste_like_dislike", "likes", "dislikes"),
        ("taste_dislike_like", "dislikes", "likes"),
    ):
        q[key] = sql(
            f"""SELECT s.* FROM ({shared}) s
WHERE s.genre IN (SELECT genre FROM flags WHERE userId = {u1} AND {f1})
  AND s.genre IN (SELECT genre FROM flags WHERE userId = {u2} AND {f2})""",
            "profile", "flags",
        )
    pair_values = ", ".join(f"({a}, {b})" for a, b in P.TASTE_PAIRS)
    q["taste_pairs"] = sql(
        f"""SELECT a.genre, pr.first_user, pr.second_user, a.watchings AS first_watchings, b.watchings AS second_watchings,
       a.Average_Rating AS first_rating, b.Average_Rating AS second_rating,
       a.likes AS first_likes, a.dislikes AS first_dislikes, b.likes AS second_likes, b.dislikes AS second_dislikes
FROM (VALUES {pair_values}) pr(first_user, second_user)
JOIN flags a ON a.userId = pr.first_user
JOIN flags b ON b.userId = pr.second_user AND b.genre = a.genre""",
        "flags",
    )
    # recommender ---------------------------------------------------------------------------------
    split = f"""split AS (
  SELECT userId, movieId, rating,
         CAST('0x' || substr(md5(userId || ':' || movieId || ':{P.ALS_SEED}'), 1, 8) AS BIGINT) % 100 < 80 AS is_train
  FROM ratings WHERE rating IS NOT NULL),
warm AS (
  SELECT userId, movieId, rating FROM split WHERE NOT is_train
    AND userId IN (SELECT userId FROM split WHERE is_train) AND movieId IN (SELECT movieId FROM split WHERE is_train))"""
    with_split = lambda body: f"WITH {CTES['ratings']},\n{split}\n{body}"
    q["als_split_counts"] = with_split("SELECT is_train, count(*) AS num_ratings FROM split GROUP BY is_train")
    q["als_predicted_records"] = with_split("SELECT userId, movieId, rating FROM warm")
    q["mean_predictor_metrics"] = with_split(
        """SELECT count(*) AS num_predictions, round(avg(e), 6) AS mse, round(sqrt(avg(e)), 6) AS rmse
FROM (SELECT pow(w.rating - m.prediction, 2) AS e FROM warm w
      JOIN (SELECT movieId, avg(rating) AS prediction FROM split WHERE is_train GROUP BY movieId) m ON m.movieId = w.movieId)"""
    )
    q["recommendation_ranks"] = with_split(
        f"""SELECT userId, CAST({P.RECOMMENDATIONS_PER_USER} AS BIGINT) AS num_rows, 1 AS first_rank,
       {P.RECOMMENDATIONS_PER_USER} AS last_rank, CAST({P.RECOMMENDATIONS_PER_USER} AS BIGINT) AS num_movies
FROM (SELECT DISTINCT userId FROM split WHERE is_train AND userId IN ({users}))"""
    )
    q["recommend_all_ranks"] = with_split(
        f"""SELECT userId, CAST({P.RECOMMENDATIONS_PER_USER} AS BIGINT) AS num_rows, 1 AS first_rank,
       {P.RECOMMENDATIONS_PER_USER} AS last_rank, CAST({P.RECOMMENDATIONS_PER_USER} AS BIGINT) AS num_movies
FROM (SELECT DISTINCT userId FROM split WHERE is_train)"""
    )
    sides = lambda key, other: ", ".join(f"sum(CASE WHEN {other} % 4 = {k} THEN 2.0 * rating ELSE 0 END) AS {key}{k}" for k in range(4))
    dot = " + ".join(f"u{k} * v{k}" for k in range(4))
    q["top_inner_products"] = sql(
        f"""SELECT userId, rank, movieId, score FROM (
  SELECT userId, movieId, score, CAST(row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS INTEGER) AS rank
  FROM (SELECT userId, movieId, CAST({dot} AS DOUBLE) AS score
        FROM (SELECT userId, {sides("u", "movieId")} FROM ratings GROUP BY userId),
             (SELECT movieId, {sides("v", "userId")} FROM ratings GROUP BY movieId)))
WHERE rank <= {P.RECOMMENDATIONS_PER_USER}""",
        "ratings",
    )
    q["fold_in_vectors"] = sql(
        f"""SELECT userId, n AS num_ratings, round((t0 * a11 - t1 * a01) / (a00 * a11 - a01 * a01), 6) AS factor_0,
       round((a00 * t1 - a01 * t0) / (a00 * a11 - a01 * a01), 6) AS factor_1
FROM (SELECT userId, count(*) AS n, count(*) * (1 + {P.FOLD_IN_REG}) AS a00, sum(x) AS a01, sum(x * x) + {P.FOLD_IN_REG} * count(*) AS a11,
             sum(rating) AS t0, sum(x * rating) AS t1
      FROM (SELECT userId, CAST(rating AS DOUBLE) AS rating, CAST((movieId % 7) / 8.0 AS DOUBLE) AS x FROM ratings WHERE rating IS NOT NULL)
      GROUP BY userId)""",
        "ratings",
    )
    # the same rows by other ways
    q["indexed_title_contains"], q["indexed_genre_contains"] = q["movie_title_contains"], q["genre_contains"]
    q["indexed_movies_by_year"], q["saved_user_ratings"] = q["movies_by_year"], q["user_ratings"]
    q["report_one_pass"] = q["export_summaries"] + """
UNION ALL SELECT 'yearly_active_users', substring(watching_date, 1, 4), count(*) FROM (SELECT DISTINCT userId, watching_date FROM ratings) GROUP BY 2
UNION ALL SELECT 'totals', 'num_users', count(DISTINCT userId) FROM ratings
UNION ALL SELECT 'totals', 'num_movies', count(DISTINCT movieId) FROM movies
UNION ALL SELECT 'totals', 'num_genres', count(DISTINCT genre) FROM movie_genres
UNION ALL SELECT 'totals', 'num_ratings', count(*) FROM ratings"""
    q["snapshot_tables"], q["interactions_upserted"] = q["save_tables"], q["interactions"]
    first = lambda *cases: "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for r, c in cases) + " ELSE 'none' END"
    missing = lambda *names: [(f"missing {n}", f'"{n}" IS NULL') for n in names]
    bad = lambda name, kind: (f"malformed {name}", f'TRY_CAST("{name}" AS {kind}) IS NULL')
    part = """SELECT '{t}' AS table_name, reason, count(*) AS num_rows, count(*) FILTER (WHERE drops) AS num_dropped
FROM (SELECT {case} AS reason, {drops} AS drops FROM {source}) WHERE reason <> 'none' GROUP BY reason
UNION ALL SELECT '{t}', 'kept', count(*), 0 FROM {source} WHERE NOT ({drops})"""
    sources = {
        "ratings": ("raw_ratings_dirty", [*missing("userId", "movieId", "rating", "timestamp"), bad("userId", "INTEGER"), bad("movieId", "INTEGER")], [bad("rating", "FLOAT"), bad("timestamp", "BIGINT")]),
        "movies": ("raw_movies_dirty", [*missing("movieId", "title", "genres"), bad("movieId", "INTEGER")], []),
        "tags": ("raw_tags", [*missing("userId", "movieId"), bad("userId", "INTEGER"), bad("movieId", "INTEGER")], []),
    }
    parts = [part.format(t=t, case=first(*drops, *changes), drops=" OR ".join(c for _, c in drops), source=source) for t, (source, drops, changes) in sources.items()]
    q["quarantine_counts"] = sql("\nUNION ALL ".join(parts), "raw_ratings_dirty", "raw_movies_dirty", "raw_tags")
    q["sketched_users_per_year"] = sql(
        "SELECT substring(watching_date, 1, 4) AS watching_year, count(DISTINCT userId) AS exact_users, count(*) AS num_ratings, true AS within_bound FROM ratings GROUP BY 1",
        "ratings",
    )
    return q
