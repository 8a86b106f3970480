"""A bundle of the cleaned tables and the interaction tables, built lazily from raw frames.

Nothing is computed until a query runs. ``reuse()`` keeps the frames that many queries read (movies, ratings,
wide table) for a session of queries: ``persist`` (memory and disk; lost blocks are recomputed from lineage) or
``checkpoint`` (written to the shared checkpoint folder, so lineage is cut and executor loss costs no recompute).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from marquee.operators import text_index
from marquee.operators.clean import clean_movies, clean_ratings, clean_tags, movie_genres
from marquee.operators.model import interaction_genres, interactions, interactions_wide
from marquee.session import checkpoint_root
from marquee.sinks import save_by_id, save_tables
from marquee.sources import adapter
from marquee.sources.files import load_dataset


_SOURCE_TABLES = ("movies", "ratings", "tags")

#: Rating and tag records a task multiplies by genres at once, and records up to which the join's own partitions do.
RECORDS_PER_TASK, FEW_RECORDS = 200_000, 2_000_000


@dataclass
class MovieTables:
    raw_ratings: DataFrame | None
    raw_movies: DataFrame | None
    raw_tags: DataFrame | None
    sources: tuple[DataFrame, ...] = ()  # file scans with a row or more for each rating and tag, to size tasks by
    _kept: list[DataFrame] = field(default_factory=list, repr=False)

    @classmethod
    def from_csv(cls, spark: SparkSession, base_path: str) -> MovieTables:
        ratings, movies, tags = load_dataset(spark, base_path)
        return cls(ratings, movies, tags)

    @classmethod
    def from_driver_tables(
        cls,
        spark: SparkSession,
        sf_dir: str,
        dirty: bool = False,
        user_ids: Iterable[int] | None = None,
        movie_ids: Iterable[int] | None = None,
    ) -> MovieTables:
        """``user_ids`` and ``movie_ids`` limit the ratings, tags (users) and movies to what a lookup is about, as filters
        that reach the Parquet reader."""
        whole = user_ids is None and movie_ids is None
        return cls(
            adapter.raw_ratings(spark, sf_dir, dirty, user_ids, movie_ids),
            adapter.raw_movies(spark, sf_dir, dirty, movie_ids),
            adapter.raw_tags(spark, sf_dir, user_ids),
            tuple(adapter.read_table(spark, sf_dir, name) for name in ("lineitem", "events")) if whole else (),
        )

    @classmethod
    def from_clean_tables(cls, spark: SparkSession, base_path: str) -> MovieTables:
        """Cleaned tables written by ``save_clean`` (typed Parquet): clean once, query many times. Filters on
        ids then reach the Parquet reader as pushed filters and only the used columns are read."""
        base = base_path.rstrip("/")
        t = cls(None, None, None)
        for name in _SOURCE_TABLES:
            t.__dict__[name] = spark.read.parquet(f"{base}/{name}")
        return t

    def save_clean(self, base_path: str) -> dict[str, str]:
        """Write the cleaned movies, ratings and tags as Parquet under ``base_path``."""
        return save_tables({name: getattr(self, name) for name in _SOURCE_TABLES}, base_path)

    def save_for_lookups(self, base_path: str, files: int | None = None, indexes: tuple[str, ...] = ("title", "genres")) -> dict[str, str]:
        """``save_clean`` with the tables laid out by id (ratings and tags by user, movies by movie) and trigram indexes of
        columns of the movies beside them: ``from_clean_tables`` reads the tables, ``operators.text_index`` the indexes."""
        base = base_path.rstrip("/")
        paths = {
            "movies": save_by_id(self.movies, f"{base}/movies", "movieId", files=files),
            "ratings": save_by_id(self.ratings, f"{base}/ratings", "userId", "movieId", files=files),
            "tags": save_by_id(self.tags, f"{base}/tags", "userId", "movieId", files=files),
        }
        saved = self.movies.sparkSession.read.parquet(paths["movies"])
        for column in indexes:
            paths[f"{column}_index"] = text_index.build(saved, "movieId", column, f"{base}/{column}_index", files)
        return paths

    @cached_property
    def ratings(self) -> DataFrame:
        return clean_ratings(self.raw_ratings)

    @cached_property
    def movies(self) -> DataFrame:
        return clean_movies(self.raw_movies)

    @cached_property
    def tags(self) -> DataFrame:
        return clean_tags(self.raw_tags)

    @cached_property
    def movie_genres(self) -> DataFrame:
        return movie_genres(self.movies)

    @cached_property
    def interactions(self) -> DataFrame:
        return interactions(self.ratings, self.tags)

    @cached_property
    def wide(self) -> DataFrame:
        return interactions_wide(self.interactions, self.movies)

    @cached_property
    def genre_rows(self) -> DataFrame:
        """The wide table with repeated genre parts folded into a weight (``model.interaction_genres``)."""
        return interaction_genres(self.interactions, self.movies)

    @cached_property
    def spread_genre_rows(self) -> DataFrame:
        """``genre_rows`` for queries about all users and genres: dealt over ``tasks`` before rows multiply by genres."""
        return self.genre_rows if self.tasks is None else interaction_genres(self.interactions, self.movies, self.tasks)

    @cached_property
    def tasks(self) -> int | None:
        """Tasks for steps that multiply ratings or tags by genres, in proportion to the records; None for few records or
        tables of unknown size. Counts the source files' rows, which Parquet keeps in its footers."""
        records = sum(df.count() for df in self.sources)
        if records <= FEW_RECORDS:
            return None
        return max(-(-records // RECORDS_PER_TASK), self.sources[0].sparkSession.sparkContext.defaultParallelism)

    def reuse(
        self,
        how: str = "persist",
        names: tuple[str, ...] = ("movies", "ratings", "genre_rows"),
        spread_to: int | None = None,
    ) -> MovieTables:
        """Keep the named frames for many queries; ``how`` is ``persist`` or ``checkpoint``.

        ``spread_to`` spreads the kept source tables (movies, ratings, tags) round-robin over that many
        partitions first. Source tables are partitioned by file splits, and a small file written as one row
        group is one split, so one task would do all later work on it; outputs of a shuffle are never
        re-spread. Round-robin has no key, so it cannot concentrate a hot user or movie.
        """
        if how == "checkpoint":
            checkpoint_root(self.ratings.sparkSession)
        for name in names:
            df = getattr(self, name)
            if spread_to and name in _SOURCE_TABLES:
                df = df.repartition(spread_to)
            if how == "checkpoint":
                kept = df.checkpoint(eager=True)
            else:
                kept = df.persist(StorageLevel.MEMORY_AND_DISK)
                self._kept.append(kept)
            self.__dict__[name] = kept
            if name == "genre_rows":
                self.__dict__["spread_genre_rows"] = kept
        return self

    def release(self) -> None:
        for df in self._kept:
            df.unpersist()
        self._kept.clear()
