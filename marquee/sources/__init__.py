from marquee.sources.adapter import raw_movies, raw_ratings, raw_tags, read_table
from marquee.sources.files import load_dataset, scan_csv, scan_movies, scan_ratings, scan_tags

__all__ = [
    "load_dataset",
    "raw_movies",
    "raw_ratings",
    "raw_tags",
    "read_table",
    "scan_csv",
    "scan_movies",
    "scan_ratings",
    "scan_tags",
]
