"""StructTypes of the raw (all string, as read from CSV with a header) and the typed tables."""

from pyspark.sql.types import IntegerType, StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


RAW_MOVIES = _strings("movieId", "title", "genres")
RAW_RATINGS = _strings("userId", "movieId", "rating", "timestamp")
RAW_TAGS = _strings("userId", "movieId", "tag", "timestamp")

MOVIES = StructType(
    [
        StructField("movieId", IntegerType(), True),
        StructField("title", StringType(), True),
        StructField("genres", StringType(), True),
        StructField("production_year", StringType(), True),
    ]
)

#: How CSV text is read and written: quotes inside a quoted field are doubled, outer spaces stay, a null is ``\\N`` so that
#: empty text (written ``""``) stays empty text. An unquoted empty field of a foreign file reads as null.
CSV_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "mode": "PERMISSIVE",
}
