"""Column expressions shared by the operators. All are built-in Spark functions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data format.
GENRE_SEPARATOR_REGEX = "[|]"  # genres are pipe-separated
DATE_TEXT_FORMAT = "yyyy-MM-dd"  # watching_date text
SECONDS_PER_DAY = 86400
DAYS_WITH_DATE = (-719162, 2932896)  # 0001-01-01 and 9999-12-31 as days from 1970-01-01
YEAR_SUFFIX_PATTERN = r"\((\d{4})\)\s*$"  # strict form of "title ends in (YYYY)"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(text: str | Column) -> Column:
    """Epoch-seconds text to bigint; malformed text gives null instead of an error."""
    return col_of(text).try_cast("bigint")


def epoch_seconds_of_ntz(ts: str | Column) -> Column:
    """Whole seconds from 1970-01-01 to a timestamp without zone, read as UTC: days times 86400 plus the time of
    day, all fields of the local value, so no session zone (or its daylight saving) takes part."""
    t = col_of(ts)
    days = F.unix_date(t.cast("date")).cast("bigint")
    return days * F.lit(SECONDS_PER_DAY) + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def epoch_to_date_text(seconds: Column) -> Column:
    """``yyyy-MM-dd`` of epoch seconds in UTC; whole-number day arithmetic, so the session zone plays no part. Seconds
    outside the years 1 to 9999 have no date: null."""
    whole = F.call_function("div", seconds, F.lit(SECONDS_PER_DAY).cast("bigint"))
    days = F.when(seconds % SECONDS_PER_DAY < 0, whole - 1).otherwise(whole)
    return F.date_format(F.date_from_unix_date(F.when(days.between(*DAYS_WITH_DATE), days).cast("int")), DATE_TEXT_FORMAT)


def production_year(title: str | Column) -> Column:
    """Four characters ending one before the last of the right-trimmed title (``"Heat (1995) "`` -> ``1995``).

    A title without a year gives whatever four characters stand there, as the source rule does.
    """
    return F.substring(F.rtrim(col_of(title)), -5, 4)


def strict_year(title: str | Column) -> Column:
    """The year only when the title really ends in ``(YYYY)``, else null."""
    return F.nullif(F.regexp_extract(col_of(title), YEAR_SUFFIX_PATTERN, 1), F.lit(""))


def split_genres(genres: str | Column) -> Column:
    """Pipe-separated text to an array; empty parts and repeats are kept."""
    return F.split(col_of(genres), GENRE_SEPARATOR_REGEX)


def round2(x: str | Column) -> Column:
    """Round half up to 2 decimals through a decimal, so ``1.005`` gives ``1.01`` on every engine."""
    return F.round(col_of(x).cast("decimal(18,6)"), 2).cast("double")


def as_cents(x: str | Column) -> Column:
    """A 2-decimal double (from ``round2``) back to an exact decimal for threshold arithmetic."""
    return col_of(x).cast("decimal(18,2)")


def year_of_date_text(date_text: str | Column) -> Column:
    return F.substring(col_of(date_text), 1, 4)


def histogram_edge(i: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Edge ``i`` of ``bins`` equal bins over ``[lo, hi]``: ``i * ((hi - lo) / bins) + lo``, the last edge ``hi``
    (the same arithmetic as numpy's ``linspace``)."""
    return F.when(i >= F.lit(bins), hi).otherwise(i * ((hi - lo) / F.lit(bins)) + lo)


def histogram_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin index in ``[0, bins)`` of equal-width bins over ``[lo, hi]``, as numpy's ``histogram`` assigns it: the
    index from ``(x - lo) / (hi - lo) * bins`` (the top value in the last bin), then moved down when ``x`` lies
    below its bin's start edge, or up when it reaches the next edge, so a value on an edge opens the upper bin."""
    base = F.least(F.floor((x - lo) / (hi - lo) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    down = x < histogram_edge(base, lo, hi, bins)
    up = (base != F.lit(bins - 1)) & (x >= histogram_edge(base + 1, lo, hi, bins))
    return F.when(down, base - 1).when(up, base + 1).otherwise(base)
