from marquee.functions.columns import (
    as_cents,
    epoch_seconds,
    epoch_seconds_of_ntz,
    epoch_to_date_text,
    histogram_bin,
    production_year,
    round2,
    split_genres,
    strict_year,
    year_of_date_text,
)

__all__ = [
    "as_cents",
    "epoch_seconds",
    "epoch_seconds_of_ntz",
    "epoch_to_date_text",
    "histogram_bin",
    "production_year",
    "round2",
    "split_genres",
    "strict_year",
    "year_of_date_text",
]
