"""Query constants of the registered queries (the same values in the Spark calls and in the SQL)."""

# Chosen so every query has rows at every scale of the driver's tables.
USER = 1
PAIR = (1, 5)
TASTE_PAIRS = ((1, 5), (1, 3), (3, 5))
USER_LIST = (1, 3, 5)
GENRE_LIST = ("red", "PROMO", "Brand#1")
GENRE_FRAGMENT = "ring"
HISTOGRAM_GENRE = "red"
YEAR = 1975
TITLE_FRAGMENT = "widget"
MOVIE_ID = 1  # the exact-title lookup uses the title of this movie
UNKNOWN_USER = 99999999
DETAIL_USERS = (1, 3, 5, UNKNOWN_USER)  # a user without ratings has a row of zeros
FRAGMENT_LIST = ("red", "PROMO", "Brand#1", "no such genre")  # the last matches nothing and has a count of 0
TOP_N = 20
SAMPLES_PER_GENRE = 5
HISTOGRAM_BINS = 10
RECOMMENDATIONS_PER_USER = 10
ALS_SEED = 42
FOLD_IN_REG = 0.25
