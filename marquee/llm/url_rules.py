"""Op 3, URL filters by association rules, with DataFrame functions only.

Listed rules (host and path prefixes) come first. Where none fits, combinations of URL tokens decide that FP-growth
finds together with the label "block" among labelled pages; rules below the support or confidence asked for, or no surer
than chance would make the best of as many, are dropped. Both kinds match by an inverted index: listed rules by host
suffix, mined rules by their rarest token; many mined rules as a table that is joined on it.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import table, written

#: The listed rules of the query: host, path prefix, verdict.
LISTED = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Least share of the labelled URLs and least confidence of a mined rule, and most tokens of its left side.
MIN_SUPPORT, MIN_CONFIDENCE, MAX_TOKENS = 0.002, 0.6, 3
#: Least labelled pages of a rule whatever their number, and most mined rules that go to every row as one map.
MIN_PAGES, MAP_RULES = 5, 4096
#: A token of more than this share of the labelled URLs tells nothing and is not mined.
COMMON = 0.9
BLOCK, ALLOW = "=block", "=allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: words of the host (``h:``) and of the rest (``p:``), numbers as ``#``."""
    words = lambda c: F.filter(F.split(F.regexp_replace(F.lower(c), "[0-9]+", "#"), r"[^\p{L}#]+"), lambda w: w != "")
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    both = F.concat(F.transform(words(host), lambda w: F.concat(F.lit("h:"), w)), F.transform(words(rest), lambda w: F.concat(F.lit("p:"), w)))
    return F.coalesce(F.array_distinct(both), F.array().cast("array<string>"))


def listed_rule(host: Column, path: Column, rules=LISTED) -> Column:
    """The longest rule whose host is the URL's or a parent of it and whose path begins the URL's: (size, rule,
    verdict), or null. The index maps a rule's host to its paths; a URL looks up each suffix of its host."""
    if not rules:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    by_host: dict[str, list] = {}
    for rule_host, rule_path, verdict in rules:
        by_host.setdefault(rule_host, []).append((rule_path, verdict))
    entry = lambda h, p, v: F.struct(F.lit(p).alias("path"), F.lit(len(h) + len(p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))
    index = F.create_map(*[x for h, paths in by_host.items() for x in (F.lit(h), F.array(*[entry(h, p, v) for p, v in paths]))])
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    fitting = F.filter(
        F.flatten(F.transform(F.filter(suffixes, lambda h: F.map_contains_key(index, h)), lambda h: F.element_at(index, h))),
        lambda r: F.startswith(path, r["path"]),
    )
    return F.array_max(F.transform(fitting, lambda r: F.struct(r["size"].alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))


def labelled_urls(pages: DataFrame, labels: DataFrame, page_col: str = "url") -> DataFrame:
    """(tokens, blocked, page: a hash of the URL) of the pages whose document has a label, one row a distinct URL.

    A page shows the document named by the last number of its path. Labels say "block" where any row of the document has
    quality 0 or marks it toxic. Exact copies of a URL count once; URLs that differ in numbers alone are pages of their own.
    """
    number = F.regexp_extract(F.col("url"), r"(?s)^.*?://[^/?#]*[^?#]*?([0-9]+)[^0-9?#]*(?:[?#].*)?$", 1).try_cast("long")
    urls = pages.select(F.col(page_col).cast("string").alias("url")).where("url is not null").select("url", number.alias("doc")).where("doc is not null")
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc")).agg(F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("blocked"))
    return urls.join(known, "doc").select("url", "blocked").distinct().select(F.array_sort(tokens_of(F.col("url"))).alias("tokens"), "blocked", F.xxhash64("url").alias("page"))


def items_of(labelled: DataFrame, least: int, most: float) -> tuple[DataFrame, DataFrame]:
    """(page, blocked, items) of the labelled pages, and (token, item, freq) of the tokens of ``least`` to ``most`` pages.

    Tokens of the very same pages are one item, named by the first: they tell the same, and a long URL that a few pages
    repeat would else make every subset of its tokens an item set. Pages without such tokens have no row.
    """
    pages = labelled.select("page", "blocked", F.explode("tokens").alias("token"))
    low = F.col("page").bitwiseAND(F.lit(0xFFFFFFFF))
    tokens = pages.groupBy("token").agg(F.count(F.lit(1)).alias("freq"), F.bit_xor("page").alias("mark"), F.sum(low).alias("sum"))
    tokens = tokens.where((F.col("freq") >= least) & (F.col("freq") <= most))
    named = tokens.groupBy("freq", "mark", "sum").agg(F.min("token").alias("item"))
    tokens = written(tokens.join(named, ["freq", "mark", "sum"]).select("token", "item", "freq"), "url-tokens")
    items = pages.join(tokens.where("token = item").select("token"), "token").groupBy("page", "blocked").agg(F.collect_set("token").alias("items"))
    return items, tokens


def _ratio(both, with_x, blocked: int, total: int) -> Column:
    """Log-likelihood ratio of pages with a token set and blocked pages."""
    share = blocked / total

    def part(k, n, p):
        return F.when(k > 0, k * F.log(k / (n * F.lit(p)))).otherwise(0.0)

    rest, n_rest = F.lit(blocked) - both, F.lit(total) - with_x
    return 2 * (part(both, with_x, share) + part(with_x - both, with_x, 1 - share) + part(rest, n_rest, share) + part(n_rest - rest, n_rest, 1 - share))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_tokens: int = MAX_TOKENS, min_pages: int = MIN_PAGES) -> DataFrame:
    """Rules (tokens, confidence, support, index_token): token combinations that mean "block".

    A rule stands on ``min_support`` of the labelled pages and on ``min_pages`` at least that are blocked, and its
    log-likelihood ratio is beyond what the best of as many chance sets would reach. The index token is the rarest of
    the left side. A rule is dropped if another one with fewer of its tokens is at least as sure. Of tokens that the
    same pages have, rules of one token name each, longer rules the first. Without labelled URLs, or if all are of one
    label, there are no rules.
    """
    schema = "tokens array<string>, confidence double, support double, index_token string"
    spark = labelled.sparkSession
    labelled = written(labelled.select("page", "tokens", "blocked"), "url-labelled")
    n = labelled.agg(F.count(F.lit(1)).alias("total"), F.count_if("blocked").alias("blocked")).first()
    total, blocked = n["total"], n["blocked"]
    if not 0 < blocked < total:
        return spark.createDataFrame([], schema)
    least = max(min_pages, math.ceil(min_support * total - 1e-9))
    items, tokens = items_of(labelled, least, COMMON * total)
    items = items.select(F.array_append("items", F.when(F.col("blocked"), BLOCK).otherwise(ALLOW)).alias("items"))
    sets = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / max(1, items.count()))).fit(items).freqItemsets
    sets = written(sets.where((F.size("items") <= max_tokens + 1) & ~F.array_contains("items", ALLOW)), "url-sets")
    is_block = F.array_contains("items", BLOCK)
    left = sets.where(~is_block & (F.size("items") <= max_tokens)).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("n"))
    both = sets.where(is_block & (F.size("items") > 1)).select(F.array_sort(F.array_remove("items", BLOCK)).alias("tokens"), F.col("freq").alias("k"))
    bound = 2 * math.log(max(2, left.count())) + 4
    sure = F.col("k") / F.col("n")
    found = left.join(both, "tokens").where((sure >= min_confidence) & (sure > blocked / total) & (_ratio(F.col("k"), F.col("n"), blocked, total) >= bound))
    found = written(found.select("tokens", sure.alias("confidence"), (F.col("k") / F.lit(total)).alias("support")), "url-rules")
    rarest = found.select("tokens", F.explode("tokens").alias("token")).join(tokens, "token").groupBy("tokens").agg(F.min_by("token", F.struct("freq", "token")).alias("index_token"))
    # a smaller rule shares some token with a larger one, so an equi-join on tokens finds all pairs
    small = found.select(F.col("tokens").alias("less"), F.col("confidence").alias("as_sure"), F.explode("tokens").alias("token"))
    implied = (
        found.select("tokens", "confidence", F.explode("tokens").alias("token")).join(small, "token")
        .where((F.size("less") < F.size("tokens")) & (F.col("as_sure") >= F.col("confidence")) & (F.size(F.array_except("less", "tokens")) == 0))
        .select("tokens").distinct()
    )
    rules = written(found.join(implied, "tokens", "left_anti").join(rarest, "tokens").select("tokens", "confidence", "support", "index_token"), "url-rules")
    single = rules.where(F.size("tokens") == 1).withColumn("item", F.element_at("tokens", 1))
    others = single.join(tokens.where("token != item").select("item", "token"), "item").select(F.array("token").alias("tokens"), "confidence", "support", F.col("token").alias("index_token"))
    return rules.unionByName(others)


def judge_urls(pages: DataFrame, rules: DataFrame, listed=LISTED, id_col: str = "page_id", url_col: str = "url", map_rules: int = MAP_RULES) -> DataFrame:
    """One row per page row: page_id, host, path, rule (listed, or null), verdict, confidence (of the mined rule that
    blocks, or null).

    A null URL or one without ``://`` has an empty host and path and no tokens, fits no rule and is allowed. Repeated rows
    are judged alike. Other columns are not read. Up to ``map_rules`` mined rules reach every row as one map; more are a
    table that distinct token sets are joined with, on the rules' index tokens.
    """
    entry = F.struct("tokens", "confidence")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "tokens": tokens_of(F.col("url"))})
    rows = rows.withColumn("hit", listed_rule(F.col("host"), F.col("path"), listed))
    if rules.count() <= map_rules:
        index = rules.groupBy("index_token").agg(F.collect_list(entry).alias("rules")).agg(F.map_from_entries(F.collect_list(F.struct("index_token", "rules")))).scalar()
        rows, tokens = rows.withColumn("mined", index), F.col("tokens")
        near = F.flatten(F.transform(F.filter(tokens, lambda t: F.map_contains_key(F.col("mined"), t)), lambda t: F.element_at(F.col("mined"), t)))
        sure = F.array_max(F.transform(F.filter(near, lambda r: F.size(F.array_except(r["tokens"], tokens)) == 0), lambda r: r["confidence"]))
    else:
        own = rows.where(F.col("hit").isNull() & (F.size("tokens") > 0)).select("tokens").distinct()
        left = rules.select(F.col("tokens").alias("left"), "confidence", "index_token")
        fits = own.select("tokens", F.explode("tokens").alias("index_token")).join(left, "index_token").where(F.size(F.array_except("left", "tokens")) == 0)
        rows, sure = rows.join(fits.groupBy("tokens").agg(F.max("confidence").alias("sure")), "tokens", "left"), F.col("sure")
    mined = F.when(F.col("hit").isNull(), sure)
    return rows.select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), F.when(mined.isNotNull(), "block").otherwise("allow")).alias("verdict"),
        mined.alias("confidence"),
    )


def op3(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return judge_urls(pages, mine_rules(labelled_urls(pages, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))))
