"""URL filter: host and path rules first, then a logistic regression on hashed character n-grams.

Built from DataFrame and SQL functions only. The features of a URL are the ``GRAM``-character n-grams of its host and of its
path, kept apart and with all digits read as 0, hashed to ``BUCKETS`` places and counted as present or absent, scaled by one over the root of their number.
Host and path are judged each by its own n-grams and the larger probability counts, so a long path takes nothing from its host. The regression
is trained on a small table of labelled hosts and paths by full-batch gradient steps with momentum; each step is one aggregation over
that table, and only the ``BUCKETS`` weights pass through the driver.

A rule (host, path prefix, verdict) fits its host and all subdomains if the URL's path starts with its path; the longest
rule wins, then the one with the longer host.

Defined results: a null URL, or one without ``://``, has an empty host and path; no rule fits it and the regression judges it from
its bias alone. Repeated rows give repeated results; other columns than page_id and url are not read. Without labelled URLs of both kinds every weight stays 0 and
the verdict is allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm import frames

BUCKETS = 16384
GRAM = 4
STEPS = 40
RATE = 4.0
MOMENTUM = 0.9
RIDGE = 1e-4
# Share of the loss that goes to the labelled URLs to block: without evidence a URL is allowed.
BLOCK_SHARE = 0.25
# A URL is blocked above this probability; hosts without any known n-gram come close to one half.
BLOCK_ABOVE = 0.58
# The small labelled table is made of these words: hosts of two words, or of one and a plain ending, at neutral addresses.
BLOCK_WORDS = (
    "casino", "bets", "poker", "slots", "jackpot", "pills", "viagra", "cheap", "free", "adult", "porn", "escort", "cams", "spam",
    "farm", "ads", "track", "click", "win", "loans", "payday", "replica", "crack", "warez", "torrent", "x",
)
ALLOW_WORDS = (
    "news", "daily", "times", "journal", "school", "city", "museum", "library", "garden", "kitchen", "travel", "music", "health",
    "science", "history", "weather", "sport", "market", "forum", "photo", "river", "north", "house", "paper", "stone", "green",
)
PATHS = ("/", "/en/1204", "/de/88.html", "/fr/3301/", "/es/517", "/about", "/2024/05/post.html", "/index.php")
# Frames of paths whose sign is in their words, short and long, for both kinds.
PATH_FRAMES = ("/{0}-{1}", "/en/{0}-{1}.html", "/2024/05/page/section/{0}-{1}/archive/index/{2}-{3}/entry/1204.html")
# Rules of the registered query: (host, path prefix, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        chosen = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def places(host: Column, path: Column) -> Column:
    """Distinct hashed places of the n-grams of host and path; texts are marked at both ends, so each has some."""

    def of(text: Column, kind: str) -> Column:
        marked = F.concat(F.lit("^"), F.translate(text, "123456789", "000000000"), F.lit("$"))
        count = F.greatest(F.length(marked) - (GRAM - 1), F.lit(1))
        gram = lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(marked, i, F.lit(GRAM))), F.lit(BUCKETS)).cast("int")
        return F.transform(F.sequence(F.lit(1), count), gram)

    both = F.array_distinct(F.concat(of(host, "host"), of(path, "path")))
    return F.when((host != "") | (path != ""), both).otherwise(F.array().cast("array<int>"))


def _vector(values: list[float]) -> Column:
    """The weights as one constant array."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def margin(where: Column, weights: list[float], bias: float) -> Column:
    total = F.aggregate(where, F.lit(0.0), lambda s, i: s + F.get(_vector(weights), i))
    return F.lit(bias) + total / F.sqrt(F.greatest(F.size(where), F.lit(1)))


def train(labelled: DataFrame, steps: int = STEPS) -> tuple[list[float], float]:
    """(weights, bias) from rows (host, path, label 0/1, 1 for block); 1 has ``BLOCK_SHARE`` of the weight."""
    known = frames.store(labelled.select(F.col("label").cast("double").alias("label"), places(F.col("host"), F.col("path")).alias("at")), "urls")
    of_class = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    weights, bias = [0.0] * BUCKETS, 0.0
    if len(of_class) < 2:
        return weights, bias
    share = F.when(F.col("label") == 1.0, BLOCK_SHARE / of_class[1.0]).otherwise((1 - BLOCK_SHARE) / of_class[0.0])
    moved, moved_bias = [0.0] * BUCKETS, 0.0
    for _ in range(steps):
        miss = (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(F.col("at"), weights, bias))) - F.col("label")) * share
        parts = known.select(
            F.explode(F.concat("at", F.array(F.lit(-1)))).alias("place"),
            miss.alias("miss"), F.sqrt(F.greatest(F.size("at"), F.lit(1))).alias("root"))
        slope = parts.groupBy("place").agg(F.sum(F.when(F.col("place") < 0, F.col("miss")).otherwise(F.col("miss") / F.col("root"))).alias("g"))
        slopes = {row["place"]: row["g"] for row in slope.collect()}
        moved_bias = MOMENTUM * moved_bias - RATE * slopes.get(-1, 0.0)
        bias += moved_bias
        for i in range(BUCKETS):
            moved[i] = MOMENTUM * moved[i] - RATE * (slopes.get(i, 0.0) + RIDGE * weights[i])
            weights[i] += moved[i]
    return weights, bias


def parts(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(page_id, url, host, path, fits) with ``fits`` the rule that decides, if any."""
    split = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return split.withColumn("fits", best_rule(F.col("host"), F.col("path"), rules))


def labelled_table(spark: SparkSession) -> DataFrame:
    """(host, path, label): the small labelled table, 1 for what is to be blocked. A row has a host or a path.

    Both kinds share their prefixes, ends and the frames of their paths; paths without a sign are to be allowed.
    """
    rows = [("", path, 0) for path in PATHS]
    for words, label in ((BLOCK_WORDS, 1), (ALLOW_WORDS, 0)):
        for i, word in enumerate(words):
            names = [f"{word}-{words[(i + step) % len(words)]}" for step in (1, 3, 7)] + [f"{word}{words[(i + 2) % len(words)]}"]
            for j, name in enumerate(names):
                prefix, end = ("", "www.", "blog.", "m.")[(i + j) % 4], ("com", "net", "org")[(i + j) % 3]
                rows.append((f"{prefix}{name}.example.{end}", "", label))
            near = [words[(i + step) % len(words)] for step in (0, 1, 3, 7)]
            rows += [("", frame.format(*near), label) for frame in PATH_FRAMES]
    return spark.createDataFrame(rows, "host string, path string, label int")


def judge(split: DataFrame, weights: list[float], bias: float) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): the rule's verdict, else block from a probability above ``BLOCK_ABOVE``."""
    none = F.lit("")
    of_host = F.when(F.col("host") != "", margin(places(F.col("host"), none), weights, bias))
    of_path = F.when(F.col("path") != "", margin(places(none, F.col("path")), weights, bias))
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.coalesce(F.greatest(of_host, of_path), F.lit(bias))))
    learned = F.when(F.col("score") > BLOCK_ABOVE, "block").otherwise("allow")
    return split.withColumn("score", chance).select(
        "page_id", "host", "path", F.col("fits.rule").alias("rule"),
        F.coalesce(F.col("fits.verdict"), learned).alias("verdict"), "score")


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    split = parts(frames.table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return judge(split, *train(labelled_table(spark)))
