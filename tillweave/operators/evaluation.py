"""Summaries of scored, labelled pairs: similarity, estimation error, survival, thresholds, cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Grids of the published evaluation.
ESTIMATE_SIZES = (32, 64, 128, 256)
SCORE_THRESHOLDS = (0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90)
EVAL_THRESHOLDS = (0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95)
COST_RATIOS = (10, 50, 100)
BIN_EDGES = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
MATCH_THRESHOLD = 0.50

MEASURES = ("word3_jaccard", "word5_jaccard", "char5_jaccard")


def label_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("label").agg(F.count("*").alias("pairs"))


def percentile_of(rows: DataFrame, keys: list[str], value: str, point: float, name: str, bins: int = 1024) -> DataFrame:
    """(keys, name): exact percentile with linear interpolation of values in [0, 1], without all values of a group in one task.

    Counts per fixed bin tell which bins hold the two ranks around the percentile; only the values of those bins are put in order.
    """
    freq = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    freq = freq.withColumn("bin", F.floor(F.col(value) * bins))
    in_order = Window.partitionBy(*keys).orderBy("bin")
    counts = freq.groupBy(*keys, "bin").agg(F.sum("n").alias("inside"))
    place = F.sum("inside").over(Window.partitionBy(*keys)) - 1
    ranked = counts.select(
        *keys, "bin", (F.sum("inside").over(in_order) - F.col("inside")).alias("before"), "inside", (place * F.lit(point)).alias("rank"))
    holds = lambda rank: (F.col("before") <= rank) & (rank < F.col("before") + F.col("inside"))
    wanted = ranked.where(holds(F.floor("rank")) | holds(F.ceil("rank"))).drop("inside")
    in_bin = Window.partitionBy(*keys, "bin").orderBy(value)
    values = freq.join(wanted, [*keys, "bin"]).select(
        *keys, value, "rank", "n", (F.col("before") + F.sum("n").over(in_bin) - F.col("n")).alias("first"))
    at = lambda rank: F.max(F.when((F.col("first") <= rank) & (rank < F.col("first") + F.col("n")), F.col(value)))
    found = values.groupBy(*keys, "rank").agg(at(F.floor("rank")).alias("low"), at(F.ceil("rank")).alias("high"))
    part = F.col("rank") - F.floor("rank")
    return found.select(*keys, F.round(F.col("low") + (F.col("high") - F.col("low")) * part, 6).alias(name))


def similarity_summary(scored: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Count, mean, median, min and max of every measure per label."""
    long = scored.select("label", F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures
    ])))
    keys = ["measure", "label"]
    summary = long.groupBy(*keys).agg(
        F.count("value").alias("count"), F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.min("value"), 6).alias("min"), F.round(F.max("value"), 6).alias("max"),
    )
    return summary.join(percentile_of(long, keys, "value", 0.5, "median"), keys, "left")


def pair_extremes(scored: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most alike different pairs, and the least and most alike same pairs, by word 5-grams."""
    def top(kind: str, label: str, order: Column) -> DataFrame:
        ranked = scored.where(F.col("label") == label).orderBy(order, "id_a", "id_b").limit(n)
        return ranked.select(F.lit(kind).alias("kind"), "id_a", "id_b", "word5_jaccard")

    score = F.col("word5_jaccard")
    return (
        top("different_highest", "different", score.desc())
        .unionByName(top("same_lowest", "same", score.asc()))
        .unionByName(top("same_highest", "same", score.desc()))
    )


def estimate_errors(estimated: DataFrame, sizes: tuple[int, ...] = ESTIMATE_SIZES) -> DataFrame:
    """Rows (pair, signature_size, estimate, error) from the wide estimates and the exact ``jaccard``."""
    entries = F.array(*[
        F.struct(
            F.lit(k).alias("signature_size"), F.col(f"minhash_{k}").alias("estimate"),
            F.abs(F.col(f"minhash_{k}") - F.col("jaccard")).alias("error"),
        )
        for k in sizes
    ])
    return estimated.select("id_a", "id_b", "label", "jaccard", F.inline(entries))


def error_summary(errors: DataFrame) -> DataFrame:
    error = F.col("error")
    summary = errors.groupBy("signature_size").agg(
        F.round(F.avg(error), 6).alias("mae"),
        F.round(F.sqrt(F.avg(error * error)), 6).alias("rmse"),
        F.round(F.max(error), 6).alias("max_absolute_error"),
    )
    high = percentile_of(errors, ["signature_size"], "error", 0.95, "p95_absolute_error")
    return summary.join(high, "signature_size", "left")


def error_by_label(errors: DataFrame) -> DataFrame:
    keys = ["signature_size", "label"]
    summary = errors.groupBy(*keys).agg(
        F.count("error").alias("count"), F.round(F.avg("error"), 6).alias("mean"), F.round(F.max("error"), 6).alias("max"),
    )
    return summary.join(percentile_of(errors, keys, "error", 0.5, "median"), keys, "left")


def worst_errors(errors: DataFrame, n: int = 5) -> DataFrame:
    worst_first = Window.partitionBy("signature_size").orderBy(F.desc("error"), "id_a", "id_b")
    ranked = errors.withColumn("place", F.row_number().over(worst_first)).where(F.col("place") <= n)
    return ranked.select("signature_size", "place", "id_a", "id_b", "label", "jaccard", "estimate", "error")


def bin_number(value: Column) -> Column:
    """Index of the right-closed bin; the first bin also holds the lowest edge."""
    bins = F.when(value <= BIN_EDGES[1], 0)
    for i, edge in enumerate(BIN_EDGES[2:], start=1):
        bins = bins.when(value <= edge, i)
    return bins


def bin_label(i: int) -> str:
    low = "-0.001" if i == 0 else str(BIN_EDGES[i])
    return f"({low}, {BIN_EDGES[i + 1]}]"


def survival_by_bin(survived: DataFrame) -> DataFrame:
    """Pairs, survivors and rate per configuration and similarity bin; bins without pairs are kept.

    ``survived`` carries the exact ``jaccard``. The empty bins come in as rows that count nothing.
    """
    count = len(BIN_EDGES) - 1
    seen = survived.select(
        "configuration", bin_number(F.col("jaccard")).alias("bin"),
        F.lit(1).alias("pair"), F.col("candidate_survived").cast("int").alias("hit"),
    )
    names = seen.select("configuration").distinct()
    spine = names.select(
        "configuration", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("bin"),
        F.lit(0).alias("pair"), F.lit(0).alias("hit"),
    )
    labels = F.array(*[F.lit(bin_label(i)) for i in range(count)])
    return (
        seen.unionByName(spine)
        .groupBy("configuration", "bin")
        .agg(F.sum("pair").alias("pairs"), F.sum("hit").alias("survived"))
        .select(
            "configuration", "bin", labels[F.col("bin")].alias("similarity_bin"), "pairs", "survived",
            F.round(F.try_divide(F.col("survived") * 100.0, F.col("pairs")), 2).alias("survival_rate"),
        )
    )


def survival_curve(by_bin: DataFrame) -> DataFrame:
    """Bin midpoint and survival probability, read back from the bin labels."""
    edge = lambda i: F.regexp_extract("similarity_bin", r"(-?\d+\.?\d*), (-?\d+\.?\d*)", i).cast("double")
    return by_bin.select(
        "configuration", "similarity_bin",
        F.round((edge(1) + edge(2)) / 2, 6).alias("similarity_midpoint"),
        F.round(F.col("survival_rate") / 100, 6).alias("survival_prob"),
    )


def threshold_counts(scored: DataFrame, grid: tuple[float, ...] = SCORE_THRESHOLDS) -> DataFrame:
    """Scored pairs at or above each threshold, all thresholds in one pass."""
    totals = scored.agg(*[F.count(F.when(F.col("jaccard") >= t, 1)).alias(f"t{i}") for i, t in enumerate(grid)])
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{i}").alias("pairs")) for i, t in enumerate(grid)])
    return totals.select(F.inline(rows))


def threshold_eval(scored: DataFrame, grid: tuple[float, ...] = EVAL_THRESHOLDS) -> DataFrame:
    """Confusion counts, precision, recall and F1 per threshold; 0 where a denominator is 0."""
    totals = scored.agg(*[
        F.count(F.when((F.col("label") == label) & (F.col("jaccard") >= t), 1)).alias(f"{label}_{i}")
        for i, t in enumerate(grid) for label in ("same", "different")
    ], *[F.count(F.when(F.col("label") == label, 1)).alias(label) for label in ("same", "different")])
    rows = F.array(*[
        F.struct(
            F.lit(t).alias("threshold"), F.col(f"same_{i}").alias("tp"), F.col(f"different_{i}").alias("fp"),
            (F.col("different") - F.col(f"different_{i}")).alias("tn"), (F.col("same") - F.col(f"same_{i}")).alias("fn"),
        )
        for i, t in enumerate(grid)
    ])
    safe = lambda top, bottom: F.coalesce(F.try_divide(top, bottom), F.lit(0.0))
    counted = totals.select(F.inline(rows)).select(
        "*",
        safe(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    )
    both = F.col("precision") + F.col("recall")
    return counted.withColumn("f1", safe(F.col("precision") * F.col("recall") * 2, both))


def cost_curve(evaluated: DataFrame, ratios: tuple[int, ...] = COST_RATIOS) -> DataFrame:
    """False merges cost ``ratio`` false splits: cost per threshold."""
    entries = F.array(*[
        F.struct(F.lit(r).alias("ratio"), (F.col("fp") * r + F.col("fn")).alias("cost")) for r in ratios
    ])
    return evaluated.select("threshold", F.inline(entries))


def cheapest_threshold(costs: DataFrame) -> DataFrame:
    """Lowest cost per ratio; the lowest threshold wins a tie."""
    best = F.min(F.struct("cost", "threshold"))
    return costs.groupBy("ratio").agg(best.alias("best")).select(
        "ratio", F.col("best.cost").alias("minimum_cost"), F.col("best.threshold").alias("threshold")
    )


def final_matches(scored: DataFrame, threshold: float = MATCH_THRESHOLD) -> DataFrame:
    return scored.where(F.col("jaccard") >= threshold).select("id_a", "id_b", "jaccard")
