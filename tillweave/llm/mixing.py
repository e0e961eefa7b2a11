"""Mixing sources to target weights: raking by iterative proportional fitting, then sampling by calibrated probabilities.

Built from DataFrame and SQL functions only. Tokens are counted per cell (source, language, topic), and the cells' weights are
scaled in turn to the target shares of each margin until every share fits. The weight of a cell over its tokens says how much
of it to keep; scaled so that no cell is asked for more than it has, it is the probability with which each of its documents stays.
The draw is a hash of doc_id and a seed, so it is the same on every run and every executor.

Targets are shares by value. By default each margin is tempered: share ~ tokens ** ``TEMPER``, which lifts small sources,
languages and topics without turning the mixture upside down.

Defined results: a null source or language is a value of its own; a null or empty text has no tokens and gets the probability of its cell,
a cell without any tokens keeps all its documents. Repeated rows are drawn alike. Other columns are passed through. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.llm import frames

MARGINS = ("source", "lang", "topic")
TEMPER = 0.95
SWEEPS = 8
SEED = 17
# What a text is about, by the first list it holds a word of; everything else is general.
TOPICS = (
    ("legal", ("license", "copyright", "terms of")),
    ("web", ("http://", "https://", "www.", "<html", "cookie")),
    ("contact", ("@", "phone", "+1 (")),
    ("code", ("def ", "{", "};")),
)


def tokens(text: Column) -> Column:
    """Number of runs of characters other than blanks, tabs and line ends."""
    split = F.split(F.coalesce(text, F.lit("")), r"[ \t\n\r\f\x0B]+")
    return F.size(split) - (F.element_at(split, 1) == "").cast("int") - F.when(
        (F.size(split) > 1) & (F.element_at(split, -1) == ""), 1).otherwise(0)


def topic(text: Column, topics=TOPICS) -> Column:
    small = F.lower(text)
    result = F.lit("general")
    for name, signs in reversed(topics):
        found = F.lit(False)
        for sign in signs:
            found = found | F.contains(small, F.lit(sign))
        result = F.when(found, name).otherwise(result)
    return result


def cell_keys() -> dict[str, Column]:
    return {
        "source": F.coalesce("source", F.lit("(none)")), "lang": F.coalesce("lang", F.lit("(none)")),
        "topic": topic(F.col("text")),
    }


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, tokens): what raking needs of each document."""
    keys = [column.alias(name) for name, column in cell_keys().items()]
    return docs.select("doc_id", *keys, tokens(F.col("text")).alias("tokens"))


def targets(cells: DataFrame, margin: str, temper: float = TEMPER, shares: dict[str, float] | None = None) -> DataFrame:
    """(margin, target): tempered token shares, or the given ones (values without one get 0)."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("sum"))
    if shares:
        given = F.lit(0.0)
        for value, share in shares.items():
            given = F.when(F.col(margin) == value, float(share)).otherwise(given)
        sums = sums.withColumn("raw", given)
    else:
        sums = sums.withColumn("raw", F.pow(F.col("sum").cast("double"), F.lit(temper)))
    total = sums.agg(F.sum("raw")).first()[0] or 1.0
    return sums.select(margin, (F.col("raw") / F.lit(float(total))).alias("target"))


def rake(cells: DataFrame, goals: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """Cells with their raked share as ``weight``; every sweep fits the margins in turn and is stored."""
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    raked = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for sweep in range(sweeps):
        for margin, goal in goals.items():
            now = raked.groupBy(margin).agg(F.sum("weight").alias("now"))
            scale = now.join(goal, margin).select(margin, F.when(F.col("now") > 0, F.col("target") / F.col("now")).otherwise(0.0).alias("scale"))
            raked = raked.join(scale, margin).select(*cells.columns, (F.col("weight") * F.col("scale")).alias("weight"))
        raked = frames.store(raked, f"raked-{sweep}")
    return raked


def probabilities(raked: DataFrame) -> DataFrame:
    """(source, lang, topic, probability): raked share over tokens, the largest set to 1."""
    rate = raked.withColumn("rate", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")))
    most = rate.agg(F.max("rate")).first()[0] or 1.0
    chance = F.coalesce(F.least(F.col("rate") / F.lit(float(most)), F.lit(1.0)), F.lit(1.0))
    return rate.select(*MARGINS, chance.alias("probability"))


def cell_probabilities(info: DataFrame, temper: float = TEMPER) -> DataFrame:
    """The probability of every cell of ``info`` (columns as ``described``)."""
    cells = frames.store(info.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    goals = {margin: frames.store(targets(cells, margin, temper), f"goal-{margin}") for margin in MARGINS}
    return frames.store(probabilities(rake(cells, goals)), "mix-probabilities")


def calibrated(info: DataFrame, chance: DataFrame) -> DataFrame:
    """``info`` with (probability, kept). The cells are few; their stored size decides how they are joined."""
    drawn = F.coalesce(frames.unit_hash(F.col("doc_id"), SEED) < F.col("probability"), F.lit(True))
    return info.join(chance, list(MARGINS)).withColumn("kept", drawn)


def sample(docs: DataFrame, temper: float = TEMPER) -> DataFrame:
    """The documents that stay, with the columns they came with."""
    chance = cell_probabilities(described(docs), temper)
    names = {margin: f"cell_{margin}" for margin in MARGINS}
    cells = chance.select(*[F.col(m).alias(n) for m, n in names.items()], "probability")
    keyed = docs.select(*docs.columns, *[c.alias(names[m]) for m, c in cell_keys().items()])
    drawn = F.coalesce(frames.unit_hash(F.col("doc_id"), SEED) < F.col("probability"), F.lit(True))
    return keyed.join(cells, list(names.values())).where(drawn).select(*docs.columns)


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    info = frames.store(described(frames.table(spark, sf_dir, "documents")), "mix-documents")
    mixed = calibrated(info, cell_probabilities(info))
    return mixed.select("doc_id", "source", "lang", "topic", "tokens", F.round("probability", 6).alias("probability"), "kept")
