"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Every stage reads its predecessor's table and returns a DataFrame; ``run`` writes each result as Parquet to the shared
folder and reads it again. A stage's docstring says what it does with its input.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillweave.llm import frames, language, mixing, packing, passages, sampling
from tillweave.session import write_through

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

_left: list[str] = []


def staged(stage):
    """A stage with its settings; the intermediate tables of the stage before, whose result has been written, are deleted."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        frames.delete(spark, _left)
        frames.ready(spark)
        with frames.recording(_left):
            return stage(spark, docs, sf_dir)

    return run_stage


@staged
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay; those without letters, or unlike every profile, go."""
    profiles = language.fit_profiles(language.fit_sample(docs, ~language.held_out()))
    judged = language.identify(docs.select(*COLUMNS), profiles, keep=COLUMNS)
    return judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") > 0)).select(*COLUMNS)


@staged
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the smallest doc_id stays, once.

    Decided for each (doc_id, text), known by a 64-bit hash: different texts of one doc_id have classes of their own, and rows
    without a doc_id are told apart by their texts and come last in a class. Of equal (doc_id, text) the smallest other columns stay.
    """
    rows = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("row"))
    classes = sampling.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    classes = frames.store(classes.select(F.col("doc_id").alias("row"), "class_id").distinct(), "pipeline-classes")
    named = classes.join(rows.select("row", "doc_id").distinct(), "row")
    first = named.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first"))
    place = F.row_number().over(Window.partitionBy("row").orderBy("lang", "source", "n_chars"))
    once = rows.withColumn("place", place).where("place = 1")
    return once.join(first.select("first.row"), "row", "left_semi").select(*COLUMNS)


@staged
def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages that a document with a smaller id has; n_chars follows. Every document stays."""
    left = passages.without_repeats(docs.select(*COLUMNS), [name for name in COLUMNS if name not in ("text", "n_chars")], text=True)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


@staged
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with the probabilities that fit the target shares of sources, languages and topics."""
    return mixing.sample(docs.select(*COLUMNS)).select(*COLUMNS)


@staged
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training sequences."""
    return packing.pack(docs, packing.vocabulary_path())


STAGES = [
    ("language", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("passages", remove_repeated_passages),
    ("mixing", mix),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
