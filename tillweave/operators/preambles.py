"""Preambles and footers that a portal puts on its notices, found inside run-on text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.operators.portals import MIN_CONTENTS
from tillweave.session import write_through

# Shorter common beginnings are left alone: many notices start with the same few words.
LEAST_WORDS = 16


def text_words(text: Column) -> Column:
    """Words between white space, as they are written."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")


def _prefix_hashes():
    """Arrow UDF: from word hashes h1, h2, ... to a hash of every prefix, the sums of h_i * B^i."""
    base = np.uint64(0x9E3779B97F4A7C15)

    @F.pandas_udf("array<bigint>")
    def prefixes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def sums(hashes: np.ndarray) -> np.ndarray:
            powers = np.full(len(hashes), base, dtype=np.uint64)
            total = np.cumsum(np.asarray(hashes, dtype=np.int64).view(np.uint64) * np.multiply.accumulate(powers))
            total ^= total >> np.uint64(31)
            return total.view(np.int64)

        for rows in batches:
            yield rows.map(sums)

    return prefixes


def _hashed(docs: DataFrame, backwards: bool) -> DataFrame:
    """(doc_id, portal, content, n, prefixes): the hash of every word prefix, or of every suffix."""
    words = docs.select("doc_id", "portal", F.explode(F.array(text_words(F.col("text")))).alias("words"))
    hashes = F.transform("words", lambda word: F.xxhash64(word))
    hashed = words.select("doc_id", "portal", F.size("words").alias("n"), F.explode(F.array(hashes)).alias("hashes"))
    prefixes = _prefix_hashes()(F.reverse("hashes") if backwards else F.col("hashes"))
    return hashed.select("doc_id", "portal", F.xxhash64("hashes").alias("content"), "n", F.explode(F.array(prefixes)).alias("prefixes"))


def _common(rows: DataFrame, contents: DataFrame, share: float, least: int) -> DataFrame:
    """(portal, length, prefix) of the prefixes that enough different contents of a portal have."""
    counted = rows.groupBy("portal", "length", "prefix").agg(F.countDistinct("content").alias("contents"))
    return write_through(
        counted.join(contents, "portal").where(F.col("contents") >= F.greatest(F.lit(least), F.col("portal_contents") * share))
        .select("portal", "length", "prefix"), "common_prefixes")


def common_lengths(docs: DataFrame, share: float, least: int = MIN_CONTENTS, backwards: bool = False) -> DataFrame:
    """(doc_id, words): how many words of a text belong to a beginning (or end) that the portal shares.

    The longest prefix that at least ``share`` of the portal's different contents, and at least ``least`` of them, begin with; at
    least ``LEAST_WORDS`` words and never the whole text. Prefixes whose lengths are doubled from there are counted first; only
    documents with a common one look at all lengths up to twice the longest. A prefix of a common prefix is common, so
    nothing is missed in between, and documents of portals without a preamble cost a few rows.
    """
    hashed = _hashed(docs, backwards)
    contents = hashed.groupBy("portal").agg(F.countDistinct("content").alias("portal_contents"))
    steps = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(40)), lambda k: F.pow(F.lit(2.0), k) * LEAST_WORDS <= F.col("n") - 1),
        lambda k: (F.pow(F.lit(2.0), k) * LEAST_WORDS).cast("int"))
    at = lambda length: F.element_at("prefixes", length)
    doubled = hashed.where(F.col("n") > LEAST_WORDS).select(
        "doc_id", "portal", "content",
        F.inline(F.transform(steps, lambda length: F.struct(length.alias("length"), at(length).alias("prefix")))))
    doubled = write_through(doubled, "doubled_prefixes")
    contents = write_through(contents, "portal_contents")
    reached = doubled.join(_common(doubled, contents, share, least), ["portal", "length", "prefix"]).groupBy("doc_id").agg(
        (F.max("length") * 2 - 1).alias("upto"))
    near = hashed.join(write_through(reached, "reached"), "doc_id")
    lengths = F.sequence(F.lit(LEAST_WORDS), F.least("upto", F.col("n") - 1))
    every = near.select(
        "doc_id", "portal", "content",
        F.inline(F.transform(lengths, lambda length: F.struct(length.alias("length"), at(length).alias("prefix")))))
    every = write_through(every, "prefixes")
    found = every.join(_common(every, contents, share, least), ["portal", "length", "prefix"])
    return found.groupBy("doc_id").agg(F.max("length").alias("words"))


def preamble_filter(docs: DataFrame, share: float = 0.3, least: int = MIN_CONTENTS) -> DataFrame:
    """(doc_id, portal, filtered, head_words, tail_words): texts without the beginning and the end that their portal shares.

    Works on words, so line breaks play no part. A text keeps at least one word: where beginning and end would meet, the end stays.
    A text that loses nothing stays as it is; others have single blanks between their words. Null counts as empty.
    """
    head = write_through(common_lengths(docs, share, least), "heads").withColumnRenamed("words", "head")
    tail = write_through(common_lengths(docs, share, least, backwards=True), "tails").withColumnRenamed("words", "tail")
    cut = docs.join(head, "doc_id", "left").join(tail, "doc_id", "left").select(
        "doc_id", "portal", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("head", F.lit(0)).alias("head"), F.coalesce("tail", F.lit(0)).alias("tail"),
        F.explode(F.array(text_words(F.col("text")))).alias("words"))
    cut = cut.withColumn("tail", F.when(F.col("head") + F.col("tail") >= F.size("words"), 0).otherwise(F.col("tail")))
    left = F.array_join(F.slice("words", F.col("head") + 1, F.greatest(F.size("words") - F.col("head") - F.col("tail"), F.lit(0))), " ")
    return cut.select(
        "doc_id", "portal", F.when(F.col("head") + F.col("tail") > 0, left).otherwise(F.col("text")).alias("filtered"),
        F.col("head").alias("head_words"), F.col("tail").alias("tail_words"))
