"""Token sequences, n-gram sets and exact Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.functions.text import characters, normalize_text, window_hashes, windows, words

# Set name -> (what is cut, run length).
SETS = {"word3": ("words", 3), "word5": ("words", 5), "char5": ("chars", 5)}


def _once(df: DataFrame, column: Column, name: str, *keep: str) -> DataFrame:
    """Evaluate ``column`` once per row behind a generator.

    Optimizer rules copy a projected expression into filters and lambdas above it; they do not copy
    what a generator puts out, so the text expressions run once per document.
    """
    return df.select(*keep, F.explode(F.array(column)).alias(name))


def tokens(docs: DataFrame, text: str = "text", strip_www: bool = False) -> DataFrame:
    """(doc_id, words): the word sequence of every document."""
    return _once(docs, words(normalize_text(F.col(text), strip_www)), "words", "doc_id")


def word_tokens(docs: DataFrame) -> DataFrame:
    return tokens(docs).select("doc_id", F.posexplode("words").alias("pos", "token"))


def word_ngrams(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, shingle), each shingle once per document; nothing for documents under ``n`` tokens."""
    grams = F.array_distinct(windows(F.col("words"), n, " ", lambda g: g))
    return tokens(docs).select("doc_id", F.explode(grams).alias("shingle"))


def char_ngrams(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, shingle), each run of ``n`` characters once per document; nothing for shorter texts."""
    chars = _once(docs, characters(normalize_text(F.col("text"))), "chars", "doc_id")
    grams = F.array_distinct(windows(F.col("chars"), n, "", lambda g: g))
    return chars.select("doc_id", F.explode(grams).alias("shingle"))


def char_ngram_range(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, shingles, first, last): number, least and greatest of the character runs of ``char_ngrams``.

    Runs are compared as integers, their bytes in order: those are aggregated in place by a hash map with one entry per document
    of a task, while an aggregate of texts would sort all runs. Runs of more than 7 characters do not fit and are compared as texts.
    """
    runs = char_ngrams(docs, n)
    packed = n <= 7
    value = F.conv(F.hex("shingle"), 16, 10).cast("bigint") if packed else F.col("shingle")
    ranged = runs.select("doc_id", value.alias("value")).groupBy("doc_id").agg(
        F.count("*").alias("shingles"), F.min("value").alias("first"), F.max("value").alias("last"))
    text = lambda c: F.unhex(F.hex(c)).cast("string") if packed else F.col(c)
    return ranged.select("doc_id", "shingles", text("first").alias("first"), text("last").alias("last"))


def _char_codes(n: int):
    """Distinct character runs of a normalised (ASCII) text, each packed into one integer; n up to 7."""

    @F.pandas_udf("array<bigint>")
    def codes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def pack(text: str) -> np.ndarray:
            chars = np.frombuffer(text.encode("ascii"), dtype=np.uint8).astype(np.int64)
            count = len(chars) - n + 1
            if count < 1:
                return np.empty(0, dtype=np.int64)
            packed = np.zeros(count, dtype=np.int64)
            for k in range(n):
                packed = (packed << 8) | chars[k : k + count]
            return np.unique(packed)

        for texts in batches:
            yield texts.map(pack)

    return codes


def shingle_sets(docs: DataFrame, *names: str, strip_www: bool = False) -> DataFrame:
    """(doc_id, one duplicate-free array of integers per name), without any exchange.

    ``names`` are keys of ``SETS``. Word runs are 64-bit hashes, character runs are packed exactly.
    """
    normal = _once(docs, normalize_text(F.col("text"), strip_www), "normal", "doc_id")
    cut = _once(normal, words(F.col("normal")), "words", "doc_id", "normal")

    def grams(what: str, n: int) -> Column:
        return _char_codes(n)("normal") if what == "chars" else F.array_distinct(window_hashes(F.col("words"), n))

    return cut.select("doc_id", *[grams(*SETS[name]).alias(name) for name in names])


def pair_jaccard(pairs: DataFrame, sets: DataFrame, measures: dict[str, str] | None = None) -> DataFrame:
    """Add one Jaccard column per entry of ``measures`` (set column -> result column) to (id_a, id_b, ...).

    Two empty sets are equal, one empty set is unlike any other. ``sets`` should be a stored table: the
    size of arrays that are still to be computed is underestimated, and they could be broadcast.
    """
    measures = measures or {"word5": "jaccard"}
    side = lambda s: sets.select(F.col("doc_id").alias(f"id_{s}"), *[F.col(m).alias(f"{m}_{s}") for m in measures])
    joined = pairs.join(side("a"), "id_a").join(side("b"), "id_b")
    counted = joined.select(*pairs.columns, *[
        column for m in measures for column in (
            F.size(F.array_intersect(f"{m}_a", f"{m}_b")).alias(f"{m}_common"),
            (F.size(f"{m}_a") + F.size(f"{m}_b")).alias(f"{m}_total"),
        )
    ])
    score = lambda m: _jaccard(F.col(f"{m}_common"), F.col(f"{m}_total"))
    return counted.select(*pairs.columns, *[score(m).alias(out) for m, out in measures.items()])


def normal_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, normal): normalised texts, from which sets are cut where they are compared."""
    return _once(docs, normalize_text(F.col("text")), "normal", "doc_id")


def _overlaps(names: tuple[str, ...]):
    """Arrow UDF: for two normalised texts the common and the added sizes of each of their sets, in turn.

    The helper is nested so that it travels to the executors with the function.
    """
    cuts = [SETS[name] for name in names]

    @F.pandas_udf("array<int>")
    def overlaps(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def sets(text: str) -> list[set]:
            tokens = text.split()
            return [set(zip(*[(tokens if what == "words" else text)[k:] for k in range(n)])) for what, n in cuts]

        for texts_a, texts_b in batches:
            last, of_a, found = None, [], []
            for a, b in zip(texts_a, texts_b):
                if a != last:
                    last, of_a = a, sets(a)
                found.append([size for x, y in zip(of_a, sets(b)) for size in (len(x & y), len(x) + len(y))])
            yield pd.Series(found, dtype=object)

    return overlaps


def _jaccard(common: Column, total: Column) -> Column:
    return F.when(total == 0, 1.0).otherwise(common / (total - common))


def text_jaccard(pairs: DataFrame, texts: DataFrame, measures: dict[str, str]) -> DataFrame:
    """``pair_jaccard`` from stored ``normal_texts``: texts travel, which are a fraction of their sets, and no set is stored."""
    side = lambda s: texts.select(F.col("doc_id").alias(f"id_{s}"), F.col("normal").alias(f"normal_{s}"))
    joined = pairs.join(side("b"), "id_b").join(side("a"), "id_a")
    counted = _once(joined, _overlaps(tuple(measures))("normal_a", "normal_b"), "sizes", *pairs.columns)
    at = lambda i: F.col("sizes")[i]
    return counted.select(*pairs.columns, *[_jaccard(at(2 * i), at(2 * i + 1)).alias(out) for i, out in enumerate(measures.values())])


def pair_endpoints(pairs: DataFrame) -> DataFrame:
    """Distinct documents that occur in any pair."""
    return pairs.select(F.explode(F.array("id_a", "id_b")).alias("doc_id")).distinct()


def only_endpoints(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    return docs.join(pair_endpoints(pairs), "doc_id", "left_semi")
