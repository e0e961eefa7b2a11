"""MinHash signatures over word 5-grams."""

from __future__ import annotations

import random
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.operators.shingles import normal_texts, tokens

# The modulus, the seed and the signature length of the published figures.
PRIME = 4294967311
SEED = 42
SIGNATURE_SIZE = 128
NGRAM = 5

HASH_BLOCK = 128


def coefficients(k: int = SIGNATURE_SIZE, seed: int = SEED) -> list[tuple[int, int]]:
    """(a, b) of the first ``k`` permutations; a shorter list is a prefix of a longer one."""
    draw = random.Random(seed)
    return [(draw.randint(1, PRIME - 1), draw.randint(0, PRIME - 1)) for _ in range(k)]


def shingle_hash(shingle: Column) -> Column:
    """MD5 of the text, read as a 128-bit number, modulo PRIME, in 64-bit arithmetic.

    PRIME = 2^32 + 15, so 2^32 counts as -15 and the four 32-bit words weigh -3375, 225, -15 and 1.
    """
    hexed = F.md5(shingle)
    word = lambda i: F.conv(F.substring(hexed, 8 * i + 1, 8), 16, 10).cast("bigint")
    return F.pmod(word(3) - word(2) * 15 + word(1) * 225 - word(0) * 3375, F.lit(PRIME))


def permuted(h: Column, a: int, b: int) -> Column:
    """(a * h + b) mod PRIME without leaving 63 bits."""
    high = F.pmod(h * F.lit(a >> 16), F.lit(PRIME)) * F.lit(1 << 16)
    return F.pmod(high + h * F.lit(a & 0xFFFF) + F.lit(b), F.lit(PRIME))


def _minima(k: int, seed: int):
    """Arrow UDF from the normalised text of a document to its ``k`` minima.

    The helpers are nested so that they travel to the executors with the function.
    """
    pairs = np.array(coefficients(k, seed), dtype=np.uint64)
    prime, half, block, n = np.uint64(PRIME), np.uint64(16), HASH_BLOCK, NGRAM
    a_high, a_low, b = pairs[None, :, 0] >> half, pairs[None, :, 0] & np.uint64(0xFFFF), pairs[None, :, 1]

    def modulo(x: np.ndarray) -> np.ndarray:
        return x - x // prime * prime  # numpy vectorises the division by a scalar, not the remainder

    def hashes(text: str) -> np.ndarray:
        words = text.encode().split()
        digests = b"".join([md5(b" ".join(gram)).digest() for gram in set(zip(*[words[i:] for i in range(n)]))])
        w = np.frombuffer(digests, dtype=">u4").reshape(-1, 4).astype(np.int64)
        return np.unique((w[:, 3] - 15 * w[:, 2] + 225 * w[:, 1] - 3375 * w[:, 0]) % int(prime)).astype(np.uint64)

    def lowest(text: str) -> np.ndarray:
        result = np.full(k, prime, dtype=np.uint64)
        values = hashes(text)
        for start in range(0, len(values), block):
            h = values[start : start + block, None]
            permuted = modulo((modulo(a_high * h) << half) + a_low * h + b)
            np.minimum(result, permuted.min(axis=0), out=result)
        return result.astype(np.int64)

    @F.pandas_udf("array<bigint>")
    def minima(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lowest)

    return minima


def signatures(docs: DataFrame, k: int = SIGNATURE_SIZE, seed: int = SEED) -> DataFrame:
    """(doc_id, sig) for documents with at least one 5-gram; a map-only pass over the text.

    Spark normalises; a text goes to the Arrow batches once, not as digests of all its runs, which are many times as long.
    """
    long_enough = normal_texts(docs).where(F.size(F.split("normal", " ")) >= NGRAM)
    return long_enough.select("doc_id", _minima(k, seed)("normal").alias("sig"))


def too_short(docs: DataFrame) -> DataFrame:
    """Documents without any 5-gram. Their signature says nothing, so they are kept out of the buckets."""
    return tokens(docs).where(F.size("words") < NGRAM).select("doc_id")


def signatures_native(shingles: DataFrame, k: int = SIGNATURE_SIZE, seed: int = SEED) -> DataFrame:
    """The same signatures from rows (doc_id, shingle) with built-in aggregates only."""
    hashed = shingles.select("doc_id", shingle_hash(F.col("shingle")).alias("h"))
    minima = [F.min(permuted(F.col("h"), a, b)) for a, b in coefficients(k, seed)]
    return hashed.groupBy("doc_id").agg(F.array(*minima).alias("sig"))


def signature_long(sigs: DataFrame) -> DataFrame:
    return sigs.select("doc_id", F.posexplode("sig").alias("hash_position", "hash_value"))


def similarity(a: Column, b: Column, k: int) -> Column:
    """Share of equal values among the first ``k`` positions."""
    hits = F.zip_with(F.slice(a, 1, k), F.slice(b, 1, k), lambda x, y: (x == y).cast("int"))
    return F.aggregate(hits, F.lit(0), lambda total, hit: total + hit) / F.lit(k)


def minhash_estimate(pairs: DataFrame, sigs: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """Add one ``minhash_<k>`` column per ``k`` to (id_a, id_b, ...).

    Documents too short for a signature count as equal to each other and unlike any other.
    """
    side = lambda s: sigs.select(F.col("doc_id").alias(f"id_{s}"), F.col("sig").alias(f"sig_{s}"))
    joined = pairs.join(side("a"), "id_a", "left").join(side("b"), "id_b", "left")
    a, b = F.col("sig_a"), F.col("sig_b")
    estimate = lambda k: (
        F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(similarity(a, b, k))
    )
    return joined.select(*pairs.columns, *[estimate(k).alias(f"minhash_{k}") for k in ks])
