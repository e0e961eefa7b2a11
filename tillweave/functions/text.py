"""Text normalisation and token sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What ends a URL is any Unicode white space, written out so that every regex engine agrees.
WHITE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
URL = rf"https?://[^{WHITE}]+"
URL_OR_WWW = rf"https?://[^{WHITE}]+|www\.[^{WHITE}]+"


def normalize_text(text: Column, strip_www: bool = False) -> Column:
    """Lower case, no URLs, only a-z and 0-9, single spaces; null becomes ''."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    no_urls = F.regexp_replace(lowered, URL_OR_WWW if strip_www else URL, " ")
    return F.trim(F.regexp_replace(no_urls, "[^a-z0-9]+", " "))


def words(normalized: Column) -> Column:
    return F.array_remove(F.split(normalized, " "), "")


def characters(normalized: Column) -> Column:
    return F.array_remove(F.split(normalized, ""), "")


def _each_start(sequence: Column, n: int, each: Callable[[Column], Column]) -> Column:
    """``each`` of every 0-based start of ``n`` neighbours; an empty array if there are fewer."""
    count = F.size(sequence) - (n - 1)
    starts = F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))
    return F.slice(F.transform(starts, each), 1, F.greatest(count, F.lit(0)))


def windows(sequence: Column, n: int, joiner: str, each: Callable[[Column], Column]) -> Column:
    """``each`` of the text of every run of ``n`` neighbours.

    ``sequence`` must be a plain column, not an expression: the lambda would evaluate it per element.
    """
    gram = lambda i: F.concat_ws(joiner, *[F.get(sequence, i + k) for k in range(n)])
    return _each_start(sequence, n, lambda i: each(gram(i)))


def window_hashes(sequence: Column, n: int) -> Column:
    """64-bit hash of every run of ``n`` neighbours, without building its text."""
    return _each_start(sequence, n, lambda i: F.xxhash64(*[F.get(sequence, i + k) for k in range(n)]))
