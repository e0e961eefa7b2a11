"""Language identification by rank-order n-gram profiles.

Each language is described by its ``PROFILE`` most frequent character n-grams (one to three characters, words padded
with a blank), in order of frequency. A document gets the profile of its own text, and the language whose profile is
nearest by the out-of-place measure: the sum over the document's n-grams of how many places each is away from its place
in the language's profile, or ``PROFILE`` if it is not there.

Profiles are fitted on about ``FIT_DOCS`` documents of each language, chosen by a hash of doc_id: the sample has a fixed
expected size, so the model does not grow with the corpus. Every document is classified on its whole text.

Defined results: a null text, or one without letters, is ``und`` with score 0. Ties go to the language that sorts first.
Rows are judged one by one, so repeated rows give repeated results; other columns than the named ones are not read.
With nothing to learn from, every document is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.llm import frames, kernels

PROFILE = 300
FIT_DOCS = 2000
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letter_codes() -> np.ndarray:
    """Code of the small letter for every code point, 0 for what is no letter; built once per Python process."""
    if not _letters:
        codes = np.zeros(0x110000, dtype=np.int64)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                small = char.lower()
                codes[point] = ord(small) if len(small) == 1 else point
        _letters.append(codes)
    return _letters[0]


def letter_runs(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text its letter codes, every stretch of other characters as one 0, with a 0 at both ends."""
    data, offsets = kernels.utf8(column)
    table = letter_codes()
    for first, end in kernels.runs(offsets):
        part = data[offsets[first] : offsets[end]]
        points = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
        begins = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))[offsets[first : end + 1] - offsets[first]]
        codes = table[points]
        for a, b in zip(begins[:-1], begins[1:]):
            text = np.zeros(b - a + 2, dtype=np.int64)
            text[1:-1] = codes[a:b]
            keep = text != 0
            keep[1:] |= text[:-1] != 0
            keep[0] = True
            yield text[keep]


def ngrams(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, count) of the one- to three-character n-grams, ascending by key; a lone blank is none."""
    grams = [text[text != 0]]
    if len(text) > 2:
        pairs = (text[:-1] << 21) | text[1:]
        grams += [pairs, (pairs[:-1] << 21) | text[2:]]
    keys = np.sort(np.concatenate(grams))
    if not len(keys):
        return keys, keys
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], np.diff(starts, append=len(keys))


def ranked(text: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, equal counts by key."""
    keys, counts = ngrams(text)
    if len(counts) > size:  # only those that can be among the first
        limit = np.partition(counts, len(counts) - size)[len(counts) - size]
        keys, counts = keys[counts >= limit], counts[counts >= limit]
    return keys[np.argsort(-counts, kind="stable")[:size]]


def fit_sample(docs: DataFrame, learn: Column, per_language: int = FIT_DOCS) -> DataFrame:
    """(text, lang) of about ``per_language`` learnable documents of each language."""
    usable = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Stored first, so that its true size decides whether it is broadcast; a shuffle of the texts by language is never wanted.
    share = frames.store(usable.groupBy("lang").agg((F.lit(float(per_language)) / F.count("*")).alias("share")), "shares")
    return usable.join(share, "lang").where(frames.unit_hash(F.col("doc_id")) < F.col("share")).select("lang", "text")


def fit_profiles(sample: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Profile keys of each language in order of frequency. ``sample`` is bounded; see ``fit_sample``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, text in zip(batch["lang"].to_pylist(), letter_runs(batch["text"])):
                by_lang.setdefault(lang, []).append(ngrams(text))
            for lang, found in by_lang.items():
                keys, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                total = np.bincount(place, weights=np.concatenate([c for _, c in found])).astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(keys), pa.string()), "gram": keys, "n": total})

    counts = sample.mapInArrow(kernels.lean(count), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counts.withColumn("place", place).where(F.col("place") <= size).select("lang", "gram", "place").collect()
    profiles: dict[str, list[int]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["place"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def identify(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus (lang_pred, score) for each row; score is 1 less the share of the largest possible distance."""
    keep = ["doc_id"] if keep is None else keep
    langs = sorted(profiles)
    known = np.array(sorted({g for grams in profiles.values() for g in grams}), dtype=np.int64)
    places = np.full((len(langs), len(known) + 1), -1, dtype=np.int64)
    for row, lang in enumerate(langs):
        places[row, np.searchsorted(known, profiles[lang])] = np.arange(len(profiles[lang]))
    fields = [docs.schema[name] for name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double"

    def judge(text: np.ndarray) -> tuple[str, float]:
        grams = ranked(text, size)
        if not len(grams) or not len(known):
            return UNKNOWN, 0.0
        at = np.searchsorted(known, grams)
        at[at == len(known)] = 0
        at = np.where(known[at] == grams, at, len(known))
        theirs = places[:, at]
        away = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(grams)))).sum(axis=1)
        best = int(np.argmin(away))
        return langs[best], 1.0 - float(away[best]) / (size * len(grams))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [judge(text) for text in letter_runs(batch["text"])]
            columns = [batch[name] for name in keep]
            columns += [pa.array([j[0] for j in judged], pa.string()), pa.array([j[1] for j in judged], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    return docs.select(*keep, *(["text"] if "text" not in keep else [])).mapInArrow(kernels.lean(label), schema)


def held_out(modulus: int = 4, rest: int = 2) -> Column:
    return frames.remainder("doc_id", modulus) == rest


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = fit_profiles(fit_sample(docs, ~held_out()))
    return identify(docs.select("doc_id", "text"), profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
