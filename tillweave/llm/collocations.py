"""Phrase collocations by weighted acyclic automata.

Each task sorts the windows of up to five words that start at its words, and builds count transducers from them (``transducer.build``),
one for each language and prefix range. A range is a stretch of the sorted phrases; all transducers of one range meet in one
task, which unites them and sums the weights of the prefixes that reach the least count (``transducer.union``). A prefix that
is the beginning of a range's border may go on in the next range; its partial sums are added up afterwards, a few for each
border. The counts of the parts of a candidate are looked up by composing the parts that are asked for, sorted, with the transducer of
the counts of their range (``transducer.compose``).

Ranges are cut at the quantiles of a sample of about ``SAMPLE`` bytes of text for each range, so a frequent word or pair
is spread over many ranges; equal windows of one task are one. The sample only decides how even the ranges are: counts cover all
windows and are exact. Borders hold words of at most ``BORDER`` bytes (a shortened word is a valid border as well), one border for
each ``RANGE`` bytes of text, and are the only thing that the driver keeps.

Defined results: a null text has no words; a null lang is ``und``, together with documents of that language; repeated documents count
as often as they occur; an empty table, or one without frequent phrases, gives no rows. Ties are ordered by count and
phrase. Only the columns text and lang are read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillweave.llm import frames, kernels, transducer

WORDS = 5
LEAST = 100
KEEP = 2000
SHARD = 4 << 20
RANGE = 8 << 20
SAMPLE = 96 << 10
EVERY = 64
BORDER = 32
UNKNOWN = "und"

# What a byte is to the words: 0 part of one, 1 blank between two, 2 the end of a piece.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?") + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] = _SMALL[97:123]


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of documents, in order, and a number that changes where a piece ends; ``bounds`` are the documents' byte bounds from 0."""
    kind = _KIND[data]
    inside = kind == 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    first[cut], last[cut - 1] = inside[cut], inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_SMALL[data[inside]])])
    return found, np.cumsum(kind == 2)[starts] + np.searchsorted(bounds, starts, side="right")


def windows(column: pa.Array, size: int) -> tuple[list[np.ndarray], pa.Array]:
    """Label columns of the window that starts at each word of the texts, and the alphabet. A piece's last windows end with zeros."""
    data, offsets = kernels.utf8(column)
    found, piece = words(data[offsets[0] : offsets[-1]], offsets - offsets[0])
    label, names = transducer.alphabet(found)
    columns = [label]
    for k in range(1, size):
        later = np.zeros(len(label), dtype=np.int64)
        if k < len(label):
            later[:-k] = np.where(piece[k:] == piece[:-k], label[k:], 0)
        columns.append(later)
    return columns, names


def shards(batches: Iterator[pa.RecordBatch], limit: int = SHARD) -> Iterator[tuple[str, pa.Array]]:
    """(lang, texts) of about ``limit`` bytes of a task's batches; one longer text is a shard of its own."""
    held: dict[str, list[pa.Array]] = {}
    weight: dict[str, int] = {}

    def flush(lang: str) -> tuple[str, pa.Array]:
        weight.pop(lang)
        return lang, pa.concat_arrays(held.pop(lang))

    for batch in batches:
        langs = batch["lang"].dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch["text"].filter(pa.compute.equal(langs.indices, code)).cast(pa.large_binary())
            offsets = np.concatenate(([0], np.cumsum(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy())))
            for first, end in kernels.runs(offsets, limit):
                size = int(offsets[end] - offsets[first])
                if weight.get(lang, 0) and weight[lang] + size > limit:
                    yield flush(lang)
                held.setdefault(lang, []).append(texts.slice(first, end - first))
                weight[lang] = weight.get(lang, 0) + size
    for lang in list(held):
        yield flush(lang)


def borders(texts: DataFrame, size: int, range_bytes: int) -> dict[str, list[tuple[bytes, ...]]]:
    """Ascending borders between the prefix ranges of each language; a language without borders is one range."""
    volume = {r["lang"]: r["bytes"] or 0 for r in texts.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()}
    parts = {lang: -(-total // range_bytes) for lang, total in volume.items() if total > range_bytes}
    if not parts:
        return {}
    share = sum(parts.values()) * SAMPLE / sum(volume.values())

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, column in shards(batches):
            columns, names = windows(column, size)
            some = [c[::EVERY] for c in columns]
            shown = [names.take(pa.array(c[c > 0] - 1)).to_pylist() for c in some]
            keys = [[] for _ in some[0]]
            for c, found in zip(some, shown):
                for row, word in zip(np.flatnonzero(c), found):
                    keys[row].append(word[:BORDER])
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys), pa.string()), "key": pa.array(keys, pa.list_(pa.binary()))})

    chosen = (F.abs(F.xxhash64(F.monotonically_increasing_id())) % 1_000_003) < F.lit(min(share, 1.0) * 1_000_003)
    keys: dict[str, list[tuple[bytes, ...]]] = {}
    for row in texts.where(F.col("lang").isin(list(parts))).where(chosen).mapInArrow(pick, "lang string, key array<binary>").collect():
        keys.setdefault(row["lang"], []).append(tuple(bytes(word) for word in row["key"]))
    for lang, found in keys.items():
        found.sort()
        keys[lang] = sorted({found[len(found) * i // parts[lang]] for i in range(1, parts[lang])})
    return keys


def shard_transducers(texts: DataFrame, cuts: dict[str, list[tuple[bytes, ...]]], size: int) -> DataFrame:
    """(lang, range, n, blob): the count transducer of each shard for each prefix range that it has windows of."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, column in shards(batches):
            columns, names = windows(column, size)
            columns, weights = transducer.distinct(columns)
            listed = names.to_pylist()
            ends = [*(transducer.place(columns, listed, border) for border in cuts.get(lang, ())), len(weights)]
            for number, (first, end) in enumerate(zip([0, *ends], ends)):
                if end > first:
                    part, own = transducer.used([c[first:end] for c in columns], names)
                    blob = transducer.pack(transducer.build(part, weights[first:end]), own)
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang], pa.string()), "range": pa.array([number], pa.int32()),
                        "n": pa.array([int(weights[first:end].sum())], pa.int64()), "blob": pa.array([blob], pa.list_(pa.binary()))})

    return texts.mapInArrow(work, "lang string, range int, n bigint, blob array<binary>")


def phrase_counts(blobs: DataFrame, cuts: dict[str, list[tuple[bytes, ...]]], size: int, least: int) -> DataFrame:
    """(lang, home, phrase, m, f): every phrase of one to ``size`` words with at least ``least`` windows; home is its own range.

    A row without a phrase, of no words, holds the number of windows of a range.
    """

    def unite(key, group):
        lang, number = key[0].as_py(), key[1].as_py()
        own = cuts.get(lang, [])
        found, names = transducer.union(group["blob"].to_pylist(), least, own[max(number - 1, 0) : number + 1])
        listed = names.to_pylist()
        phrases, lengths, counts, opened, homes = [None], [0], [sum(group["n"].to_pylist())], [False], [number]
        for depth, (paths, weight, is_open) in enumerate(found):
            tuples = [tuple(listed[label - 1] for label in row) for row in paths.tolist()]
            phrases += [b" ".join(row).decode() for row in tuples]
            lengths += [depth + 1] * len(tuples)
            counts += weight.tolist()
            opened += is_open.tolist()
            homes += [bisect_right(own, row) if partial else number for row, partial in zip(tuples, is_open)]
        return pa.table({
            "lang": pa.array([lang] * len(phrases), pa.string()), "home": pa.array(homes, pa.int32()),
            "phrase": pa.array(phrases, pa.string()), "m": pa.array(lengths, pa.int32()), "f": pa.array(counts, pa.int64()),
            "open": pa.array(opened, pa.bool_())})

    schema = "lang string, home int, phrase string, m int, f bigint, open boolean"
    united = frames.store(blobs.groupBy("lang", "range").applyInArrow(unite, schema), "phrase-ranges")
    whole = united.where("open").groupBy("lang", "home", "phrase", "m").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return united.where("NOT open").drop("open").unionByName(whole)


def part_counts(counts: DataFrame, parts: DataFrame, cuts: dict[str, list[tuple[bytes, ...]]], size: int) -> DataFrame:
    """(lang, phrase, f) of distinct phrases (lang, phrase), by composing those of a range with the transducer of its counts."""

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [bisect_right(cuts.get(lang, []), tuple(phrase.encode().split(b" ")))
                      for lang, phrase in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist())]
            yield pa.RecordBatch.from_pydict({"lang": batch["lang"], "home": pa.array(places, pa.int32()), "phrase": batch["phrase"]})

    def rows(phrases: list[str], code: dict[bytes, int]) -> list[np.ndarray]:
        table = np.zeros((len(phrases), size), dtype=np.int64)
        for i, phrase in enumerate(phrases):
            found = [code[word] for word in phrase.encode().split(b" ")]
            table[i, : len(found)] = found
        return list(table.T)

    def look_up(key, known, asked):
        phrases, wanted = known["phrase"].to_pylist(), asked["phrase"].to_pylist()
        names = sorted({word for phrase in phrases + wanted for word in phrase.encode().split(b" ")})
        code = {word: i + 1 for i, word in enumerate(names)}
        columns, weights = transducer.distinct(rows(phrases, code), known["f"].to_numpy())
        found = transducer.compose(rows(wanted, code), transducer.build(columns, weights, final=True))
        return pa.table({"lang": asked["lang"], "phrase": asked["phrase"], "f": pa.array(found, pa.int64())})

    placed = parts.mapInArrow(homes, "lang string, home int, phrase string")
    return (counts.select("lang", "home", "phrase", "f").groupBy("lang", "home")
            .cogroup(placed.groupBy("lang", "home")).applyInArrow(look_up, "lang string, phrase string, f bigint"))


def words_before(k) -> F.Column:
    return F.substring_index("phrase", " ", k)


def scored(cuts_of: DataFrame) -> DataFrame:
    """floor(1000 * a * n / (l * r)) of every cut, in whole numbers of any length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, n, left, right = (batch[name].to_pylist() for name in ("a", "n", "l", "r"))
            values = [1000 * x * y // (p * q) for x, y, p, q in zip(a, n, left, right)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], names=[*batch.schema.names, "score"])

    return cuts_of.mapInArrow(work, "lang string, phrase string, a bigint, k int, l bigint, r bigint, n bigint, score bigint")


def collocations(docs: DataFrame, size: int = WORDS, least: int = LEAST, within: int = 100, keep: int = KEEP,
                 range_bytes: int = RANGE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``keep`` highest-scoring phrases of each language.

    A phrase inside a longer candidate that has at least ``within`` hundredths of its windows is left out. It is enough to look at
    candidates one word longer: the phrase between has at least as many windows as the longer one.
    """
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    cuts = borders(texts, size, range_bytes)
    found = frames.store(phrase_counts(shard_transducers(texts, cuts, size), cuts, size, least), "phrase-counts")
    totals = found.where("m = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    counts = found.where("m > 0")
    several = counts.where("m > 1").select("lang", "phrase", "m", F.col("f").alias("a"))

    ends = F.array(F.expr("substring_index(phrase, ' ', m - 1)"), F.expr("substring_index(phrase, ' ', 1 - m)"))
    inside = several.where("m > 2").select("lang", F.explode(ends).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = several.join(inside, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * within, F.lit(True)))

    cut = F.explode(F.expr("transform(sequence(1, m - 1), k -> struct(k, substring_index(phrase, ' ', k) AS one, substring_index(phrase, ' ', k - m) AS two))"))
    halves = frames.store(kept.select("lang", "phrase", "a", cut.alias("cut")).select("lang", "phrase", "a", "cut.*"), "phrase-cuts")
    parts = halves.select("lang", F.explode(F.array("one", "two")).alias("phrase")).distinct()
    known = frames.store(part_counts(counts, parts, cuts, size), "phrase-parts")
    count_of = lambda name, value: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    whole = halves.join(count_of("one", "l"), ["lang", "one"]).join(count_of("two", "r"), ["lang", "two"]).join(totals, "lang")
    lowest = scored(whole.select("lang", "phrase", "a", "k", "l", "r", "n")).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    ranked = lowest.withColumn("rank", place.cast("bigint")).where(F.col("rank") <= keep)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(frames.table(spark, sf_dir, "documents"))


COLLOCATIONS_SQL = """
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
sized AS (SELECT lang, ws, i, unnest(range(1, 6)) AS m FROM starts),
grams AS (SELECT lang, m, ws[i : i + m - 1] AS p FROM sized WHERE i + m - 1 <= len(ws)),
counted AS (SELECT lang, m, p, count(*) AS f FROM grams GROUP BY lang, m, p),
totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counted WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, p, f AS a FROM counted WHERE m >= 2 AND f >= 100),
inner_phrases AS (
  SELECT lang, p[i : i + k - 1] AS p, max(a) AS longer
  FROM (SELECT lang, p, a, k, unnest(range(1, m - k + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS k FROM candidates))
  GROUP BY ALL),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_phrases x ON x.lang = c.lang AND x.p = c.p
  WHERE x.longer IS NULL OR 100 * x.longer < 100 * c.a),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM kept),
valued AS (
  SELECT c.lang, c.p, c.a, c.k, one.f AS l, two.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (one.f::HUGEINT * two.f) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counted one ON one.lang = c.lang AND one.p = c.p[1 : c.k]
  JOIN counted two ON two.lang = c.lang AND two.p = c.p[c.k + 1 : c.m]),
lowest AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
    array_to_string(p, ' ') AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
  FROM lowest)
SELECT * FROM ranked WHERE rank <= 2000
"""
