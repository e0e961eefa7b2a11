"""Toxicity by a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

A text is a bag of sentences and a sentence a bag of units: its words in small letters without accents, with inner
punctuation dropped, look-alike digits and signs read as letters, and letters spelled out one by one joined to a word. Two units are compared by the
three-letter subsequences they share, where a subsequence counts ``DECAY`` to the power of the letters it skips and spans at
most ``SPAN`` letters, normalised to 1 for equal units. So an insult with inserted or missing letters stays close to it.

The machine is trained on the units of the sentences of labelled documents: a unit stands on both sides as often as it occurs in toxic and in clean
documents, and a clean occurrence costs ``CLEAN_COST`` times as much, so that only what toxic documents prefer becomes
positive. Kernel values against ``LANDMARKS`` landmark units, whitened by their own kernel matrix (Nyström), are the features of a
squared-hinge linear machine. As the kernel is a product of explicit subsequence counts, the trained machine folds into
one weight per three-letter subsequence, and scoring needs no landmark.

A document's score is the largest decision value of its units, so of its sentences, through a logistic curve fitted on labelled
documents that the machine was not trained on. Texts are read whole. The model is fitted on about ``FIT_DOCS`` labelled documents of
each class, chosen by a hash of doc_id: a bounded sample, whatever the corpus.

Defined results: a null or empty text, or one without letters, has no unit and gets the score of the lowest decision value,
which is below one half. Rows are scored one by one, repeated rows alike. Documents with several labels count as toxic if any says so. Without labels of both
kinds every score is 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.llm import frames

DECAY, SPAN = 0.5, 6
LANDMARKS = 256
# The most telling units also train in disguise, with one letter put in, at this share of their weight.
DISGUISED, DISGUISE_SHARE = 300, 0.5
CLEAN_COST = 3.0
RIDGE = 1e-3
FIT_DOCS = 4000
FIT_UNITS = 16000
CALIBRATION_SHARE = 4  # every fourth sampled document fits the logistic curve, the others the machine
CURVE_CLEAN = 4.0  # weight of the clean class, against 1 for the toxic one, where the logistic curve is fitted
WIDTH = 22  # letters of a unit; longer ones are read in windows that overlap by half
CACHE = 200_000
LOWEST = -2.0

# Signs read as the letters they look like.
LOOKALIKE = str.maketrans("013457@$", "oieastas")
SPELLED = re.compile(r"(?<!\w)(?:\w[\W_]{1,3}){3,}\w(?!\w)")
SENTENCE = re.compile(r"[.!?]+\s|\n+")
_EDGES = " \t.,;:!?*$%&#\"'()[]{}<>+-_=/\\|~`^…«»„“”’"


def unit_of(token: str) -> str:
    """Letters of a token: edges stripped, look-alikes read, accents and everything else dropped."""
    token = token.strip(_EDGES)
    if not token.isascii():
        token = "".join(c for c in unicodedata.normalize("NFKD", token) if not unicodedata.combining(c))
    if not token.isalpha():
        if not any(c.isalpha() for c in token):
            return ""
        token = "".join(c for c in token.translate(LOOKALIKE) if c.isalpha())
    return token


def tokens_of(text: str) -> set[str]:
    """Distinct raw tokens of a text in small letters; spelled-out words are added as one token."""
    small = text.lower()
    found = set(small.split())
    for match in SPELLED.finditer(small):
        found.add("".join(c for c in match.group() if c.isalnum()))
    return found


def letters(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, owner): rows of letter codes with marks at both ends, and which unit each row is a window of."""
    rows, owner = [], []
    for number, unit in enumerate(units):
        coded = bytes(1 if not "a" <= c <= "z" else ord(c) - 95 for c in unit)  # a-z are 2..27, other letters 1
        coded = b"\x1e" + coded + b"\x1f"
        for start in range(0, max(len(coded) - WIDTH // 2, 1), WIDTH // 2) if len(coded) > WIDTH + 2 else (0,):
            rows.append(coded[start : start + WIDTH + 2])
            owner.append(number)
    wide = max(map(len, rows), default=0)
    flat = b"".join(row.ljust(wide, b"\0") for row in rows)
    return np.frombuffer(flat, dtype=np.uint8).reshape(len(rows), wide).astype(np.int64), np.array(owner, dtype=np.int64)


def subsequences(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, subsequence, value) of the normalised explicit kernel map of every row."""
    keys = []
    numbers = np.arange(len(codes), dtype=np.int64)[:, None] << 18
    for far in range(2, SPAN):
        if codes.shape[1] <= far:
            break
        first, last = codes[:, :-far], codes[:, far:]
        for near in range(1, far):
            middle = codes[:, near : codes.shape[1] - far + near]
            key = numbers | (((first << 10) | (middle << 5) | last) << 3) | (far - 2)
            keys.append(key[last > 0])
    if not keys:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty.astype(float)
    key = np.sort(np.concatenate(keys))
    value = DECAY ** (key & 7).astype(float)
    key >>= 3
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else key
    value, key = (np.add.reduceat(value, starts), key[starts]) if len(key) else (value, key)
    row = key >> 15
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=len(codes)))
    return row, key & 0x7FFF, value / norm[row]


def decisions(units: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Decision value of each unit: the largest of its windows."""
    result = np.full(len(units), LOWEST)
    order = sorted(range(len(units)), key=lambda i: len(units[i]))  # equal lengths together keep the rows tight
    for start in range(0, len(order), 2000):
        part = order[start : start + 2000]
        codes, owner = letters([units[i] for i in part])
        row, key, value = subsequences(codes)
        found = np.bincount(row, weights=value * weights[key], minlength=len(codes)) + bias
        at = np.array(part)[owner]
        np.maximum.at(result, at, found)
    return result


class Judge:
    """Largest decision value of whole texts; units that come often are judged once."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.known: dict[str, float] = {}
        self.older: dict[str, float] = {}

    def __call__(self, texts: Iterable[str | None]) -> list[float]:
        bags = [tokens_of(text) if text else set() for text in texts]
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = set().union(*bags).difference(known)
        seen = [token for token in new if token in older]
        known.update((token, older[token]) for token in seen)
        units = [(token, unit) for token in new.difference(seen) for unit in [unit_of(token)]]
        short = [token for token, unit in units if len(unit) < 3]
        known.update(dict.fromkeys(short, LOWEST))
        judged = [(token, unit) for token, unit in units if len(unit) >= 3]
        if judged:
            values = decisions([unit for _, unit in judged], self.weights, self.bias)
            known.update(zip([token for token, _ in judged], values.tolist()))
        return [max(map(known.__getitem__, bag), default=LOWEST) for bag in bags]


def largest(docs: DataFrame, keep: list[str], weights: np.ndarray, bias: float) -> DataFrame:
    """``keep`` columns and the largest decision value of each text."""
    fields = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(weights, bias)
        for batch in batches:
            values: list[float] = []
            for first in range(0, batch.num_rows, 100):
                values += judge(batch["text"].slice(first, 100).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[batch[name] for name in keep], pa.array(values, pa.float64())], names=[*keep, "decision"])

    return docs.select(*keep, "text").mapInArrow(work, f"{fields}, decision double")


def training_units(sample: DataFrame) -> DataFrame:
    """(unit, toxic, clean): in how many toxic and clean sampled documents some sentence holds the unit."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                found = {unit_of(token) for sentence in SENTENCE.split(text or "") for token in tokens_of(sentence)}
                rows += [(unit, toxic, 1 - toxic) for unit in found if 3 <= len(unit) <= WIDTH]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["unit", "toxic", "clean"])

    found = sample.select("text", "toxic").mapInArrow(work, "unit string, toxic bigint, clean bigint")
    return found.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def machine(units: list[str], toxic: np.ndarray, clean: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights per subsequence and bias. ``toxic`` and ``clean`` are the shares of documents that hold each unit."""
    codes, _ = letters(units)  # units are at most WIDTH long, so one row each
    row, key, value = subsequences(codes)
    lift = toxic - CLEAN_COST * clean
    marks = np.unique(np.concatenate([np.argsort(-lift)[: LANDMARKS // 2], np.argsort(-(toxic + clean))[: LANDMARKS // 2]]))
    dense = np.zeros((len(marks), 1 << 15))
    place = np.full(len(units), -1)
    place[marks] = np.arange(len(marks))
    chosen = place[row] >= 0
    dense[place[row[chosen]], key[chosen]] = value[chosen]
    inner, basis = np.linalg.eigh(dense @ dense.T)
    whiten = basis[:, inner > 1e-8] / np.sqrt(inner[inner > 1e-8])
    folded = whiten.T @ dense  # rank x subsequences
    features = np.zeros((len(units), folded.shape[0] + 1))
    bounds = np.searchsorted(row, np.arange(0, len(units) + 500, 500))
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if a < b:
            starts = np.flatnonzero(np.concatenate(([True], row[a + 1 : b] != row[a : b - 1])))
            features[row[a:b][starts], :-1] = np.add.reduceat(folded[:, key[a:b]] * value[a:b], starts, axis=1).T
    features[:, -1] = 1.0
    solution = np.zeros(features.shape[1])
    ridge = RIDGE * np.eye(len(solution))
    ridge[-1, -1] = 1e-9
    cost_toxic, cost_clean = toxic / toxic.sum(), CLEAN_COST * clean / clean.sum()
    for _ in range(25):
        f = features @ solution
        up, down = cost_toxic * (f < 1), cost_clean * (f > -1)
        moved = np.linalg.solve(ridge + (features * (up + down)[:, None]).T @ features, features.T @ (up - down))
        step = np.abs(moved - solution).max()
        solution = moved
        if step < 1e-6:
            break
    return folded.T @ solution[:-1], float(solution[-1])


def disguised(units: list[str], toxic: np.ndarray, clean: np.ndarray, seed: int = 13) -> tuple[list[str], np.ndarray]:
    """(variants, shares of toxic documents): the most telling units with a letter put in, each in four ways."""
    draw = np.random.default_rng(seed)
    lift = toxic - CLEAN_COST * clean
    found: dict[str, float] = {}
    for i in np.argsort(-lift, kind="stable")[:DISGUISED]:
        unit = units[i]
        if lift[i] <= 0 or not 4 <= len(unit) < WIDTH:
            continue
        for _ in range(4):
            at, letter = int(draw.integers(1, len(unit))), chr(97 + int(draw.integers(26)))
            found[unit[:at] + letter + unit[at:]] = float(toxic[i]) * DISGUISE_SHARE / 4
    known = set(units)
    variants = [unit for unit in found if unit not in known]
    return variants, np.array([found[unit] for unit in variants])


def curve(values: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps on a lightly smoothed likelihood."""
    slope, offset = 1.0, 0.0
    goal = np.where(toxic == 1, 1 - 1e-3, 1e-3)
    x = np.column_stack([values, np.ones(len(values))])
    weight = weight / weight.sum()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ [slope, offset], -30, 30)))
        gradient = x.T @ (weight * (p - goal)) + [1e-5 * slope, 0]
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-5 * np.eye(2)
        step = np.linalg.solve(bend, gradient)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(offset)


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple[np.ndarray, float, float, float] | None:
    """(weights, bias, slope, offset), or None without labels of both kinds."""
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learn)
    marked = frames.store(marked.groupBy("doc_id").agg(F.max("toxic").cast("bigint").alias("toxic")), "toxic-labels")
    of_class = {row["toxic"]: row["n"] for row in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(of_class) < 2:
        return None
    share = F.when(F.col("toxic") == 1, FIT_DOCS / of_class[1]).otherwise(FIT_DOCS / of_class[0])
    picked = frames.store(marked.where(frames.unit_hash(F.col("doc_id")) < share), "toxic-picked")
    sample = frames.store(docs.select("doc_id", "text").join(picked, "doc_id"), "toxic-sample")
    for_curve = F.crc32(F.concat(F.lit("curve"), F.col("doc_id").cast("string")).cast("binary")) % CALIBRATION_SHARE == 0
    train = sample.where(~for_curve)
    size = {row["toxic"]: row["n"] for row in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return None
    units = frames.store(training_units(train), "toxic-units")
    often = units.orderBy(F.desc(F.col("toxic") + F.col("clean")), "unit").limit(FIT_UNITS // 2)
    telling = units.orderBy(F.desc(F.col("toxic") / size[1] - CLEAN_COST * F.col("clean") / size[0]), "unit").limit(FIT_UNITS // 4)
    rare = units.orderBy(F.md5(F.col("unit").cast("binary")), "unit").limit(FIT_UNITS // 4)
    rows = {row["unit"]: row for part in (often, telling, rare) for row in part.collect()}
    names = sorted(rows)
    toxic_share = np.array([rows[n]["toxic"] for n in names]) / size[1]
    clean_share = np.array([rows[n]["clean"] for n in names]) / size[0]
    variants, shares = disguised(names, toxic_share, clean_share)
    weights, bias = machine(
        names + variants, np.concatenate((toxic_share, shares)), np.concatenate((clean_share, np.zeros(len(variants)))))
    held = largest(sample.where(for_curve), ["toxic"], weights, bias).toPandas()
    if held["toxic"].nunique() < 2:
        held = largest(sample, ["toxic"], weights, bias).toPandas()
    values, toxic = held["decision"].to_numpy(), held["toxic"].to_numpy()
    weight = np.where(toxic == 1, 1 / max((toxic == 1).sum(), 1), CURVE_CLEAN / max((toxic == 0).sum(), 1))
    return weights, bias, *curve(values, toxic, weight)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = frames.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = frames.remainder("doc_id", 5) == 0
    model = fit(docs, labels, ~held_out)
    if model is None:
        return docs.select("doc_id", held_out.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    weights, bias, slope, offset = model
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(slope) * F.col("decision") + F.lit(offset))))
    scored = largest(docs, ["doc_id"], weights, bias).select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
