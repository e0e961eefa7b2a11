"""Personal data: exact patterns, and a skip-chain conditional random field that finds what they miss.

The patterns (e-mail, IP address, card, phone) give the base spans. The field labels the words that hold a digit or an ``@``, all
others being clear text: neighbouring words share a chain potential, and words that repeat, or have the same five or more digits,
share a skip potential with their next occurrence, however far away it is. Loopy message passing in the whole document's graph
then makes the labels of distant mentions agree. Runs of words with one label of probability ``SURE`` or more become
spans, unless they touch a base span; base spans always stay.

The field learns from a bounded sample of the corpus, about ``FIT_DOCS`` documents with a digit or an ``@`` and ``FIT_SITES`` words of each, whose
labels are their base spans. That a word lies in a base span is a feature too, but it is hidden from half of the training words, so
shape, neighbours and repeats have to tell. Every document is read a second time in a changed form: base spans made invalid by
one digit or a lost dot, some repeated, and made-up numbers and dates, so that near misses and plain numbers are learnt as clear text.
Weights come from the pseudo-likelihood, which needs no inference to train.

Defined results: a null or empty text has no spans; offsets are code points, ends exclusive; rows are judged one by one, so repeated
rows or ids give repeated results and a null doc_id is returned as it is. With nothing to learn from, only base spans are given. Only the
named columns are read. Whole texts are searched in time linear in their length.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import frames

KINDS = ("email", "ip", "card", "phone")
CLEAR = len(KINDS)
LABELS = len(KINDS) + 1
FIT_DOCS = 2000
FIT_SITES = 64
BUCKETS = 4096
SLOTS = 16
SURE = 0.9
ROUNDS = 50
STEPS = 150
SEED = 7

# Fixed patterns.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SIGNAL = re.compile(r"[0-9@]")
WORD = re.compile(r"\S+")
DIGITS = re.compile(r"[0-9]+")
LETTERS = re.compile(r"[^\W0-9_]+")
EDGES = "\"'<>[]{},;:!?."

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for place, char in enumerate(reversed(digits)):
        value = int(char) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def emails(text: str) -> Iterator[Span]:
    """The local part is all its characters before an @, back to the match or the @ before."""
    low = 0
    at = text.find("@")
    while at >= 0:
        before = text[low:at]
        local = len(before) - len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end(), "email"
        low = domain.end() if domain else at + 1
        at = text.find("@", low)


def is_card(text: str) -> bool:
    digits = only_digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns by start, then kind as listed."""
    if not SIGNAL.search(text):
        return []
    found = list(emails(text))
    found += [(*m.span(), "ip") for m in IP.finditer(text) if is_ip(m.group())]
    found += [(*m.span(), "card") for m in CARD.finditer(text) if is_card(m.group())]
    found += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= len(only_digits(m.group())) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def bucket(name: str) -> int:
    return zlib.crc32(name.encode()) % (BUCKETS - 1) + 1


def shape(word: str) -> str:
    """Digit runs by their length, letter runs as one a, other characters as they are."""
    return LETTERS.sub("a", DIGITS.sub(lambda m: f"<{min(len(m.group()), 20)}>", word))[:40]


def sites(text: str, base: list[Span], most: int | None = None):
    """Words with a digit or an @: (start, end) without edge marks, features, base label, place in the text, keys for skip links."""
    places, features, labels, numbers, keys = [], [], [], [], []
    words = [m.span() for m in WORD.finditer(text)]
    part = lambda i: text[words[i][0] : words[i][1]] if 0 <= i < len(words) else ""
    first = 0
    for i, (start, end) in enumerate(words):
        word = text[start:end]
        if not SIGNAL.search(word):
            continue
        inner = word.strip(EDGES)
        start += len(word) - len(word.lstrip(EDGES))
        end = start + len(inner)
        while first < len(base) and base[first][1] <= start:
            first += 1
        label = KINDS.index(base[first][2]) if first < len(base) and base[first][0] < end else CLEAR
        digits = only_digits(inner)
        names = [
            "bias", f"shape {shape(inner)}", f"digits {min(len(digits), 20)}", f"before {shape(part(i - 1))}", f"after {shape(part(i + 1))}",
            f"dots {min(inner.count('.'), 5)}", f"at {'@' in inner} {bool(LETTERS.search(inner))}", f"plus {inner[:1] == '+'}"]
        if 12 <= len(digits) <= 19:
            names.append(f"luhn {luhn(digits)}")
        if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", inner):
            names.append(f"parts {is_ip(inner)}")
        if "@" in inner:
            names.append(f"domain {bool(re.search(r'@[A-Za-z0-9-]+[.][A-Za-z0-9-]', inner))}")
        places.append((start, end))
        features.append([bucket(f"base {label}") if label != CLEAR else 0] + [bucket(name) for name in names])
        labels.append(label)
        numbers.append(i)
        keys.append((inner.lower(), digits if len(digits) >= 5 else None))
        if most and len(places) == most:
            break
    return places, features, labels, numbers, keys


def links(numbers: list[int], keys: list[tuple[str, str | None]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(chain, skip) pairs of sites: neighbouring words; equal words or digits, each with its next occurrence."""
    chain = [(i, i + 1) for i in range(len(numbers) - 1) if numbers[i + 1] == numbers[i] + 1]
    skip, last = set(), {}
    for i, (word, digits) in enumerate(keys):
        for key in [("word", word)] + ([("digits", digits)] if digits else []):
            if key in last and numbers[i] > numbers[last[key]] + 1:
                skip.add((last[key], i))
            last[key] = i
    return chain, sorted(skip)


class Graph:
    """Sites of many documents with their links, as arrays."""

    def __init__(self) -> None:
        self.features: list[list[int]] = []
        self.labels: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, features, labels, chain, skip) -> int:
        base = len(self.features)
        self.features += features
        self.labels += labels
        self.chain += [(a + base, b + base) for a, b in chain]
        self.skip += [(a + base, b + base) for a, b in skip]
        return base

    def arrays(self):
        rows = np.zeros((len(self.features), SLOTS), dtype=np.int64)
        for i, found in enumerate(self.features):
            rows[i, : len(found)] = found
        pairs = lambda found: np.array(found, dtype=np.int64).reshape(-1, 2)
        return rows, np.array(self.labels, dtype=np.int64), pairs(self.chain), pairs(self.skip)


def log_normal(scores: np.ndarray) -> np.ndarray:
    top = scores.max(axis=1, keepdims=True)
    return scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))


def pseudo_gradient(model, rows, labels, chain, skip):
    """(loss, gradients) of the negative pseudo-likelihood: every label given those of its linked words."""
    weights, follow, agree = model
    scores = weights[rows].sum(axis=1)
    np.add.at(scores, chain[:, 1], follow[labels[chain[:, 0]]])
    np.add.at(scores, chain[:, 0], follow[:, labels[chain[:, 1]]].T)
    both = agree + agree.T
    np.add.at(scores, skip[:, 0], both[labels[skip[:, 1]]])
    np.add.at(scores, skip[:, 1], both[labels[skip[:, 0]]])
    logs = log_normal(scores)
    at = np.arange(len(labels))
    error = np.exp(logs)
    error[at, labels] -= 1.0
    d_weights, d_follow, d_both = np.zeros_like(weights), np.zeros_like(follow), np.zeros_like(agree)
    np.add.at(d_weights, rows.ravel(), np.repeat(error, rows.shape[1], axis=0))
    np.add.at(d_follow, labels[chain[:, 0]], error[chain[:, 1]])
    np.add.at(d_follow.T, labels[chain[:, 1]], error[chain[:, 0]])
    np.add.at(d_both, labels[skip[:, 1]], error[skip[:, 0]])
    np.add.at(d_both, labels[skip[:, 0]], error[skip[:, 1]])
    d_weights[0] = 0.0
    return -logs[at, labels].sum(), (d_weights, d_follow, d_both + d_both.T)


def train(rows, labels, chain, skip, steps: int = STEPS):
    """(weights, chain potentials, skip potentials) by adaptive gradient steps, hiding features anew in every step."""
    model = [np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))]
    if not (labels != CLEAR).any():
        return None
    rng = np.random.default_rng(SEED)
    first, second = [np.zeros_like(p) for p in model], [np.zeros_like(p) for p in model]
    for step in range(1, steps + 1):
        shown = np.where(rng.random(rows.shape) < 0.1, 0, rows)
        shown[:, 0] = np.where(rng.random(len(rows)) < 0.5, 0, rows[:, 0])
        shown[:, 1] = rows[:, 1]
        _, gradients = pseudo_gradient(model, shown, labels, chain, skip)
        for k, gradient in enumerate(gradients):
            gradient = gradient + 0.3 * model[k]
            first[k] = 0.9 * first[k] + 0.1 * gradient
            second[k] = 0.99 * second[k] + 0.01 * gradient**2
            model[k] = model[k] - 0.1 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return tuple(model)


def marginals(scores: np.ndarray, chain: np.ndarray, skip: np.ndarray, follow: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Label probabilities of every site by sum-product messages along all links, exact where the links form trees."""
    pairs = np.concatenate([chain, skip])
    if not len(pairs):
        return np.exp(log_normal(scores)) if len(scores) else scores
    both = agree + agree.T
    potential = np.concatenate([np.broadcast_to(follow, (len(chain), LABELS, LABELS)), np.broadcast_to(both, (len(skip), LABELS, LABELS))])
    source = np.concatenate([pairs[:, 0], pairs[:, 1]])
    target = np.concatenate([pairs[:, 1], pairs[:, 0]])
    potential = np.concatenate([potential, potential.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
    messages = np.zeros((len(source), LABELS))
    for turn in range(ROUNDS + 1):
        belief = scores.copy()
        np.add.at(belief, target, messages)
        if turn == ROUNDS:
            break
        sent = (belief[source] - messages[back])[:, :, None] + potential
        top = sent.max(axis=1)
        fresh = log_normal(top + np.log(np.exp(sent - top[:, None, :]).sum(axis=1)))
        moved = np.abs(fresh - messages).max()
        messages = 0.5 * messages + 0.5 * fresh if turn > LABELS else fresh
        if moved < 1e-5:
            break
    return np.exp(log_normal(belief))


def changed(text: str, base: list[Span], rng: random.Random) -> str:
    """The text with base spans made invalid or repeated and with made-up numbers at its end."""
    parts, at, repeats = [], 0, []
    for start, end, kind in base:
        if start < at:
            continue
        parts.append(text[at:start])
        span, at = text[start:end], end
        if rng.random() < 0.5:
            repeats.append(span)
        elif kind == "card":
            span = span[:-1] + str((int(span[-1]) + rng.randint(1, 9)) % 10)
        elif kind == "ip":
            span = str(rng.randint(256, 999)) + span[span.index("."):]
        elif kind == "phone":
            span = span[1 : 1 + rng.randint(2, 6)]
        else:
            span = span.replace(".", "").replace("@", rng.choice(["@", " @ ", ""]))
        parts.append(span)
    number = lambda: "".join(rng.choice("0123456789") for _ in range(rng.randint(1, rng.choice([3, 6, 20]))))
    for _ in range(6):
        parts.append(" word " + rng.choice(["", "$", "#", "(", "v"]) + rng.choice("-./:,").join(number() for _ in range(rng.randint(1, 4))))
    return "".join(parts) + text[at:] + " word " + " word ".join(repeats)


def fit(docs: DataFrame):
    """A model trained on about ``FIT_DOCS`` documents with a digit or an @; None without any base span."""
    able = docs.where(F.col("text").rlike("[0-9@]")).select("text")
    count = able.count()
    if not count:
        return None
    draw = F.abs(F.xxhash64(F.lit(SEED), F.monotonically_increasing_id())) % 1_000_003
    chosen = able.where(draw < int(min(1.0, FIT_DOCS / count) * 1_000_003) + 1)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                base = base_spans(text)
                for version in (text, changed(text, base, random.Random(zlib.crc32(text.encode())))):
                    _, features, labels, numbers, keys = sites(version, base_spans(version), FIT_SITES)
                    chain, skip = links(numbers, keys)
                    out.append({"features": features, "labels": labels, "chain": [list(p) for p in chain], "skip": [list(p) for p in skip]})
            kind = pa.list_(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pylist(out, pa.schema(
                [("features", kind), ("labels", pa.list_(pa.int64())), ("chain", kind), ("skip", kind)]))

    graph = Graph()
    nested = "array<array<bigint>>"
    for row in sorted(chosen.mapInArrow(learn, f"features {nested}, labels array<bigint>, chain {nested}, skip {nested}").collect(), key=str):
        graph.add(row["features"], row["labels"], row["chain"], row["skip"])
    return train(*graph.arrays()) if graph.features else None


def added_spans(text: str, base: list[Span], places: list[tuple[int, int]], numbers: list[int], chances: np.ndarray) -> list[Span]:
    """Runs of neighbouring words that surely have one kind and touch no base span."""
    found: list[list] = []
    for (start, end), number, chance in zip(places, numbers, chances):
        kind = int(chance.argmax())
        if kind == CLEAR or chance[kind] < SURE or end <= start:
            continue
        if found and found[-1][2] == kind and found[-1][3] == number - 1:
            found[-1][1], found[-1][3] = end, number
        else:
            found.append([start, end, kind, number])
    out, first = [], 0
    for start, end, kind, _ in found:
        while first < len(base) and base[first][1] <= start:
            first += 1
        if first == len(base) or base[first][0] >= end:  # the first span that ends later starts behind it, and so do all others
            out.append((start, end, KINDS[kind]))
    return out


def find(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """``keep`` columns plus base and all spans, each an array of (start, end, kind)."""
    span = "array<struct<start:bigint,end:bigint,kind:string>>"
    fields = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            graph, texts, bases, held = Graph(), batch["text"].to_pylist(), [], []
            for text in texts:
                bases.append(base_spans(text or ""))
                if model is None or not text or not SIGNAL.search(text):
                    held.append(None)
                    continue
                places, features, labels, numbers, keys = sites(text, bases[-1])
                held.append((graph.add(features, labels, *links(numbers, keys)), places, numbers))
            if graph.features:
                rows, _, chain, skip = graph.arrays()
                chances = marginals(model[0][rows].sum(axis=1), chain, skip, model[1], model[2])
            spans = []
            for text, base, own in zip(texts, bases, held):
                more = []
                if own:
                    at, places, numbers = own
                    more = added_spans(text, base, places, numbers, chances[at : at + len(places)])
                spans.append(sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]))))
            listed = lambda rows: pa.array([[{"start": a, "end": b, "kind": k} for a, b, k in row] for row in rows],
                                           pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])))
            yield pa.RecordBatch.from_arrays([*(batch[name] for name in keep), listed(bases), listed(spans)], names=[*keep, "base", "spans"])

    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(work, f"{fields}, base {span}, spans {span}")


def op11_private_data(spark, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, fit(docs), ["doc_id"])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{kind}')) AS bigint)").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
