"""Collocations against counting all phrases in plain Python; the transducers on their own."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.compare import difference, duck
from tillweave.llm import collocations, frames, queries, transducer

MIDDLE = "/root/testdata/sf0.01"


def plain_counts(rows):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    return f, n


def plain_collocations(rows, least, within=100, keep=2000):
    f, n = plain_counts(rows)
    out = []
    for lang, counts in f.items():
        long = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in long.items():
            inside = [b for q, b in long.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= within * a for b in inside):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(found[:keep])]
    return sorted(out)


def chatter(rng, words, length):
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!", " ; ", "\x0b"]
    return "".join(rng.choice(words) + rng.choice(marks) for _ in range(length))


@pytest.mark.parametrize("least, within, range_bytes", [(2, 100, 1 << 30), (3, 100, 700), (4, 60, 300), (2, 100, 64)])
def test_against_counting(spark, documents, monkeypatch, least, within, range_bytes):
    monkeypatch.setattr(collocations, "EVERY", 3)
    rng = random.Random(least * range_bytes)
    words = ["a", "b", "A", "to", "été", "Été", "be", "x" * 60, "x" * 50 + "y", "it's", "日本", " "]
    rows = [(i, chatter(rng, words, rng.randint(0, 60)), rng.choice(["en", "en", "fr", None, "und", ""])) for i in range(120)]
    rows += [(None, None, "en"), (7, "", "fr"), (8, "a b c d e f g " * 5, "en"), (8, "a b c d e f g " * 5, "en"), (9, "...,,,", None)]
    got = collocations.collocations(documents(rows), least=least, within=within, range_bytes=range_bytes).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations([(r[1], r[2]) for r in rows], least, within)


def test_one_word_is_a_third_of_all(spark, documents, monkeypatch):
    """Windows that begin with a hot word are spread over ranges, and no range holds much more than its share."""
    monkeypatch.setattr(collocations, "EVERY", 2)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["hot", "hot", f"w{rng.randint(0, 50)}"]) for _ in range(200)), "en") for i in range(200)]
    texts = frames.store(documents(rows).select("lang", "text"), "texts")
    cuts = collocations.borders(texts, 5, 8000)
    sizes = {r["range"]: r["n"] for r in collocations.shard_transducers(texts, cuts, 5).groupBy("range").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert sum(sizes.values()) == 40_000 and len(sizes) > 10
    assert max(sizes.values()) < 40_000 / 4
    got = collocations.collocations(documents(rows), least=30, range_bytes=8000).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations([(r[1], r[2]) for r in rows], 30)


def test_empty_and_rare(spark, documents):
    assert collocations.collocations(documents([(1, "just a few words"), (2, None)])).count() == 0
    assert collocations.collocations(documents([(1, "a b")]).where("doc_id < 0")).count() == 0


def test_exact_beyond_64_bits(spark):
    rows = spark.createDataFrame([("en", "p", 3 * 10**9, 1, 3 * 10**9 + 1, 3 * 10**9 + 7, 10**13 + 3)], "lang string, phrase string, a bigint, k int, l bigint, r bigint, n bigint")
    assert collocations.scored(rows).first()["score"] == 1000 * 3 * 10**9 * (10**13 + 3) // ((3 * 10**9 + 1) * (3 * 10**9 + 7))


def test_transducers_share_suffixes_and_add_up():
    rng = random.Random(5)
    total, blobs = Counter(), []
    for _ in range(4):
        names = pa.array([bytes([97 + i]) for i in range(rng.randint(3, 6))], pa.large_binary())
        rows = [[rng.randint(1, len(names)) for _ in range(rng.randint(1, 5))] for _ in range(300)]
        for row in rows:
            for k in range(1, len(row) + 1):
                total[tuple(row[:k])] += 1
        padded = np.array([row + [0] * (5 - len(row)) for row in rows], dtype=np.int64)
        columns, weights = transducer.distinct(list(padded.T))
        levels = transducer.build(columns, weights)
        assert len(levels[4][0]) - 1 < sum(1 for row in {tuple(r[:4]) for r in rows if len(r) >= 4})
        kept, own = transducer.used(columns, names)
        blobs.append(transducer.pack(transducer.build(kept, weights), own))
    found, words = transducer.union(blobs, 5, [])
    got = {tuple(path): int(w) for paths, weight, _ in found for path, w in zip(paths.tolist(), weight)}
    assert got == {p: c for p, c in total.items() if c >= 5}


def test_query_equals_its_sql(spark):
    got = queries.QUERIES["op13_collocations"](spark, MIDDLE)
    assert got.count() > 50
    assert difference(got, duck(MIDDLE), queries.SQL["op13_collocations"]) is None
