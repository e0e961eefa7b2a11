"""Merkle manifest against a plain recursive tree, and its digests against the SQL."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.compare import difference, duck
from tillweave.llm import frames, merkle, queries

MIDDLE = "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(nodes, fanout):
    """(root, siblings (left, right) of each node by level)."""
    paths = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        upper, held = [], []
        for start in range(0, len(nodes), fanout):
            run = nodes[start : start + fanout]
            for k, _ in enumerate(run):
                for row in members[start + k]:
                    paths[row].append(("".join(run[:k]), "".join(run[k + 1 :])))
            upper.append(sha("".join(run)))
            held.append([row for one in members[start : start + fanout] for row in one])
        nodes, members = upper, held
    return nodes[0], paths


def plain_manifest(rows, fanout=2):
    """{(doc_id, leaf): (subroot, root, path)} of (doc_id, source, lang, n_chars, text) rows; equal rows share a list."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], sha("".join(written(v) for v in row))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        below[name] = plain_tree([leaf for _, leaf in groups[name]], fanout)
    root, over = plain_tree([below[name][0] for name in names], fanout)
    found = []
    for place, name in enumerate(names):
        subroot, paths = below[name]
        found += [(doc, leaf, subroot, root, paths[i] + over[place]) for i, (doc, leaf) in enumerate(groups[name])]
    return found


@pytest.mark.parametrize("fanout, window", [(2, 8), (3, 10), (2, 1 << 10)])
def test_manifest_is_the_plain_tree(spark, documents, monkeypatch, fanout, window):
    monkeypatch.setattr(merkle, "WINDOW", window)
    rng = random.Random(fanout * window)
    langs = [None, "", "en", "é", "zz"]
    rows = [(i, f"text {i}", rng.choice(langs), "s") for i in rng.sample(range(10**6), 90)]
    rows += [(rows[0][0], "another text", rows[0][2], "s"), (None, None, "en", None), (None, "", "en", "s"), (7, "lone", "single", "s")]
    docs = documents(rows)
    got = merkle.manifest(docs, "lang", "doc_id", merkle.FIELDS, fanout=fanout)
    got = sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]]) for r in got.collect()), key=str)
    want = plain_manifest([(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs.collect()], fanout)
    assert got == sorted(want, key=str)


def test_equal_rows_and_small_tables(spark, documents):
    same = documents([(5, "copy", "en")] * 37)
    rows = merkle.manifest(same, "lang", "doc_id", merkle.FIELDS).select("*", merkle.fold(F.col("leaf"), F.col("path")).alias("up")).collect()
    want = plain_manifest([(5, "s", "en", 4, "copy")] * 37)
    assert sorted(str([tuple(s) for s in r["path"]]) for r in rows) == sorted(str(w[4]) for w in want)
    assert {r["up"] for r in rows} == {want[0][3]}
    lone = merkle.manifest(documents([(1, None, None, None)]), "lang", "doc_id", merkle.FIELDS)
    row = lone.select("*", merkle.proof_digest(F.col("path")).alias("proof")).first()
    assert row["leaf"] == row["subroot"] == row["root"] == sha("1:1" + "--" + "1:0" + "-")
    assert row["proof"] == sha("") and row["path"] == []
    assert merkle.manifest(same.where("doc_id < 0"), "lang", "doc_id", merkle.FIELDS).count() == 0


def test_query_finds_what_was_tampered_with(spark):
    got = queries.QUERIES["op12_merkle_manifest"](spark, MIDDLE)
    assert difference(got, duck(MIDDLE), queries.SQL["op12_merkle_manifest"]) is None
    for row in got.collect():
        assert row["verified"] == (zlib.crc32(str(row["doc_id"]).encode()) % 7 != 0)


def test_no_window_holds_a_group(spark, documents):
    docs = documents([(i, "t", "en") for i in range(3000)])
    leaves = frames.store(docs.select(F.col("doc_id").alias("key"), F.lit("=en").alias("grp"), F.sha2(F.col("doc_id").cast("string").cast("binary"), 256).alias("node")), "leaves")
    passes = merkle.trees(merkle.numbered(leaves, "key", "node"), 2)
    assert [p.count() for p in passes] == [3000, 3, 1]
    assert passes[0].groupBy(F.expr(f"at div {merkle.WINDOW}")).count().agg(F.max("count")).first()[0] == merkle.WINDOW
