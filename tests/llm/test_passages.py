"""Passage removal against brute force, and the suffix arrays under it."""

import hashlib
import random

import numpy as np
import pytest

from leftovers import left_of, shuffle_files
from tillweave.llm import frames, kernels, passages, suffixes


def brute(rows):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, digest)}; strings belong to the smallest document that has them."""
    owner = {}
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    for doc_id, text in texts:
        for at in range(len(text) - passages.LENGTH + 1):
            part = text[at : at + passages.LENGTH]
            owner[part] = min(doc_id, owner.get(part, doc_id))
    result = {}
    for doc_id, text in texts:
        gone = [False] * len(text)
        for at in range(len(text) - passages.LENGTH + 1):
            if owner[text[at : at + passages.LENGTH]] < doc_id:
                gone[at : at + passages.LENGTH] = [True] * passages.LENGTH
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        result.setdefault(doc_id, set()).add((len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return result


def found(df):
    result = {}
    for row in df.collect():
        result.setdefault(row["doc_id"], set()).add((row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]))
    return result


def check(docs, rows):
    got = passages.without_repeats(docs, ["doc_id"])
    assert got.count() == len(rows)
    assert found(got) == brute(rows)


@pytest.mark.parametrize("letters", [1, 2, 5, 30])
def test_suffix_orders(letters):
    rng = random.Random(letters)
    strings = [[rng.randint(1, letters) for _ in range(rng.randint(0, 70))] + [0] for _ in range(120)]
    bounds = np.cumsum([0, *map(len, strings)])
    orders = suffixes.suffix_orders(np.array([x for s in strings for x in s]), bounds)
    for i, text in enumerate(strings):
        assert (orders[bounds[i] : bounds[i + 1]] - bounds[i]).tolist() == sorted(range(len(text)), key=lambda k: text[k:])


def test_groups_are_lyndon_prefixes():
    text = list(b"mississippi_is_missing") + [0]
    group, pointer = suffixes.grouped(np.array(text), np.array([0, len(text)]))
    for i in range(len(text)):
        smaller = [j for j in range(i) if text[j:] < text[i:] and group[j] < group[i]]
        assert pointer[i] == max(smaller, default=-1)


def test_against_brute_force(documents):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(40)]
    sentence = lambda n: " ".join(rng.choices(vocabulary, k=n))
    shared = [sentence(rng.randint(8, 60)) for _ in range(12)]
    rows = []
    for doc_id in range(120):
        parts = [rng.choice(shared) if rng.random() < 0.4 else sentence(rng.randint(1, 30)) for _ in range(rng.randint(1, 6))]
        rows.append((doc_id * 7 % 120, rng.choice(["", " ", "\n"]).join(parts)))
    base = rows[5][1]
    rows += [(200 + i, base[:40] + str(i) + base[41:]) for i in range(12)] + [(300, base), (301, base), (300, base)]
    rows += [(400, None), (401, ""), (402, "x" * 49), (403, "x" * 50), (404, "x" * 3000), (405, "ab" * 900), (405, "other text " * 9)]
    rows += [(406, "y" * 200_000 + base), (407, "z" + base + "y" * 60)]
    check(documents(rows), rows)


def test_crowded_anchor(documents):
    """More different fragments under one anchor than one task sorts."""
    rng = random.Random(5)
    passage = "this passage of somewhat more than fifty bytes is in every text"
    noise = lambda: "".join(rng.choices("abcdefghij ", k=80))
    rows = [(i, noise() + passage + noise()) for i in range(3 * passages.MOST)]
    rows += [(1000 + i, noise()[:40] + passage[:49]) for i in range(5)]
    check(documents(rows), rows)


def test_copies_far_apart(documents):
    """Copies that do not share an Arrow batch."""
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdefghij ", k=150)) for _ in range(30)]
    rows = [(i, texts[i * 13 % 30] + (" tail" if i % 3 else "")) for i in range(1500)]
    check(documents(rows).repartition(7), rows)


def test_empty(documents):
    assert passages.without_repeats(documents([(1, "a")]).where("doc_id < 0"), ["doc_id"]).count() == 0


def test_text_is_cut_between_characters(documents):
    # The first byte of the last letter (è) is also that of é, so it goes with the passage, and the rest of the letter with it.
    rows = [(1, "é" * 40), (2, "xé" + "é" * 39 + "è tail")]
    kept = {r["doc_id"]: r["text"] for r in passages.without_repeats(documents(rows), ["doc_id"], text=True).collect()}
    assert kept == {1: "é" * 40, 2: "x tail"}


def test_rows_without_an_id_take_no_part(spark, documents):
    passage = "a passage that is long enough to be found again in all of these rows, word for word. "
    rows = [(1, passage + "one"), (None, passage + "none"), (2, passage + "two"), (None, None), (None, passage + "none")]
    got = passages.without_repeats(documents(rows), ["doc_id"], text=True).collect()
    gone = {(r["doc_id"], r["text"]): r["n_removed"] for r in got}
    assert len(got) == 5 and gone[1, passage + "one"] == 0 and gone[None, passage + "none"] == 0 and gone[None, ""] == 0
    assert [r["n_removed"] for r in got if r["doc_id"] == 2] == [len(passage)]


@pytest.mark.parametrize("at", [60, 100_000])
def test_long_and_short_strings_are_sorted_apart(spark, documents, monkeypatch, at):
    monkeypatch.setattr(passages, "LONG_LANE", at)
    monkeypatch.setattr(passages, "SORTED_AT_ONCE", 500)
    rng = random.Random(at)
    parts = ["".join(rng.choice("abc ") for _ in range(rng.choice([55, 80, 200]))) for _ in range(6)]
    rows = [(i, "".join(rng.choice(parts)[rng.randint(0, 9):] for _ in range(4))) for i in range(40)]
    check(documents(rows), rows)


def letters(rng, n):
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))


def compared_docs(spark, docs):
    found = frames.store(passages.settled(passages.anchored(docs)), "test")
    return sorted(r["doc"] for r in found.where("g IS NOT NULL").select("doc").collect())


def test_fragments_without_a_partner_are_not_compared(spark, documents):
    rng = random.Random(7)
    phrases = [letters(rng, 30) for _ in range(200)]  # too short for a window, long enough for an anchor
    rows = [(i, letters(rng, 80) + phrases[i % 200] + letters(rng, 80)) for i in range(400)]
    again = letters(rng, 60)  # repeated within one document only
    rows += [(1000, letters(rng, 70) + again + letters(rng, 70) + again + letters(rng, 70))]
    assert len(compared_docs(spark, documents(rows))) <= 8  # the sides' hashes have 8 bits
    passage = letters(rng, 60)
    rows += [(2000, letters(rng, 70) + passage + letters(rng, 70)), (2001, letters(rng, 90) + passage + letters(rng, 50))]
    assert {2000, 2001} <= set(compared_docs(spark, documents(rows)))
    check(documents(rows), rows)


def test_anchors_that_come_in_pieces(spark, documents):
    rng = random.Random(8)
    stock = [letters(rng, 25) for _ in range(12)]
    rows = [(i, " ".join(rng.choices(stock, k=6)) + letters(rng, 20)) for i in range(120)]
    docs = documents(rows)
    anchored = frames.store(passages.anchored(docs), "test")

    def parts(df):
        got = [tuple(r) for r in df.collect()]
        return {r for r in got if r[0] is not None}, sorted(r for r in got if r[0] is None)

    whole = parts(passages.settled(anchored))
    with frames.batch_rows(spark, "3"):
        pieces = parts(passages.settled(anchored, at_once=1))
    assert pieces[0] >= whole[0] and pieces[1] == whole[1] and whole[0]
    check(docs, rows)


def test_texts_cut_together_give_the_fragments_of_each():
    rng = random.Random(9)
    texts = [letters(rng, n).encode() for n in (0, 10, 49, 50, 51, 300, 0, 120, 19, 2000, 50)] + ["a".encode() * 90]
    for order in (texts, texts[::-1]):
        bounds = np.cumsum([0, *map(len, order)])
        got = np.stack([c.astype(np.int64) for c in passages.fragments_of(np.frombuffer(b"".join(order), np.uint8), bounds)], axis=1)
        alone = []
        for number, text in enumerate(order):
            if len(text) >= passages.LENGTH:
                g, f, _, start, windows = passages.fragments_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
                alone += zip(g.astype(np.int64).tolist(), f.astype(np.int64).tolist(), [number] * len(g), start.tolist(), windows.tolist())
                assert windows.sum() == len(text) - passages.LENGTH + 1 and kernels.running(np.frombuffer(text, np.uint8)).size == len(text) + 1
        assert [tuple(r) for r in got.tolist()] == alone


def test_passages_leave_no_shuffle_files(spark, documents):
    rng = random.Random(10)
    passage = letters(rng, 60)
    docs = documents([(i, letters(rng, 70) + passage + letters(rng, 70)) for i in range(20)])
    before = shuffle_files(spark)
    assert passages.repeated_spans(docs).count() == 19
    assert len({name.split("_")[1] for name in left_of(spark, before)}) <= 1  # that of the count
