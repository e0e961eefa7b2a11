"""Private data: patterns against their literal form, messages against enumeration, gradients, repeated mentions."""

import hashlib
import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tillweave.llm import frames, pii, queries

MIDDLE = "/root/testdata/sf0.01"
LITERAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    found = []
    for order, (kind, pattern) in enumerate(LITERAL.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            doubled = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                    "card": 12 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), order, m.end(), kind))
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


def test_patterns_are_the_literal_ones():
    rng = random.Random(3)
    for alphabet in ("a1@.-é ", "0123.5 ", "+(1) -.7", "4111 -1", "@a.", "ab1@.+-() 25é\n"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(text) == plain_base(text), repr(text)
    for text in ("4041 8949 7460 8795", "call +1 (988) 555-2485.", "x 1.2.3.4.5.6.7.8 y", "a@b@c.de", "1.2.3.0000255", "9" * 5000 + ".1.1.1"):
        if len(text) < 1000:
            assert pii.base_spans(text) == plain_base(text)
        else:
            assert pii.base_spans(text) == []


def test_long_runs_take_linear_time():
    for text in ("a" * 10**6, "1" * 10**6, "a@" * 500_000, "1." * 500_000, "+1" * 500_000, "+" + "1(" * 500_000, "1 " * 500_000):
        pii.base_spans(text)


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(6, pii.LABELS))
    chain, skip = np.array([[0, 1], [1, 2], [3, 4]]), np.array([[1, 3], [2, 5]])
    follow, agree = rng.normal(size=(5, 5)), rng.normal(size=(5, 5))
    want = np.zeros_like(scores)
    for y in itertools.product(range(pii.LABELS), repeat=6):
        total = sum(scores[i, y[i]] for i in range(6)) + sum(follow[y[a], y[b]] for a, b in chain)
        total += sum(agree[y[a], y[b]] + agree[y[b], y[a]] for a, b in skip)
        for i in range(6):
            want[i, y[i]] += np.exp(total)
    got = pii.marginals(scores, chain, skip, follow, agree)
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-3)
    none = np.zeros((0, 2), dtype=np.int64)
    assert np.allclose(pii.marginals(scores, none, none, follow, agree), np.exp(pii.log_normal(scores)))


def test_gradient_of_the_pseudo_likelihood(monkeypatch):
    monkeypatch.setattr(pii, "BUCKETS", 12)
    rng = np.random.default_rng(2)
    rows = rng.integers(1, 12, size=(7, 3))
    labels = rng.integers(0, pii.LABELS, size=7)
    chain, skip = np.array([[0, 1], [1, 2], [4, 5]]), np.array([[0, 4], [2, 6]])
    model = [rng.normal(size=(12, 5)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5))]
    _, gradients = pii.pseudo_gradient(model, rows, labels, chain, skip)
    for k in range(3):
        for place in [(1, 2), (4, 0), (3, 4)]:
            moved = [p.copy() for p in model]
            moved[k][place] += 1e-5
            less = [p.copy() for p in model]
            less[k][place] -= 1e-5
            slope = (pii.pseudo_gradient(moved, rows, labels, chain, skip)[0] - pii.pseudo_gradient(less, rows, labels, chain, skip)[0]) / 2e-5
            assert abs(slope - gradients[k][place]) < 1e-4


def test_links_join_repeats_to_the_next_one():
    text = "call 555-2485 now 555-2485 or (555-2485) and 5552485 x 12 y 12"
    _, _, _, numbers, keys = pii.sites(text, [])
    chain, skip = pii.links(numbers, keys)
    assert (0, 1) in skip and (1, 2) in skip and (2, 3) in skip and (4, 5) in skip and not chain


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in frames.table(spark, MIDDLE, "documents").collect()}
    got = queries.QUERIES["op11_private_data"](spark, MIDDLE).collect()
    assert len(got) == len(docs)
    added = 0
    for r in got:
        base = plain_base(docs[r["doc_id"]])
        assert [r[f"n_{kind}"] for kind in LITERAL] == [sum(k == kind for _, _, k in base) for kind in LITERAL]
        assert r["base_sha256"] == hashlib.sha256(pii.written(base).encode()).hexdigest()
        spans = [s for s in r["spans"].split(",") if s]
        assert set(pii.written(base).split(",")) - {""} <= set(spans)
        added += len(spans) - len(base)
    assert added <= 5  # the given tables write their private data in full


def make(rng):
    card = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    card += next(c for c in "0123456789" if pii.luhn(card + c))
    return {"email": f"{rng.choice('abcd')}{rng.randint(1, 999)}.x@mail{rng.randint(1, 9)}.example.com", "card": card,
            "ip": ".".join(str(rng.randint(1, 255)) for _ in range(4)), "phone": f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"}


def test_distant_mentions_agree(spark, documents):
    rng = random.Random(8)
    filler = "some plain words of a clean text follow here. "
    rows = [(i, filler * rng.randint(1, 5) + "write " + make(rng)[rng.choice(list(LITERAL))] + " and " + filler) for i in range(400)]
    model = pii.fit(documents(rows))
    phone = "+1 (423) 567-8899"
    cases = [(1, f"ring {phone} today. {filler * 30} again (423) 567-8899 please"), (2, filler), (3, None), (4, ""),
             (5, "version 2.0.1 of 2024-05-17 costs 1,234.50 at 12:30"), (None, "no id but a.b@c.de"), (1, "twice 10.1.2.3"), (1, "twice 10.1.2.3"),
             (6, "order 4041894974608796 and build 777.1.2.3")]
    found = pii.find(documents(cases), model, ["doc_id", "score"]).collect()
    spans = {(r["doc_id"], tuple((s["start"], s["end"], s["kind"]) for s in r["spans"])) for r in found}
    late = cases[0][1].index("(423) 567-8899 please")
    assert len(found) == len(cases) and {r["score"] for r in found} == {1}
    first = next(r for r in found if r["doc_id"] == 1 and len(r["spans"]) and r["spans"][0]["kind"] == "phone")
    assert [(s["start"], s["end"]) for s in first["spans"]] == [(5, 22), (late, late + 14)]
    for doc in (2, 3, 4, 5, 6):
        assert (doc, ()) in spans
    assert (None, ((10, 18, "email"),)) in spans
    assert sum(1 for r in found if [s["kind"] for s in r["spans"]] == ["ip"]) == 2
    bare = pii.find(documents(cases[:1]), None, ["doc_id"]).first()
    assert len(bare["spans"]) == len(bare["base"]) == 1
    assert pii.fit(documents([(1, "clean"), (2, None)])) is None
    assert pii.find(documents(rows[:1]).where(F.lit(False)), model, ["doc_id"]).count() == 0
