"""Packing: exact round trip of ids, windows within capacity, differencing."""

import itertools
import random
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tillweave.llm import kernels, packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.vocabulary_path())


ODD = [
    None, "", " ", "\n\n", "It's THE d'été.! »., (foo). ﬁ Ǆ İstanbul ΣΑΣ. á. x y\tz\r\nq 12.5 é! straße ÿþ÷ø à",
    "<|endoftext|> mid <|ENDOFTEXT|>", "a'll. 's' 'S. rock'n'roll", "日本語 テキスト。 مرحبا 👍🏽!!", "x" * 9000, "word " * 5000,
    "trailing...*** $$$ a# b) c). «d».", "naïve space wide", "ÀÉÎ ÀÉÎ,",
]


def test_round_trip(documents, tokenizer):
    rng = random.Random(1)
    rows = [(i, text) for i, text in enumerate(ODD)]
    rows += [(100 + i, " ".join(rng.choices(["alpha", "beta,", "Gamma.", "delta"], k=rng.randint(0, 2500)))) for i in range(150)]
    rows.append((3, ODD[3]))
    pieces = packing.pack(documents(rows), packing.vocabulary_path(), group=64).collect()
    expected = {}
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        expected[doc_id] = np.array(ids, dtype="<u4")
    by_doc, by_sequence = {}, {}
    for piece in pieces:
        by_doc.setdefault(piece["doc_id"], []).append(piece)
        by_sequence.setdefault(piece["sequence_id"], []).append(piece)
    times = {doc_id: sum(1 for r in rows if r[0] == doc_id) for doc_id, _ in rows}
    for doc_id, ids in expected.items():
        own = sorted(by_doc[doc_id], key=lambda p: p["start"])
        covered = np.zeros(len(ids), dtype=int)
        for p in own:
            part = ids[p["start"] : p["start"] + p["length"]]
            assert p["doc_tokens"] == len(ids) and p["length"] == len(part) and p["ids_crc32"] == zlib.crc32(part.tobytes())
            covered[p["start"] : p["start"] + p["length"]] += 1
        assert (covered == times[doc_id]).all()
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= packing.WINDOW and at & (at - 1) == 0  # full, or of a length that needs no padding


def test_differencing():
    found = packing.difference([8, 7, 6, 5, 4], 2)
    assert sorted(i for w in found for i in w) == [0, 1, 2, 3, 4]
    rng = random.Random(2)
    for windows in (1, 2, 5, 40):
        sizes = [rng.randint(1, 2047) for _ in range(200)]
        found = packing.difference(sizes, windows)
        sums = [sum(sizes[i] for i in w) for w in found]
        assert len(found) == windows and sorted(i for w in found for i in w) == list(range(200))
        assert max(sums) - min(sums) <= max(sizes)
    near = packing.near_equal([1500] * 10)
    assert len(near) == 10  # two of them exceed a window, so the count rises until each has its own


def test_levelled_has_no_padding():
    rng = random.Random(3)
    for n in (1, 2, 30, 300):
        sizes = [rng.randint(1, 2047) for _ in range(n)]
        taken = [np.zeros(size, dtype=int) for size in sizes]
        for window in packing.levelled(sizes):
            length = sum(p[2] for p in window)
            assert length and length <= 2048 and length & (length - 1) == 0
            for item, start, size in window:
                taken[item][start : start + size] += 1
        assert all((t == 1).all() for t in taken)


def test_empty(documents):
    assert packing.pack(documents([(1, "a")]).where("doc_id < 0"), packing.vocabulary_path()).count() == 0


def test_the_encoder_is_kept_for_packing_only():
    path = packing.vocabulary_path()
    first = list(kernels.lean(lambda batches: (packing.encoder(path) for _ in batches), keep=True)([0]))[0]
    assert list(kernels.lean(lambda batches: (packing.encoder(path) for _ in batches), keep=True)([0])) == [first]
    freed = weakref.ref(first)
    del first
    assert list(kernels.lean(lambda batches: batches)([1, 2])) == [1, 2]
    assert freed() is None and not kernels.kept


def test_remembered_chunks_stay_few(tokenizer):
    words = ["".join(letters) for letters in itertools.islice(itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=5), 840_000)]
    encode = packing.Encoder(packing.vocabulary_path())
    for start in range(0, len(words), 280_000):
        encode(pa.array([" ".join(words[start : start + 280_000]).encode()]))
    assert len(encode.known) + len(encode.older) < 600_000
    assert np.frombuffer(encode(pa.array([b"aaaaa zebra"]))[0], "<u4").tolist() == tokenizer.encode("aaaaa zebra", add_special_tokens=False).ids
