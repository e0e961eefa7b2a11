"""Packing tokenised documents into fixed windows by multiway Karmarkar-Karp differencing.

A document's ids are cut into full windows of ``WINDOW`` ids and a rest. Rests are gathered in groups of ``GROUP`` and each
group is partitioned into near-equal windows: every rest starts as a partial partition with one filled window, and the two
partial partitions with the widest spread are merged again and again, the fullest windows of one with the emptiest of the
other. If a window then exceeds the capacity, the group is partitioned once more into one window more.

The near-equal windows are levelled at the end. As many as the ids can fill are topped up to exactly ``WINDOW`` with pieces
cut from the last ones; what is left over lies in windows whose lengths are powers of two, which need no padding.

Everything happens inside the task that tokenised the documents, so no ids are shuffled; memory is bounded by one group.
Sequence ids hold the partition number in their upper bits and are unique.

Defined results: a null text counts as empty and has one id, the end mark. Rows are packed one by one, so a repeated doc_id
gives repeated pieces. Other columns than doc_id and text are not read. An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tillweave.llm import frames, kernels

WINDOW = 2048
GROUP = 512
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)
# Remembered chunks in each of two generations of an encoder; results never depend on it. Two of 250,000 take about 120 MB of a Python process.
CHUNKS, CHUNK_BYTES = 250_000, 48
# Bytes of text whose chunks are numbered together.
RUN_BYTES = 4 << 20
# ASCII punctuation that may end a chunk; the apostrophe is left out because it opens tokens of its own ('s, 't, ...).
TRAILING = b".,!?;:*$%&#"
# Words of the small letters a-z and U+00DF-U+00F6, U+00F8-U+00FF in UTF-8.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
# Fixed values of byte-level vocabularies: the sign that stands for a byte that has no printable one of its own.
BYTE_SIGNS = {byte: 256 + 33 + byte - 127 for byte in range(127, 161)} | {173: 256 + 33 + 34}

# Bytes between chunks, and every byte as a small letter.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x0A]] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] = _SMALL[97:123]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """ids of whole texts (UTF-8 bytes) as little-endian unsigned 32-bit bytes.

    The tokenizer ignores case and never lets a token span white space, so a text's ids are those of its small-letter
    chunks between blanks and line ends, and a chunk that comes often is encoded once. A text that may hold a special
    token, which is matched in its exact case, is encoded as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}

    def _word(self, stem: bytes) -> bytes:
        """ids of one word of small Latin letters, which no normalisation changes: straight from the merges."""
        signs = stem.decode() if stem.isascii() else stem.decode("latin-1").translate(BYTE_SIGNS)
        return np.array([token.id for token in self.tokenizer.model.tokenize(signs)], dtype="<u4").tobytes()

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(code.ids, dtype="<u4").tobytes() for code in found]

    def _learn(self, chunks: set[bytes]) -> None:
        known, older, parts, new = self.known, self.older, [], set()
        for chunk in chunks:
            if chunk in older:
                known[chunk] = older[chunk]
                continue
            stem = chunk.rstrip(TRAILING)
            if PLAIN.fullmatch(stem):
                if stem not in known:
                    known[stem] = older[stem] if stem in older else self._word(stem)
                if len(stem) < len(chunk):  # letters and a run of punctuation are tokens apart
                    parts.append((chunk, stem))
                    if chunk[len(stem) :] not in known:
                        new.add(chunk[len(stem) :])
            else:
                new.add(chunk)
        unknown = list(new)
        for start in range(0, len(unknown), 4096):
            part = unknown[start : start + 4096]
            known.update(zip(part, self._encode([chunk.decode() for chunk in part])))
        for chunk, stem in parts:
            known[chunk] = known[stem] + known[chunk[len(stem) :]]

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        """ids of different chunks; those met for the first time are learnt."""
        if len(self.known) > CHUNKS:
            self.older = {chunk: ids for chunk, ids in self.known.items() if len(chunk) <= CHUNK_BYTES}
            self.known = {b"": b""}
        new = [chunk for chunk in chunks if chunk not in self.known]
        if new:
            self._learn(set(new))
        return list(map(self.known.__getitem__, chunks))

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """ids of every text of a binary column; a null is an empty text.

        The chunks of a run of texts are numbered by a dictionary, each different chunk is looked up once, and the ids of all are
        gathered from there.
        """
        data, offsets = kernels.utf8(texts)
        result: list[bytes] = []
        for first, end in kernels.runs(offsets, RUN_BYTES):
            part, bounds = data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
            if not len(part):
                result += [b""] * (end - first)
                continue
            inside = ~_BLANK[part]
            begins, stops = inside.copy(), inside.copy()
            begins[1:] &= ~inside[:-1]
            stops[:-1] &= ~inside[1:]
            cut = bounds[(bounds > 0) & (bounds < len(part))]
            begins[cut], stops[cut - 1] = inside[cut], inside[cut - 1]
            starts = np.flatnonzero(begins)
            sizes = np.flatnonzero(stops) + 1 - starts
            chunks = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(starts),
                [None, pa.py_buffer(np.concatenate(([0], np.cumsum(sizes)))), pa.py_buffer(_SMALL[part[inside]])]).dictionary_encode()
            known = self._ids(chunks.dictionary.to_pylist())
            ids = np.frombuffer(b"".join(known), dtype="<u4")
            lengths = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
            code = chunks.indices.to_numpy()
            places = np.concatenate(([0], np.cumsum(lengths)))
            ends = np.concatenate(([0], np.cumsum(lengths[code])))
            at = np.repeat(places[code] - ends[:-1], lengths[code]) + np.arange(ends[-1])
            of_text = ends[np.searchsorted(starts, bounds)]
            found = ids[at].tobytes() if len(at) else b""
            run = [found[4 * a : 4 * b] for a, b in zip(of_text[:-1].tolist(), of_text[1:].tolist())]
            special = np.flatnonzero((part[:-1] == 0x3C) & (part[1:] == 0x7C))
            for number in np.unique(np.searchsorted(bounds, special, side="right") - 1).tolist():
                text = part[bounds[number] : bounds[number + 1]].tobytes()
                if b"<|" in text:
                    run[number] = self._encode([text.decode()])[0]
            result += run
        return result


def encoder(path: str) -> Encoder:
    """The encoder of this Python process: the next task of packing goes on with the chunks that this one has learnt."""
    if path not in kernels.kept:
        kernels.kept[path] = Encoder(path)
    return kernels.kept[path]


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Multiway Karmarkar-Karp: item numbers of each of ``windows`` near-equal windows."""
    heap = []
    for number, size in enumerate(sizes):
        # Filled windows of a partial partition, fullest first; the windows not listed are empty.
        heap.append((-size, number, [(size, [number])]))
    heapq.heapify(heap)
    fresh = len(sizes)
    while len(heap) > 1:
        left, right = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        # Opposing ends meet: the fullest of one side goes with the emptiest of the other.
        overlap = len(left) + len(right) - windows
        if overlap <= 0:
            merged = left + right
        else:
            keep_left, keep_right = left[: len(left) - overlap], right[: len(right) - overlap]
            tail = [
                (a[0] + b[0], a[1] + b[1])
                for a, b in zip(left[len(left) - overlap :], reversed(right[len(right) - overlap :]))
            ]
            merged = keep_left + keep_right + tail
        merged.sort(key=lambda w: -w[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, fresh, merged))
        fresh += 1
    filled = [numbers for _, numbers in heap[0][2]] if heap else []
    return filled + [[] for _ in range(windows - len(filled))]


def near_equal(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``; one window more until none exceeds it."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, windows)
        if max(sum(sizes[i] for i in numbers) for numbers in found) <= capacity:
            return found
        windows += 1


def levelled(sizes: list[int], capacity: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (item, start, length): full ones, then windows whose lengths are powers of two."""
    found = sorted(near_equal(sizes, capacity), key=lambda numbers: -sum(sizes[i] for i in numbers))
    total = sum(sizes)
    full = total // capacity
    result = [[(i, 0, sizes[i]) for i in numbers] for numbers in found[:full]]
    spare = [(i, 0, sizes[i]) for numbers in found[full:] for i in numbers]
    rest = total % capacity
    goals = [(window, capacity - sum(p[2] for p in window)) for window in result]
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            result.append([])
            goals.append((result[-1], 1 << bit))
    for window, room in goals:
        while room:
            item, start, length = spare.pop()
            taken = min(room, length)
            window.append((item, start, taken))
            if taken < length:
                spare.append((item, start + taken, length - taken))
            room -= taken
    return result


def pack(docs: DataFrame, path: str, window: int = WINDOW, group: int = GROUP, end_id: int = END_ID) -> DataFrame:
    """One row per piece, columns ``PIECES``. ``path`` names a tokenizer file that every executor has."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        rests: list[tuple[int, int, bytes, int]] = []  # doc_id, start, ids, doc_tokens

        def flush() -> None:
            nonlocal sequence
            if not rests:
                return
            for pieces in levelled([len(r[2]) // 4 for r in rests], window):
                offset = 0
                for item, start, length in pieces:
                    doc_id, begin, ids, tokens = rests[item]
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, begin + start, length, crc, tokens, sequence, offset))
                    offset += length
                sequence += 1
            rests.clear()

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 7
            rows.clear()
            names = [part.split()[0] for part in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode(batch["text"])):
                ids += end
                tokens = len(ids) // 4
                whole = tokens - tokens % window
                for start in range(0, whole, window):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + window)])
                    rows.append((doc_id, start, window, crc, tokens, sequence, 0))
                    sequence += 1
                if whole < tokens:
                    rests.append((doc_id, whole, ids[4 * whole :], tokens))
                    if len(rests) == group:
                        flush()
            yield out()
        flush()
        yield out()

    return docs.select("doc_id", "text").mapInArrow(kernels.lean(work, keep=True), PIECES)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack(frames.table(spark, sf_dir, "documents"), vocabulary_path())
