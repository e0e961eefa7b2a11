"""Removal of repeated passages: every byte covered by a ``LENGTH``-byte string that also starts in a document with a smaller id.

Anchors find where to look. Among the grams of ``GRAM`` bytes that lie in a ``LENGTH``-byte window, the one with the smallest hash
is the window's anchor; equal windows have equal anchors, so they meet under the anchor's hash. The windows of one anchor are a
*fragment*: a stretch of the text of less than 2 * LENGTH bytes. Under each anchor

* fragments of equal bytes need no comparison: all but those of the smallest document are repeated as a whole;
* equal windows have equal bytes around the anchor, at least ``SIDE`` of them to its left or to its right; a fragment with no such
  neighbour in a fragment of another document has nothing to compare;
* the other fragments are joined to one text, its suffix array is built by linear grouping (``suffixes``), and neighbouring
  suffixes with ``LENGTH`` bytes in common are the repeated windows; the smallest document among them keeps its own.

Hashes only bring fragments together (48 bits for the anchor, 8 for each side, 64 more for equal bytes); a collision costs a comparison,
and only one of all bits would take different fragments for equal. Copies within one Arrow batch are settled
before the shuffle, so a passage that very many documents share sends one row per batch. Anchors with more than ``MOST``
different fragments are not sorted in one task: their windows are spread by a 128-bit hash of their bytes and counted there.

Defined results: a null or empty text has nothing to remove; strings are judged on the input. Repeated rows of a document are the same
document. Rows of one doc_id with different texts are different documents with equal ids, so neither is smaller. A row without a doc_id is
neither smaller nor larger than any: nothing is removed from it or because of it. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.llm import frames, kernels, suffixes

LENGTH = 50
GRAM = 20
# A window has more than twice SIDE - 1 bytes besides its anchor, so SIDE of them lie on one side of it.
SIDE = (LENGTH - GRAM + 1) // 2
# Bytes of texts that are cut into fragments together.
TOGETHER = 1 << 17
# Rows of fragments looked at together.
GATHERED = 16_000
# Different fragments under one anchor that one task sorts.
MOST = 96
# Symbols that are sorted side by side.
SORTED_AT_ONCE = 1 << 20
# Symbols from which on an anchor's string is sorted with other long ones.
LONG_LANE = 1 << 10
U = np.uint64
_SETTLED = 1 << 62
ROW = "g bigint, f bigint, doc bigint, at bigint"
NAMES = ["g", "f", "doc", "at"]


def tag() -> Column:
    """16 bits of the text: tells apart different texts that share a doc_id."""
    return F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).bitwiseAND(0xFFFF)


def table(*columns: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def fragments_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor and sides, fragment hash, number of the text, start in it, number of windows) of the texts between ``bounds``.

    The first is a 48-bit hash of the anchor, then 8 bits each of the ``SIDE`` bytes to its left and right; 0 where the fragment has fewer.
    """
    total = kernels.running(data)
    grams = kernels.gram_hashes(data, GRAM, total)
    places = kernels.anchors(grams, LENGTH - GRAM + 1)
    first = np.zeros(len(places), dtype=bool)  # windows with another anchor than the one before
    first[1:] = places[1:] != places[:-1]
    first[:1] = True
    inside = np.ones(len(places) + 1, dtype=bool)  # windows that reach into no other text, and the end
    inside[-1] = False
    for low in bounds[1:-1]:
        inside[max(low - LENGTH + 1, 0) : low] = False
    first[bounds[:-1][bounds[:-1] < len(places)]] = True
    start = np.flatnonzero(first & inside[:-1])
    # A fragment ends where the next begins, or at the first window behind that reaches into another text.
    stops = np.flatnonzero((np.append(first, True) | ~inside)[1:]) + 1
    windows = stops[np.searchsorted(stops, start, side="right")] - start
    anchor, end = places[start], start + windows + LENGTH - 1
    number = np.searchsorted(bounds, start, side="right") - 1

    def side(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        there = (low >= start) & (high <= end)
        hashes = kernels.spans(data, np.where(there, low, 0), np.where(there, high, 0), total)
        return np.where(there, (hashes >> U(56)) % U(255) + U(1), U(0))

    sides = (side(anchor - SIDE, anchor) << U(8)) | side(anchor + GRAM, anchor + GRAM + SIDE)
    return (grams[anchor] & ~U(0xFFFF)) | sides, kernels.spans(data, start, end, total), number, start - bounds[number], windows


def met(g: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which of the fragments, in the order of their ``g``, agree on one side of their anchor with a fragment of another document."""

    def several(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
        first = np.ones(len(key), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        begins = np.flatnonzero(first)
        return (np.minimum.reduceat(doc, begins) != np.maximum.reduceat(doc, begins))[np.cumsum(first) - 1]

    if not len(g):
        return np.zeros(0, dtype=bool)
    left = several(g >> 8, doc) & ((g & 0xFF00) != 0)
    right = (g & ~0xFF00)
    order = np.argsort(right, kind="stable")
    found = np.empty(len(g), dtype=bool)
    found[order] = several(right[order], doc[order])
    return left | (found & ((g & 0xFF) != 0))


def gathered(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[list[np.ndarray]]:
    """The columns of ``NAMES`` of so many batches that they have ``at_once`` rows."""
    some, rows = [], 0
    for batch in batches:
        some.append([batch[name].to_numpy(zero_copy_only=False) for name in NAMES])
        rows += batch.num_rows
        if rows >= at_once:
            yield [np.concatenate(column) for column in zip(*some)]
            some, rows = [], 0
    if rows:
        yield [np.concatenate(column) for column in zip(*some)]


def merge(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite overlapping or touching spans of each document."""
    order = np.lexsort((low, doc))
    doc, low, high = doc[order], low[order], high[order]
    if not len(doc):
        return doc, low, high
    first = np.ones(len(doc), dtype=bool)
    first[1:] = doc[1:] != doc[:-1]
    lift = np.cumsum(first) * (int(high.max()) + 2)  # keeps the documents apart on one line
    reach = np.maximum.accumulate(high + lift)
    first[1:] |= (low + lift)[1:] > reach[:-1]
    begins = np.flatnonzero(first)
    ends = np.append(begins[1:], len(doc)) - 1
    return doc[begins], low[begins], (reach - lift)[ends]


def anchored(docs: DataFrame) -> DataFrame:
    """Rows (g, f, doc, at): ``at`` packs tag, start and number of windows of a fragment.

    Copies settled within the batch come as rows with a flag in ``at``, a span in ``f`` and a ``g`` that spreads them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.utf8(batch["text"])
            ids = batch["doc"].to_numpy(zero_copy_only=False)
            tags = batch["tag"].to_numpy(zero_copy_only=False).astype(np.int64)
            parts = []
            for low, high in kernels.runs(offsets, TOGETHER):
                part, bounds = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                if len(part) >= LENGTH:
                    g, f, number, start, windows = fragments_of(part, bounds)
                    parts.append((g.view(np.int64), f.view(np.int64), number + low, (start << 8) | windows))
            if not parts:
                continue
            g, f, number, at = (np.concatenate(column) for column in zip(*parts))
            # Equal fragments side by side; should others come between them, they are settled behind the shuffle. Rows go out in the
            # order of the texts, whose ids then repeat from row to row and compress.
            order = np.argsort(g ^ f)
            first = np.ones(len(g), dtype=bool)
            first[1:] = (g[order[1:]] != g[order[:-1]]) | (f[order[1:]] != f[order[:-1]])
            doc = ids[number]
            least = np.empty_like(doc)
            least[order] = np.minimum.reduceat(doc[order], np.flatnonzero(first))[np.cumsum(first) - 1]
            copy = doc > least
            keep = ~copy
            tagged = at | (tags[number] << 44)
            yield table(g[keep], f[keep], doc[keep], tagged[keep], names=NAMES)
            if copy.any():
                start, windows = at[copy] >> 8, at[copy] & 0xFF
                who, low, high = merge(number[copy], start, start + windows + LENGTH - 1)
                spread = kernels.mix(ids[who].view(U) ^ (low.astype(U) << U(20))).view(np.int64)
                yield table(spread, (low << 32) | high, ids[who], (tags[who] << 44) | _SETTLED, names=NAMES)

    source = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)).select(F.col("doc_id").alias("doc"), tag().alias("tag"), "text")
    return source.mapInArrow(kernels.lean(work), ROW)


def settled(rows: DataFrame, at_once: int = GATHERED) -> DataFrame:
    """(g, f, doc, at, low, high) from sorted rows: ``g`` null and a span for what is repeated as a whole, else a fragment to compare.

    Rows come sorted by (g, f, doc), so only the fragments of the smallest document under the current anchor are held. An anchor whose rows
    are not all there at once has all its different fragments compared.
    """
    names = [*NAMES, "low", "high"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=np.int64)] * 4
        compared = False  # whether the held rows, of the anchor that was last, have been given out
        for new in gathered(batches, at_once):
            old = len(held[0])
            g, f, doc, at = (np.concatenate([a, b]) for a, b in zip(held, new))
            flagged = (at & _SETTLED) != 0
            if flagged.any():
                yield out(doc[flagged], at[flagged] & ~_SETTLED, f[flagged] >> 32, f[flagged] & 0xFFFFFFFF)
                plain = ~flagged
                g, f, doc, at = g[plain], f[plain], doc[plain], at[plain]
            if not len(g):
                held, compared = [np.zeros(0, dtype=np.int64)] * 4, False
                continue
            new_g = np.ones(len(g), dtype=bool)
            new_g[1:] = (g[1:] >> 16) != (g[:-1] >> 16)
            new_f = new_g.copy()
            new_f[1:] |= (g[1:] != g[:-1]) | (f[1:] != f[:-1])
            segment = np.cumsum(new_g) - 1
            several = np.bincount(segment, weights=new_f) > 1
            several[0] |= compared and old > 0
            fragment = np.cumsum(new_f) - 1
            begins = np.flatnonzero(new_f)
            whole = doc > doc[begins][fragment]
            if whole.any():
                start = (at[whole] >> 8) & 0xFFFFFFFF
                yield out(doc[whole], at[whole], start, start + (at[whole] & 0xFF) + LENGTH - 1)
            near = several[segment[begins]]
            near[near] = met(g[begins[near]], doc[begins[near]])
            near |= several[segment[begins]] & (segment[begins] == segment[-1])
            if compared and old:
                near |= segment[begins] == 0
            compare = ~whole & near[fragment]
            if compared:
                compare[:old] = False
            if compare.any():
                none = pa.nulls(int(compare.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[compare]) for c in (g, f, doc, at)] + [none, none], names=names)
            last = (segment == segment[-1]) & ~whole
            compared = bool(several[-1])
            if compared:  # one row is enough to go on from
                last &= np.cumsum(new_f) == new_f.sum()
                last[: np.flatnonzero(last)[-1]] = False
            held = [c[last] for c in (g, f, doc, at)]

    def out(doc, at, low, high) -> pa.RecordBatch:
        none = pa.nulls(len(doc), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, *(pa.array(c) for c in (doc, at, low, high))], names=names)

    dealt = rows.repartition(F.shiftright("g", 16)).sortWithinPartitions("g", "f", "doc")
    return dealt.mapInArrow(kernels.lean(work), f"{ROW}, low bigint, high bigint")


def with_bytes(compare: DataFrame, docs: DataFrame) -> DataFrame:
    """(g, f, doc, at, bytes): the fragments to compare with their bytes."""
    asked = compare.groupBy("doc", F.shiftright("at", 44).alias("tag")).agg(F.collect_list(F.struct("g", "f", "at")).alias("asked"))
    texts = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)).select(F.col("doc_id").alias("doc"), tag().alias("tag"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.utf8(batch["text"])
            asked = batch["asked"]
            row = np.repeat(np.arange(len(asked)), np.diff(asked.offsets.to_numpy()))
            flat = asked.flatten()
            g, f, at = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            low = offsets[row] + ((at >> 8) & 0xFFFFFFFF)
            size = (at & 0xFF) + LENGTH - 1
            ends = np.cumsum(size)
            taken = data[np.repeat(low, size) + suffixes.ramp(size)]
            blobs = pa.Array.from_buffers(
                pa.binary(), len(size),
                [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(taken)])
            doc = batch["doc"].to_numpy(zero_copy_only=False)[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (g, f, doc, at)] + [blobs], names=[*NAMES, "bytes"])

    joined = texts.join(asked, ["doc", "tag"])
    return joined.select("doc", "text", "asked").mapInArrow(kernels.lean(work), f"{ROW}, bytes binary")


def repeated_windows(texts: list[bytes], owner: np.ndarray, docs: np.ndarray) -> list[np.ndarray]:
    """For each fragment which of its windows also lie in a fragment of a smaller document of the same owner (anchor).

    ``owner`` is ascending; the fragments of one owner make one string for the suffix array, with a separator behind each.
    """
    sizes = np.array([len(t) for t in texts])
    lane_first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    lane = np.cumsum(np.concatenate(([False], owner[1:] != owner[:-1])))
    # Each fragment is followed by a separator, each lane's last one by the end mark instead.
    places = np.concatenate(([0], np.cumsum(sizes + 1)))
    symbols = np.ones(places[-1], dtype=np.int64)
    body = np.repeat(places[:-1], sizes) + suffixes.ramp(sizes)
    symbols[body] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int64) + 2
    lane_bounds = np.append(places[:-1][lane_first], places[-1])
    symbols[lane_bounds[1:] - 1] = 0
    order = suffixes.suffix_orders(symbols, lane_bounds)
    fragment = np.repeat(np.arange(len(texts)), sizes + 1)
    inside = np.arange(len(symbols)) - places[:-1][fragment]
    valid = inside <= sizes[fragment] - LENGTH
    order = order[valid[order]]
    views = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.uint16), LENGTH)
    same = np.zeros(len(order), dtype=bool)
    same[1:] = lane[fragment[order[1:]]] == lane[fragment[order[:-1]]]
    near = np.flatnonzero(same)
    for first in range(0, len(near), 100_000):
        part = near[first : first + 100_000]
        same[part] = (views[order[part]] == views[order[part - 1]]).all(axis=1)
    begins = np.flatnonzero(~same)
    holder = docs[fragment[order]]
    least = np.minimum.reduceat(holder, begins)[np.cumsum(~same) - 1] if len(order) else holder
    repeated = np.zeros(len(symbols), dtype=bool)
    repeated[order[holder > least]] = True
    return [repeated[places[i] : places[i] + sizes[i] - LENGTH + 1] for i in range(len(texts))]


class Pool:
    """Different fragments that wait to be sorted; ``rows`` has the places of all equal ones of a document."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.texts: list[bytes] = []
        self.owner: list[int] = []
        self.docs: list[int] = []
        self.rows: list[list[int]] = []
        self.symbols = 0

    def add(self, text: bytes, doc: int, at: int) -> None:
        self.texts.append(text)
        self.docs.append(doc)
        self.rows.append([at])
        self.symbols += len(text) + 1

    def take(self, lane: Pool, owner: int) -> None:
        """Add the fragments of one anchor, which holds none afterwards."""
        self.owner += [owner] * len(lane.texts)
        self.texts += lane.texts
        self.docs += lane.docs
        self.rows += lane.rows
        self.symbols += lane.symbols
        lane.clear()


def compared(fragments: DataFrame) -> DataFrame:
    """(doc, at, low, high, w1, w2): spans found by suffix arrays, and the windows of anchors with too many fragments.

    Sorting takes as many steps as the longest string of a call has symbols, so long strings wait for each other in a pool of their own.
    """
    names = ["doc", "at", "low", "high", "w1", "w2"]
    types = [pa.int64()] * 6

    def spans(pool: Pool) -> Iterator[pa.RecordBatch]:
        out = []
        if pool.texts:
            flags = repeated_windows(pool.texts, np.array(pool.owner), np.array(pool.docs))
            for doc, places, flag in zip(pool.docs, pool.rows, flags):
                if flag.any():
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], flag.view(np.int8), [0]))))
                    for at in places:
                        start = (at >> 8) & 0xFFFFFFFF
                        out += [(doc, at, start + a, start + b + LENGTH - 1, None, None) for a, b in edge.reshape(-1, 2).tolist()]
        pool.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def windows(text: bytes, doc: int, places: list[int]) -> pa.RecordBatch:
        data = np.frombuffer(text, dtype=np.uint8)
        begin = np.arange(len(data) - LENGTH + 1)
        first = kernels.spans(data, begin, begin + LENGTH).view(np.int64)
        second = kernels.spans(data ^ 0x5A, begin, begin + LENGTH).view(np.int64)
        start = (np.array(places) >> 8) & 0xFFFFFFFF
        low = (start[:, None] + begin[None, :]).ravel()
        times = len(places)
        return table(np.full(len(low), doc), np.repeat(np.array(places), len(begin)), low, low + LENGTH,
                     np.tile(first, times), np.tile(second, times), names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long, lane = Pool(), Pool(), Pool()  # ``lane`` holds the different fragments of the current anchor
        number_of_lanes, last = 0, (None, None)
        spread: int | None = None  # the anchor whose windows are being spread
        for batch in batches:
            g_of, f_of, doc_of, at_of = (batch[name].to_pylist() for name in NAMES)
            g_of = [g >> 16 for g in g_of]
            bytes_of = batch["bytes"]
            for number in range(batch.num_rows):
                g, f = g_of[number], f_of[number]
                if g == spread:
                    yield windows(bytes_of[number].as_py(), doc_of[number], [at_of[number]])
                    continue
                if (g, f) == last:
                    lane.rows[-1].append(at_of[number])
                    continue
                if g != last[0]:
                    pool = long if lane.symbols > LONG_LANE else short
                    pool.take(lane, number_of_lanes)
                    number_of_lanes += 1
                    spread = None
                    if pool.symbols >= SORTED_AT_ONCE:
                        yield from spans(pool)
                last = (g, f)
                lane.add(bytes_of[number].as_py(), doc_of[number], at_of[number])
                if len(lane.texts) > MOST:
                    for text, doc, places in zip(lane.texts, lane.docs, lane.rows):
                        yield windows(text, doc, places)
                    lane.clear()
                    spread, last = g, (None, None)
        (long if lane.symbols > LONG_LANE else short).take(lane, number_of_lanes)
        yield from spans(short)
        yield from spans(long)

    dealt = fragments.repartition(F.shiftright("g", 16)).sortWithinPartitions("g", "f", "doc", "at")
    return dealt.mapInArrow(kernels.lean(work), ", ".join(f"{name} bigint" for name in names))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, spans): for each document with repeated passages the spans, not yet united."""
    found = frames.store(settled(anchored(docs)), "passages-anchors")
    fragments = with_bytes(found.where(F.col("g").isNotNull()).select(*NAMES), docs)
    sorted_out = frames.store(compared(fragments), "passages-compared")
    windows = sorted_out.where(F.col("w1").isNotNull())
    least = windows.groupBy("w1", "w2").agg(F.min("doc").alias("least"))
    spread = windows.join(least, ["w1", "w2"]).where(F.col("doc") > F.col("least"))
    columns = ["doc", "at", "low", "high"]
    spans = (
        found.where(F.col("g").isNull()).select(*columns)
        .unionByName(sorted_out.where(F.col("w1").isNull()).select(*columns)).unionByName(spread.select(*columns))
    )
    grouped = spans.groupBy(F.col("doc").alias("doc_id"), F.shiftright("at", 44).alias("tag"))
    return frames.store(grouped.agg(F.collect_list(F.struct("low", "high")).alias("spans")), "passages-spans")


def without_repeats(docs: DataFrame, keep: list[str], text: bool = False) -> DataFrame:
    """``keep`` columns, n_bytes, n_removed, n_spans, kept_sha256, and with ``text`` what is left.

    What is left of a character that was cut is dropped from the text, not from the digest.
    """
    keep = [name for name in keep if name != "text"]
    fields = ", ".join(f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in keep)
    schema = f"{fields}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", text string" if text else "")
    spans = repeated_spans(docs).withColumnsRenamed({"tag": "span_tag", "spans": "span_list", "doc_id": "span_doc"})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.utf8(batch["text"])
            lists = batch["span_list"]
            sizes, removed, counts, digests, left = [], [], [], [], []
            for number in range(batch.num_rows):
                body = data[offsets[number] : offsets[number + 1]]
                found = lists[number]
                gone = spans_gone = 0
                if found.is_valid and len(found.values):
                    low, high = (found.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                    _, low, high = merge(np.zeros(len(low), dtype=np.int64), low, high)
                    mask = np.zeros(len(body) + 1, dtype=np.int64)
                    mask[low] += 1
                    mask[high] -= 1
                    gone, spans_gone = int((high - low).sum()), len(low)
                    body = body[np.cumsum(mask[:-1]) == 0]
                rest = body.tobytes()
                sizes.append(int(offsets[number + 1] - offsets[number]))
                removed.append(gone)
                counts.append(spans_gone)
                digests.append(hashlib.sha256(rest).hexdigest())
                if text:
                    left.append(rest.decode("utf-8", "ignore"))
            columns = [*[batch[name] for name in keep], *[pa.array(c, pa.int64()) for c in (sizes, removed, counts)],
                       pa.array(digests, pa.string()), *([pa.array(left, pa.string())] if text else [])]
            yield pa.RecordBatch.from_arrays(
                columns, names=[*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["text"] if text else [])])

    marked = docs.select(*keep, "text", tag().alias("own_tag")).join(
        spans, (F.col("doc_id") == F.col("span_doc")) & (F.col("own_tag") == F.col("span_tag")), "left")
    return marked.select(*keep, "text", "span_list").mapInArrow(kernels.lean(work), schema)


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return without_repeats(frames.table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
