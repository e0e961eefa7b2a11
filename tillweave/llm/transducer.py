"""Weighted acyclic automata over words: count transducers of phrases, built from sorted windows, united and composed.

A transducer maps a phrase to the number of windows that begin with it: the weight of the last arc on its path. It has one table of
states for each depth. A state is the list of its arcs (label, target state, weight), ascending by label, kept as bytes, and equal states
are one: ``build`` closes the states of sorted windows from the deepest level upwards and registers each in a dictionary of
bytes, so common suffixes are shared exactly, without hashes that could collide.

Labels are places in a sorted alphabet of words, from 1; 0 stands for the end of a shorter window. So the order of label rows is
the order of the phrases as tuples of UTF-8 words.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ARC = np.dtype([("label", "<i4"), ("target", "<i4"), ("weight", "<i8")])
CODEC = pa.Codec("zstd", compression_level=1)


def alphabet(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(label of each word, sorted distinct words)."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    label = np.empty(len(order), dtype=np.int64)
    label[order] = np.arange(1, len(order) + 1)
    return label[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))


def sort_rows(columns: list[np.ndarray]) -> np.ndarray:
    """Order of label rows, first column first; as many columns as fit are packed into one key."""
    most = max((int(c.max(initial=0)) for c in columns), default=0)
    bits = max(most.bit_length(), 1)
    each = max(63 // bits, 1)
    keys = []
    for first in range(0, len(columns), each):
        key = columns[first].astype(np.int64)
        for column in columns[first + 1 : first + each]:
            key = (key << bits) | column
        keys.append(key)
    return np.lexsort(keys[::-1])


def distinct(columns: list[np.ndarray], weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct label rows and their summed weights (1 each by default)."""
    if not len(columns[0]):
        return columns, np.zeros(0, dtype=np.int64)
    order = sort_rows(columns)
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    first = np.flatnonzero(new)
    if weights is None:
        return [c[first] for c in columns], np.diff(first, append=len(order))
    return [c[first] for c in columns], np.add.reduceat(weights[order], first)


def place(columns: list[np.ndarray], words: list[bytes], border: tuple[bytes, ...]) -> int:
    """Where in the sorted rows the first one not below ``border`` is; ``words`` is the alphabet."""
    low, high = 0, len(columns[0])
    for column, word in zip(columns, border):
        label = bisect_left(words, word) + 1
        left = low + int(np.searchsorted(column[low:high], label, side="left"))
        if label > len(words) or words[label - 1] != word:
            return left
        high = low + int(np.searchsorted(column[low:high], label, side="right"))
        low = left
    return low


def build(columns: list[np.ndarray], weights: np.ndarray, final: bool = False) -> list[tuple[np.ndarray, np.ndarray]]:
    """(offsets, arcs) of the states of each depth, from the root on, for sorted distinct label rows.

    An arc weighs what all rows that pass it weigh together or, if ``final``, what the row that ends with it weighs.
    """
    count = len(weights)
    shared = np.zeros(count, dtype=np.int8)  # leading labels a row has in common with the row before
    same = np.ones(count, dtype=bool)
    same[:1] = False
    for column in columns:
        same[1:] &= column[1:] == column[:-1]
        shared += same
    total = np.concatenate(([0], np.cumsum(weights)))
    levels: list[tuple[np.ndarray, np.ndarray]] = []
    targets = lower = None
    for depth in range(len(columns), -1, -1):
        if depth:
            opened = np.flatnonzero(shared < depth)
            ends = np.append(opened[1:], count)
            real = columns[depth - 1][opened] > 0
            rows, ends = opened[real], ends[real]
            arcs = np.zeros(len(rows), dtype=ARC)
            arcs["label"] = columns[depth - 1][rows]
            if final:
                goes_on = columns[depth][rows] > 0 if depth < len(columns) else np.zeros(len(rows), dtype=bool)
                arcs["weight"] = np.where(goes_on, 0, weights[rows])
            else:
                arcs["weight"] = total[ends] - total[rows]
        else:
            rows, arcs = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=ARC)
        if lower is not None:  # close the states that the arcs of this depth lead to
            below, under = lower
            offsets = np.append(np.searchsorted(below, rows), len(below)).astype(np.int64) * ARC.itemsize
            states = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(under.tobytes())]).dictionary_encode()
            targets = states.indices.to_numpy()
            levels.append(table(states.dictionary))
            if depth:
                arcs["target"] = targets
        lower = rows, arcs
    return levels[::-1]


def table(states: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, arcs) of registered states."""
    _, offsets, data = states.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[states.offset : states.offset + len(states) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return (offsets - offsets[0]) // ARC.itemsize, data[offsets[0] : offsets[-1]].view(ARC)


def used(columns: list[np.ndarray], words: pa.Array) -> tuple[list[np.ndarray], pa.Array]:
    """The same rows over the alphabet of the words that they use."""
    labels = np.unique(np.concatenate(columns))
    labels = labels[labels > 0]
    fresh = np.zeros(len(words) + 1, dtype=np.int64)
    fresh[labels] = np.arange(1, len(labels) + 1)
    return [fresh[c] for c in columns], words.take(pa.array(labels - 1))


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes: lowest bytes first, the highest bytes are mostly zero."""
    values = np.ascontiguousarray(values)
    return CODEC.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes(), asbytes=True)


def spread(blob: bytes, count: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(CODEC.decompress(blob, count * width, asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(width, count).T).view(kind).reshape(count)


def pack(levels: list[tuple[np.ndarray, np.ndarray]], words: pa.Array) -> list[bytes]:
    """A transducer as compressed pieces: the alphabet, then five for each depth.

    States are numbered as they first occur, so a target is kept as its distance from the next new number, 0 for a new state.
    """
    batch = pa.RecordBatch.from_pydict({"word": words.cast(pa.large_binary())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    blob = [sink.getvalue().to_pybytes()]
    for offsets, arcs in levels:
        target = arcs["target"].astype(np.int64)
        top = np.maximum.accumulate(np.concatenate(([-1], target)))[:-1] if len(target) else target
        blob.append(np.array([len(offsets) - 1, len(arcs)], dtype="<i8").tobytes())
        blob += [squeezed(np.diff(offsets).astype("<i4")), squeezed(arcs["label"]), squeezed((top + 1 - target).astype("<i4")),
                 squeezed(arcs["weight"])]
    return blob


def unpack_words(blob: list[bytes]) -> pa.Array:
    return pa.ipc.open_stream(blob[0]).read_all()["word"].combine_chunks()


def unpack_level(blob: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, arcs) of one depth, so that a union holds one depth of one transducer at a time."""
    sizes, states, label, back, weight = blob[1 + 5 * depth : 6 + 5 * depth]
    count, total = np.frombuffer(sizes, dtype="<i8").tolist()
    arcs = np.empty(total, dtype=ARC)
    arcs["label"], arcs["weight"] = spread(label, total, "<i4"), spread(weight, total, "<i8")
    distance = spread(back, total, "<i4")
    arcs["target"] = np.cumsum(distance == 0) - (distance == 0) - distance
    return np.concatenate(([0], np.cumsum(spread(states, count, "<i4")))).astype(np.int64), arcs


def leaving(offsets: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``states``, arc) for every arc that leaves the given states."""
    counts = offsets[states + 1] - offsets[states]
    owner = np.repeat(np.arange(len(states)), counts)
    start = np.repeat(offsets[states] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return owner, start + np.arange(len(owner))


def union(blobs: list[list[bytes]], least: int, borders: list[tuple[bytes, ...]]):
    """Sum transducers: (phrase labels from the root, weight, open) by depth, and the common alphabet.

    Only phrases of at least ``least`` windows are followed, as no longer phrase has more; those that are the beginning of one of the
    ``borders`` are followed always and marked open, since windows beyond the border may begin with them too.
    """
    own = [unpack_words(blob) for blob in blobs]
    labels, words = alphabet(pa.concat_arrays(own))
    start = np.concatenate(([0], np.cumsum([len(part) for part in own])))
    names = words.to_pylist()
    at = lambda word: (lambda i: i + 1 if i < len(names) and names[i] == word else -1)(bisect_left(names, word))
    marks = [[at(word) for word in border] for border in borders]
    part = np.arange(len(blobs))  # of each followed state: its transducer, its number there, the united state that it belongs to
    state = np.zeros(len(blobs), dtype=np.int64)
    node = np.zeros(len(blobs), dtype=np.int64)
    paths = np.zeros((1, 0), dtype=np.int64)
    on_border = np.ones((1, len(marks)), dtype=bool)
    found = []
    for depth in range((len(blobs[0]) - 1) // 5):
        leaving_arcs, owners = [], []
        first = np.searchsorted(part, np.arange(len(blobs) + 1))
        for number, blob in enumerate(blobs):
            mine = slice(first[number], first[number + 1])
            if first[number + 1] > first[number]:
                offsets, arcs = unpack_level(blob, depth)
                owner, arc = leaving(offsets, state[mine])
                leaving_arcs.append(arcs[arc])
                owners.append(owner + first[number])
        arcs = np.concatenate(leaving_arcs) if owners else np.zeros(0, dtype=ARC)
        owner = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
        part = part[owner]
        label = labels[start[part] + arcs["label"] - 1]
        order = sort_rows([node[owner], label])
        parent, label, part, arcs = node[owner][order], label[order], part[order], arcs[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (parent[1:] != parent[:-1]) | (label[1:] != label[:-1])
        first = np.flatnonzero(new)
        weight = np.add.reduceat(arcs["weight"], first) if len(first) else np.zeros(0, dtype=np.int64)
        on = np.zeros((len(first), len(marks)), dtype=bool)
        for i, mark in enumerate(marks):
            if depth < len(mark):
                on[:, i] = on_border[parent[first], i] & (label[first] == mark[depth])
        keep = (weight >= least) | on.any(axis=1)
        paths = np.column_stack([paths[parent[first][keep]], label[first][keep]])
        found.append((paths, weight[keep], on[keep].any(axis=1)))
        fresh = np.where(keep, np.cumsum(keep) - 1, -1)[np.cumsum(new) - 1]
        followed = fresh >= 0
        back = np.flatnonzero(followed)[np.argsort(part[followed], kind="stable")]
        part, node, state = part[back], fresh[back], arcs["target"][back].astype(np.int64)
        on_border = on[keep]
    return found, words


def compose(asked: list[np.ndarray], levels: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weight of each phrase, a row of labels ended by zeros, in the transducer; 0 if it has no path.

    Acceptor and transducer are walked in step: at each depth the arcs with equal labels of the paired states lead on.
    """
    weights = np.zeros(len(asked[0]), dtype=np.int64)
    state = np.zeros(len(weights), dtype=np.int64)
    alive = np.ones(len(weights), dtype=bool)
    for (offsets, arcs), label in zip(levels, asked):
        going = np.flatnonzero(alive & (label > 0))
        alive[:] = False
        if not len(going):
            break
        origin = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        width = int(max(arcs["label"].max(initial=0), label.max())) + 1
        keys = origin * width + arcs["label"]  # ascending, since states and their arcs are
        wanted = state[going] * width + label[going]
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        hit = keys[at] == wanted if len(keys) else np.zeros(len(going), dtype=bool)
        weights[going] = np.where(hit, arcs["weight"][at], 0) if len(keys) else 0
        state[going[hit]] = arcs["target"][at[hit]]
        alive[going[hit]] = True
    return weights
