"""What the two vector searches share: usable rows, pivots, blocks of vectors and of queries, merging.

Vectors are kept in *cells*: rows of at most ``CELL`` vectors of one pivot, sorted by their distance to it, as packed
arrays. Queries are kept in blocks in the same way. A search makes (query block, cell) pairs by an equi-join and scores each
pair in one call, so no row ever stands for a single pair of vectors.

A repeated row counts once. Vectors of another length than the most frequent one take no part, like null vectors and
vectors with null or non-finite components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillweave.llm import frames

CELL = 1024
QUERY_BLOCK = 512
# Pivots are fitted on about this many vectors, chosen by a hash of the id.
FIT_ROWS = 4096
PIVOTS = 64
# Packed rows are up to a megabyte, so few of them may go into one Arrow batch.
PACKED_ROWS = "8"
PACKED = "pivot int, dmin double, dmax double, n int, ids binary, dists binary, mat binary, extra binary"


def usable(df: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, vec array<double>) of the vectors that take part; all-zero ones only if ``zero``."""
    vec = F.col("embedding").cast("array<double>")
    df = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), vec.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
        & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    )
    if not zero:
        df = df.where(F.exists("vec", lambda x: x != 0))
    length = df.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return df.where(F.size("vec") == (length["n"] if length else 0))


def fit_sample(rows: DataFrame, size: int = FIT_ROWS) -> np.ndarray:
    """About ``size`` vectors, chosen by a hash of their id: bounded, whatever the table's size."""
    total = rows.count()
    picked = rows.where(frames.unit_hash(F.col("vec_id")) * max(total, 1) < size).select("vec").toPandas()
    return np.array([np.asarray(v, dtype=np.float64) for v in picked["vec"]])


def kmeans(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """At most ``k`` centres of a bounded sample."""
    points = np.unique(sample, axis=0)
    if len(points) <= k:
        return points
    centres = points[np.random.default_rng(seed).choice(len(points), k, replace=False)]
    for _ in range(rounds):
        nearest = squared(sample, centres).argmin(axis=1)
        for i in range(k):
            members = sample[nearest == i]
            if len(members):
                centres[i] = members.mean(axis=0)
    return centres


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of ``a`` to every row of ``b``."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T), 0.0)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def assign(rows: DataFrame, pivots: np.ndarray, change: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(pivot, dist, vec_id, vec) with ``vec`` changed by ``change``: the nearest pivot and the distance to it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vecs = change(matrix(batch["vec"]))
            away = squared(vecs, pivots)
            nearest = away.argmin(axis=1)
            dist = np.sqrt(((vecs - pivots[nearest]) ** 2).sum(axis=1))
            lists = pa.ListArray.from_arrays(np.arange(0, vecs.size + 1, vecs.shape[1], dtype=np.int32), vecs.ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nearest.astype(np.int32)), pa.array(dist), batch["vec_id"], lists],
                names=["pivot", "dist", "vec_id", "vec"])

    return rows.mapInArrow(work, "pivot int, dist double, vec_id bigint, vec array<double>")


def to_bytes(values: np.ndarray) -> bytes:
    """A matrix in the smallest type that holds it exactly, its type first."""
    for code in "hf":
        small = values.astype(code) if np.abs(values).max(initial=0.0) < 32768 else values
        if small.dtype == np.dtype(code) and (small == values).all():
            return code.encode() + small.tobytes()
    return b"d" + values.tobytes()


def from_bytes(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, dtype=chr(data[0]), offset=1).astype(np.float64).reshape(rows, -1)


def packed(rows: DataFrame, id_name: str, size: int, extra: bool = False, across: bool = False) -> DataFrame:
    """Rows (pivot, dist, vec_id, vec) packed to at most ``size`` of one pivot, sorted by distance, with a unique id.

    Rows are dealt out by ranges of (pivot, dist, vec_id), so a pivot that holds most of the vectors, or most of them at
    one distance, is split like any other. With ``across`` a pack goes on into the next pivots until it is full, and ``pivot``,
    ``dmin`` and ``dmax`` say nothing about it.
    """

    def pack(part: dict[str, np.ndarray], number: int) -> tuple:
        add = part["extra"].astype(np.float64).tobytes() if extra else b""
        return (number, int(part["pivot"][0]), float(part["dist"][0]), float(part["dist"][-1]), len(part["dist"]),
                part["vec_id"].tobytes(), part["dist"].tobytes(), to_bytes(part["vec"]), add)

    names = [id_name, "pivot", "dmin", "dmax", "n", "ids", "dists", "mat", "extra"]
    types = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), *[pa.binary()] * 4]
    columns = ["pivot", "dist", "vec_id"] + (["extra"] if extra else [])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, np.ndarray] = {}

        def cut(final: bool) -> Iterator[tuple]:
            nonlocal held, number
            while held and len(held["pivot"]):
                end = len(held["pivot"]) if across else int(np.searchsorted(held["pivot"], held["pivot"][0], side="right"))
                if end < size and end == len(held["pivot"]) and not final:
                    return
                end = min(end, size)
                yield pack({name: values[:end] for name, values in held.items()}, number)
                number += 1
                held = {name: values[end:] for name, values in held.items()}

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            new = {name: batch[name].to_numpy(zero_copy_only=False) for name in columns} | {"vec": matrix(batch["vec"])}
            held = {name: np.concatenate([held[name], new[name]]) for name in new} if held and len(held["pivot"]) else new
            if found := list(cut(False)):
                yield batch_of(found)
        if found := list(cut(True)):
            yield batch_of(found)

    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(partitions, "pivot", "dist", "vec_id").sortWithinPartitions("pivot", "dist", "vec_id")
    return dealt.mapInArrow(work, f"{id_name} bigint, {PACKED}")


def unpack(row: dict, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, dists, matrix, extra) of a packed row."""
    count = row["n"][number]
    return (np.frombuffer(row["ids"][number], dtype=np.int64), np.frombuffer(row["dists"][number]),
            from_bytes(row["mat"][number], count), np.frombuffer(row["extra"][number]))


def once(ids: np.ndarray, vecs: np.ndarray) -> np.ndarray:
    """Which rows are no repetition of the row before (rows are sorted by distance, then id)."""
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (vecs[1:] != vecs[:-1]).any(axis=1)
    return new


def one_each(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Places of one entry for each id, the one with its highest score."""
    order = np.lexsort((-scores, ids))
    first = np.ones(len(ids), dtype=bool)
    first[1:] = ids[order[1:]] != ids[order[:-1]]
    return order[first]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id, highest first."""
    if len(scores) > k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= limit)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def merged(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of each query over all that the pairs found."""
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return one.select("query_id", place.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
