"""Approximate nearest neighbours by adaptive dimension scan.

Vectors get one more dimension that makes all of them equally long, so that the largest inner product is the smallest
distance, and are turned by a random rotation. They are kept in inverted lists around ``LISTS`` centres, in cells that
hold the dimensions by column. A query probes its ``PROBES`` nearest lists. Within a cell, distances grow by blocks of
``STEP`` columns; after d of D columns a candidate is abandoned when the hypothesis that it is near enough can be rejected,
partial distance > limit * d / D * (1 + EPSILON / sqrt(d))^2. The limit is the distance of the k-th nearest in the query's own
cell and shrinks on the way. Whoever survives all columns is scored exactly on the original vectors.

Every row is indexed; centres and the rotation are fitted on a bounded sample (``vectors.FIT_ROWS``). Recall against brute
force is measured in the tests.

Defined results: queries without other vectors have no rows; ties go to the smaller vec_id; repeated rows count once; an
empty table gives no rows. Vectors null, zero, of odd length, or with null or non-finite components take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import frames, vectors

LISTS = 64
PROBES = 48
STEP = 8
EPSILON = 2.6


def rotation(size: int, seed: int = 5) -> np.ndarray:
    turned, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return turned


def lengthened(vecs: np.ndarray, longest: float) -> np.ndarray:
    """One more dimension that gives every vector the length ``longest``."""
    rest = np.sqrt(np.maximum(longest * longest - (vecs * vecs).sum(axis=1), 0.0))
    return np.column_stack([vecs, rest])


def survivors(columns: np.ndarray, query: np.ndarray, limit: float) -> np.ndarray:
    """Rows of a cell (dimensions by column) that no test along the dimensions rejects."""
    size = len(query)
    alive = np.arange(columns.shape[1])
    partial = np.zeros(len(alive))
    for first in range(0, size, STEP):
        end = min(first + STEP, size)
        block = columns[first:end] if len(alive) == columns.shape[1] else columns[first:end, alive]
        away = block - query[first:end, None]
        partial = partial + (away * away).sum(axis=0)
        bound = limit if end == size else limit * end / size * (1 + EPSILON / np.sqrt(end)) ** 2
        keep = partial <= bound * (1 + 1e-9) + 1e-12
        alive, partial = alive[keep], partial[keep]
        if not len(alive):
            break
    return alive


def ask(cells: DataFrame, every: int, k: int, longest: float, turned: np.ndarray, centres: np.ndarray) -> DataFrame:
    """(pivot, dist, vec_id, vec, extra): every query once for each list it probes, with the limit from its own cell.

    Cells hold the original vectors; lists are chosen on the turned ones.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.to_pydict()
            for number in range(batch.num_rows):
                ids, _, mat, _ = vectors.unpack(row, number)
                new = vectors.once(ids, mat)
                ids, mat = ids[new], mat[new]
                asked = np.flatnonzero(ids % every == 0)
                if not len(asked):
                    continue
                limits = np.empty(len(asked))
                for place, q in enumerate(asked):
                    others = ids != ids[q]
                    score = (mat * mat[q]).sum(axis=1)[others]
                    score = np.sort(score[vectors.one_each(ids[others], score)])
                    least = score[-k] if len(score) >= k else -np.inf
                    limits[place] = (mat[q] @ mat[q]) + longest * longest - 2.0 * least
                turned_queries = np.column_stack([mat[asked], np.zeros(len(asked))]) @ turned
                away = vectors.squared(turned_queries, centres)
                nearest = np.argsort(away, axis=1, kind="stable")[:, :PROBES]
                times = nearest.shape[1]
                part = np.repeat(mat[asked], times, axis=0)
                lists = pa.ListArray.from_arrays(np.arange(0, part.size + 1, part.shape[1], dtype=np.int32), part.ravel())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nearest.ravel().astype(np.int32)), pa.array(np.zeros(len(part))),
                     pa.array(np.repeat(ids[asked], times)), lists, pa.array(np.repeat(limits, times))],
                    names=["pivot", "dist", "vec_id", "vec", "extra"])

    return cells.mapInArrow(work, "pivot int, dist double, vec_id bigint, vec array<double>, extra double")


class Best:
    """The ``k`` best found so far for every query of a block, and the limits that follow from them."""

    def __init__(self, row: dict, number: int, k: int, longest: float, turned: np.ndarray):
        self.queries, _, self.asked, limits = vectors.unpack(row, number)
        self.limits, self.k = limits.copy(), k
        self.turned = np.column_stack([self.asked, np.zeros(len(self.asked))]) @ turned
        self.reach = (self.asked * self.asked).sum(axis=1) + longest * longest
        self.found = [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(self.queries)

    def visit(self, ids: np.ndarray, mat: np.ndarray, columns: np.ndarray) -> None:
        for q in range(len(self.queries)):
            alive = survivors(columns, self.turned[q], self.limits[q])
            alive = alive[ids[alive] != self.queries[q]]
            if len(alive):
                own = np.concatenate((self.found[q][0], ids[alive]))
                score = np.concatenate((self.found[q][1], (mat[alive] * self.asked[q]).sum(axis=1)))
                # A row can be repeated in several cells; its copies take one place.
                single = vectors.one_each(own, score)
                own, score = own[single], score[single]
                first = vectors.best(own, score, self.k)
                self.found[q] = own[first], score[first]
                if len(first) == self.k:
                    self.limits[q] = min(self.limits[q], self.reach[q] - 2.0 * score[first[-1]])

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.queries, [len(ids) for ids, _ in self.found])),
             pa.array(np.concatenate([ids for ids, _ in self.found])), pa.array(np.concatenate([s for _, s in self.found]))],
            names=["query_id", "vec_id", "score"])


def search(pairs: DataFrame, k: int, longest: float, turned: np.ndarray) -> DataFrame:
    """The ``k`` best survivors of each query, scored on the original vectors.

    Pairs of one query block that follow each other share their limits and give one set of rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, current = None, None
        for batch in batches:
            row = batch.to_pydict()
            block = {name[2:]: values for name, values in row.items() if name.startswith("q_")}
            for number in range(batch.num_rows):
                ids, _, mat, _ = vectors.unpack(row, number)
                new = vectors.once(ids, mat)
                ids, mat = ids[new], mat[new]
                if row["block"][number] != current:
                    if best:
                        yield best.rows()
                    best, current = Best(block, number, k, longest, turned), row["block"][number]
                best.visit(ids, mat, np.ascontiguousarray((lengthened(mat, longest) @ turned).T))
        if best:
            yield best.rows()

    return pairs.mapInArrow(work, "query_id bigint, vec_id bigint, score double")


def assigned_lists(rows: DataFrame, centres: np.ndarray, longest: float, turned: np.ndarray) -> DataFrame:
    """(pivot, dist, vec_id, vec): the list of each vector, chosen on the turned vector, with the original one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = vectors.squared(lengthened(vectors.matrix(batch["vec"]), longest) @ turned, centres)
            yield pa.RecordBatch.from_arrays(
                [pa.array(away.argmin(axis=1).astype(np.int32)), pa.array(np.sqrt(away.min(axis=1))), batch["vec_id"], batch["vec"]],
                names=["pivot", "dist", "vec_id", "vec"])

    return rows.select("vec_id", "vec").mapInArrow(work, "pivot int, dist double, vec_id bigint, vec array<double>")


def nearest(rows: DataFrame, every: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` largest inner products found for every ``every``-th vector."""
    spark = rows.sparkSession
    numbered = vectors.usable(rows, zero=False)
    norm = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    longest = float(np.sqrt(numbered.agg(F.max(norm)).first()[0] or 0.0))
    sample = vectors.fit_sample(numbered)
    sample = sample if len(sample) else np.zeros((1, 1))
    turned = rotation(sample.shape[1] + 1)
    centres = vectors.kmeans(lengthened(sample, longest) @ turned, LISTS)
    assigned = assigned_lists(numbered, centres, longest, turned)
    cells = frames.store(vectors.packed(assigned, "cell", vectors.CELL), "scan-cells")
    with frames.batch_rows(spark, vectors.PACKED_ROWS):
        asked = frames.store(ask(cells, every, k, longest, turned, centres), "scan-queries")
    blocks = frames.store(vectors.packed(asked, "block", vectors.QUERY_BLOCK, extra=True), "scan-blocks")
    with frames.batch_rows(spark, vectors.PACKED_ROWS):
        asking = blocks.select("block", "pivot", *[F.col(c).alias(f"q_{c}") for c in ("n", "ids", "dists", "mat", "extra")])
        pairs = asking.join(cells, "pivot").sortWithinPartitions("pivot", "block")
        found = frames.store(search(pairs, k, longest, turned), "scan-found")
    return vectors.merged(found, k)


def op7_dimension_scan(spark, sf_dir: str) -> DataFrame:
    return nearest(frames.table(spark, sf_dir, "embeddings"), 20, 20)
