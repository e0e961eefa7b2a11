"""Exact top-k search by integer inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it, and stored in cells sorted by that key. A query first
searches the cell it lies in; the k-th score found there gives the radius within which anything better must lie, because
2 * score = |q|^2 + |x|^2 - d(q, x)^2, and by the triangle inequality |d(q, p) - d(x, p)| <= d(q, x) that radius reaches an annulus around each
pivot. Queries that follow each other by pivot and distance share a block. A block visits the cells its annuli reach, nearest first; the
running k-th best of every query shrinks its radius, and the block stops at the first cell that is farther than the widest radius left. Blocks
with very many cells are visited in several slices, each in its own order, so no task is longer than ``VISITS`` cells for a block.

Pivots are centres of a bounded sample (``vectors.FIT_ROWS``); they only decide how much is skipped, never the result.

Defined results: a query without other vectors has no rows; ties go to the smaller vec_id; repeated rows count once; a vec_id with
several vectors counts once, with the best score of any of them, as a candidate and as a query; an empty table gives no rows. Vectors null, of odd length, or with null or non-finite components take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import frames, vectors

SCALE = 256.0
FOUND = "query_id bigint, vec_id bigint, score double"
# Cells that one slice of a block visits, about.
VISITS = 256


def whole_numbers(vecs: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vecs)


def scores(cell: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while every sum fits 53 bits, otherwise in 64-bit integers."""
    most = max(np.abs(cell).max(initial=0.0), np.abs(query).max(initial=0.0))
    if most * most * max(cell.shape[1], 1) < 2.0**53:
        return cell @ query
    return (cell.astype(np.int64) @ query.astype(np.int64)).astype(np.float64)


def seeds(cells: DataFrame, every: int, k: int) -> DataFrame:
    """Query rows (pivot, dist, vec_id, vec, extra): ``extra`` is the k-th score within the query's own cell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.to_pydict()
            for number in range(batch.num_rows):
                ids, dists, mat, _ = vectors.unpack(row, number)
                new = vectors.once(ids, mat)
                ids, dists, mat = ids[new], dists[new], mat[new]
                asked = np.flatnonzero(ids % every == 0)
                limits = []
                for q in asked:
                    found = scores(mat, mat[q])
                    others = np.flatnonzero(ids != ids[q])
                    others = np.sort(found[others][vectors.one_each(ids[others], found[others])])
                    limits.append(others[-k] if len(others) >= k else -np.inf)
                if len(asked):
                    part = mat[asked]
                    lists = pa.ListArray.from_arrays(
                        np.arange(0, part.size + 1, part.shape[1], dtype=np.int32), part.ravel())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(asked), row["pivot"][number], np.int32)), pa.array(dists[asked]),
                         pa.array(ids[asked]), lists, pa.array(limits, pa.float64())],
                        names=["pivot", "dist", "vec_id", "vec", "extra"])

    return cells.mapInArrow(work, "pivot int, dist double, vec_id bigint, vec array<double>, extra double")


def reach(blocks: DataFrame, pivots: np.ndarray, longest: float) -> DataFrame:
    """(block, pivot, low, high, near, far): the annulus around each pivot that some query of a block has to search, and the least
    and greatest distance of its queries to the pivot."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = batch.to_pydict(), []
            for number in range(batch.num_rows):
                _, _, mat, limit = vectors.unpack(row, number)
                radius = radii(mat, limit, longest)
                away = np.sqrt(vectors.squared(mat, pivots))
                edges = ((away - radius[:, None]).min(axis=0), (away + radius[:, None]).max(axis=0), away.min(axis=0), away.max(axis=0))
                out += [(row["block"][number], p, *(float(edge[p]) for edge in edges)) for p in range(len(pivots))]
            if out:
                types = [pa.int64(), pa.int32(), *[pa.float64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)], names=["block", "pivot", "low", "high", "near", "far"])

    return blocks.mapInArrow(work, "block bigint, pivot int, low double, high double, near double, far double")


def radii(queries: np.ndarray, limit: np.ndarray, longest: float) -> np.ndarray:
    """How far from each query a vector with at least the limiting score can be, with room for rounding."""
    inside = np.maximum((queries * queries).sum(axis=1) + longest * longest - 2.0 * limit, 0.0)
    return np.sqrt(inside) * (1 + 1e-9) + 1e-6 * (1 + longest)


class Bests:
    """The ``k`` best found so far for every query of a block, and the radius that follows from the worst of them."""

    def __init__(self, row: dict, number: int, k: int, longest: float):
        self.queries, _, self.asked, limit = vectors.unpack(row, number)
        self.limit, self.k, self.longest = limit.copy(), k, longest
        self.found = [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(self.queries)
        self.radius = radii(self.asked, self.limit, longest)

    def done(self, gap: float) -> bool:
        """Whether nothing at a distance of ``gap`` or more can be among the best of any query."""
        return gap * (1 - 1e-9) > self.radius.max()

    def visit(self, row: dict, number: int, pivot: np.ndarray) -> None:
        ids, dists, mat, _ = vectors.unpack(row, number)
        away = np.sqrt(((self.asked - pivot) ** 2).sum(axis=1))
        first = np.searchsorted(dists, away - self.radius, side="left")
        end = np.searchsorted(dists, away + self.radius, side="right")
        new = vectors.once(ids, mat)
        changed = False
        for q in np.flatnonzero(first < end):
            part = slice(first[q], end[q])
            found = scores(mat[part], self.asked[q])
            good = np.flatnonzero((found >= self.limit[q]) & new[part] & (ids[part] != self.queries[q]))
            if not len(good):
                continue
            own = np.concatenate((self.found[q][0], ids[part][good]))
            score = np.concatenate((self.found[q][1], found[good]))
            single = vectors.one_each(own, score)
            own, score = own[single], score[single]
            kept = vectors.best(own, score, self.k)
            self.found[q] = own[kept], score[kept]
            if len(kept) == self.k and score[kept[-1]] > self.limit[q]:
                self.limit[q], changed = score[kept[-1]], True
        if changed:
            self.radius = radii(self.asked, self.limit, self.longest)

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.queries, [len(ids) for ids, _ in self.found])),
             pa.array(np.concatenate([ids for ids, _ in self.found])), pa.array(np.concatenate([s for _, s in self.found]))],
            names=["query_id", "vec_id", "score"])


def search(visits: DataFrame, pivots: np.ndarray, longest: float, k: int) -> DataFrame:
    """The ``k`` best of each query of a (block, slice): its block's row comes first, then its cells by their gap."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bests, over = None, False
        for batch in batches:
            row = batch.to_pydict()
            for number in range(batch.num_rows):
                if row["gap"][number] < 0:
                    if bests:
                        yield bests.rows()
                    bests, over = Bests(row, number, k, longest), False
                    continue
                over = over or bests.done(row["gap"][number])
                if not over:
                    bests.visit(row, number, pivots[row["pivot"][number]])
        if bests:
            yield bests.rows()

    return visits.mapInArrow(work, FOUND)


def exact_top_k(rows: DataFrame, every: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest integer products of every ``every``-th vector."""
    spark = rows.sparkSession
    numbered = vectors.usable(rows, zero=True)
    sample = vectors.fit_sample(numbered)
    pivots = vectors.kmeans(whole_numbers(sample) if len(sample) else np.zeros((1, 1)), vectors.PIVOTS)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", frames.ARROW_ROWS)
    assigned = vectors.assign(numbered, pivots, whole_numbers)
    cells = frames.store(vectors.packed(assigned, "cell", vectors.CELL), "topk-cells")
    whole = lambda x: F.floor(x * SCALE).cast("double")
    norm = F.aggregate("vec", F.lit(0.0), lambda total, x: total + whole(x) * whole(x))
    longest = float(np.sqrt(numbered.agg(F.max(norm)).first()[0] or 0.0))
    with frames.batch_rows(spark, vectors.PACKED_ROWS):
        asked = frames.store(seeds(cells, every, k), "topk-queries")
    blocks = frames.store(vectors.packed(asked, "block", vectors.QUERY_BLOCK, extra=True, across=True), "topk-blocks")
    with frames.batch_rows(spark, vectors.PACKED_ROWS):
        near = reach(blocks, pivots, longest)
        where = cells.select("cell", "pivot", "dmin", "dmax")
        gap = F.greatest(F.lit(0.0), F.col("near") - F.col("dmax"), F.col("dmin") - F.col("far"))
        pairs = frames.store(
            near.join(where, "pivot").where((F.col("dmax") >= F.col("low")) & (F.col("dmin") <= F.col("high")))
            .select("block", "cell", gap.alias("gap")), "topk-pairs")
        slices = pairs.groupBy("block").agg(F.ceil(F.count("*") / VISITS).cast("int").alias("slices"))
        data = ("pivot", "n", "ids", "dists", "mat", "extra")
        opening = blocks.join(slices, "block").select(
            "block", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(-1.0).alias("gap"), *data)
        reached = pairs.join(slices, "block").select(
            "block", F.pmod(F.xxhash64("cell"), F.col("slices")).cast("int").alias("slice"), "gap", "cell").join(cells, "cell").select(
            "block", "slice", "gap", *data)
        dealt = opening.unionByName(reached).repartition("block", "slice").sortWithinPartitions("block", "slice", "gap")
        found = frames.store(search(dealt, pivots, longest, k), "topk-found")
    return vectors.merged(found, k)


# The same by all products; a vec_id with several vectors counts once, with its best score.
TOP_K_SQL = """
WITH usable AS (
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), usual AS (
    SELECT len(vec) AS size FROM usable GROUP BY size ORDER BY count(*) DESC, size LIMIT 1
), whole AS (
    SELECT vec_id, vec FROM usable WHERE len(vec) = (SELECT size FROM usual)
), scored AS (
    SELECT q.vec_id AS query_id, x.vec_id, CAST(max(list_inner_product(q.vec, x.vec)) AS BIGINT) AS score
    FROM whole AS q, whole AS x
    WHERE q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id
    GROUP BY q.vec_id, x.vec_id
), placed AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""


def op6_exact_top_k(spark, sf_dir: str) -> DataFrame:
    found = exact_top_k(frames.table(spark, sf_dir, "embeddings"), 50, 5)
    return found.withColumn("score", F.col("score").cast("bigint"))
