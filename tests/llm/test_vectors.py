"""Both vector searches against brute force."""

import numpy as np
import pytest

from tillweave.llm import frames, scan, topk

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def made(spark, rows):
    frames.ready(spark)
    return frames.store(spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA), "vectors")


def clustered(n, size, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    vecs = np.where(rng.random((n, 1)) < 0.6, centres[rng.integers(0, 12, n)] + 0.1 * rng.normal(size=(n, size)), rng.normal(size=(n, size)))
    return (vecs / np.linalg.norm(vecs, axis=1, keepdims=True)).astype(np.float32)


def odd_rows(size):
    return [(5000, None), (5001, []), (5002, [None] * size), (5003, [float("nan")] * size), (5004, [float("inf")] + [0.0] * (size - 1)),
            (5050, [1.0] * (size - 1)), (5100, [0.0] * size)]


def exact(rows, every, k, change, zero):
    size = max(len(v) for _, v in rows if v is not None)
    good = {i: np.float32(v).astype(float) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v) and (zero or np.any(v))}
    ids = np.array(sorted(good))
    vecs = change(np.array([good[i] for i in ids]))
    result = {}
    for q in np.flatnonzero(ids % every == 0):
        scores = (vecs * vecs[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:k]
        result[int(ids[q])] = [(int(ids[i]), float(scores[i])) for i in order]
    return result


def lists(df):
    result = {}
    for row in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        result.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert row["rank"] == len(result[row["query_id"]])
    return result


@pytest.mark.parametrize("hot", [False, True])
def test_exact_top_k(spark, hot):
    vecs = clustered(3000, 16)
    rows = list(enumerate(vecs.tolist()))
    if hot:  # a third of all vectors are the same: ties, and cells full of one vector
        rows = [(i, vecs[7].tolist() if i % 3 == 0 else v) for i, v in rows]
    rows += odd_rows(16) + [rows[50], rows[51]]
    got = lists(topk.exact_top_k(made(spark, rows), 50, 5))
    assert got == exact(rows, 50, 5, topk.whole_numbers, True)


def test_exact_top_k_small(spark):
    rows = [(0, [1.0, 2.0]), (50, [3.0, -4.0]), (3, [0.5, 0.5])]
    assert lists(topk.exact_top_k(made(spark, rows), 50, 5)) == exact(rows, 50, 5, topk.whole_numbers, True)
    assert topk.exact_top_k(made(spark, rows[:1]), 50, 5).count() == 0
    assert topk.exact_top_k(made(spark, [(1, None)]), 50, 5).count() == 0
    big = [(i, [float(i % 7) * 1e9, 3e9 - i]) for i in range(120)]
    got = lists(topk.exact_top_k(made(spark, big), 50, 5))
    assert set(got) == {0, 50, 100} and all(len(found) == 5 for found in got.values())


@pytest.mark.parametrize("hot", [False, True])
def test_dimension_scan_recall(spark, hot):
    vecs = clustered(3000, 32, seed=2)
    rows = list(enumerate(vecs.tolist()))
    if hot:
        rows = [(i, vecs[7].tolist() if i % 3 == 0 else v) for i, v in rows]
    rows += odd_rows(32)
    got, wanted = lists(scan.nearest(made(spark, rows), 20, 20)), exact(rows, 20, 20, lambda x: x, False)
    assert set(got) == set(wanted)
    if not hot:  # with thousands of ties any of them is as near, but the smallest ids are asked for
        hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
        assert hits >= 0.9 * sum(map(len, wanted.values()))
    for q, found in got.items():
        assert len(found) == 20 and [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        best = dict(wanted[q])
        assert all(abs(best[i] - s) < 1e-12 for i, s in found if i in best)


def test_dimension_scan_row_repeated_over_cells(spark, monkeypatch):
    """One row 3,000 times fills more cells than there are places; it is one neighbour, and one query, like any other."""
    monkeypatch.setattr(scan.vectors, "CELL", 128)
    rows = list(enumerate(clustered(3000, 32, seed=2).tolist()))
    copied = 40
    got, wanted = lists(scan.nearest(made(spark, rows + [rows[copied]] * 3000), 20, 20)), exact(rows, 20, 20, lambda x: x, False)
    assert set(got) == set(wanted) and all(len({i for i, _ in found}) == len(found) == 20 for found in got.values())
    near = [q for q in wanted if copied in {i for i, _ in wanted[q]}]
    for asked in (list(wanted), near):
        assert sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in asked) >= 0.9 * 20 * len(asked)


def test_best_keeps_one_entry_for_a_row_in_every_cell():
    rng = np.random.default_rng(6)
    query, mat = rng.normal(size=8), rng.normal(size=(60, 8))
    mat[0] = query * 3
    longest = float(np.sqrt((mat * mat).sum(axis=1).max()))
    block = {"n": [1], "ids": [np.array([900]).tobytes()], "dists": [np.zeros(1).tobytes()],
             "mat": [scan.vectors.to_bytes(query[None, :])], "extra": [np.array([np.inf]).tobytes()]}
    best = scan.Best(block, 0, 20, longest, np.eye(9))
    columns = np.ascontiguousarray(scan.lengthened(mat, longest).T)
    for _ in range(20):
        best.visit(np.arange(1), mat[:1], columns[:, :1])
    best.visit(np.arange(60), mat, columns)
    rows = best.rows().to_pydict()
    assert rows["vec_id"] == np.argsort(-(mat @ query))[:20].tolist()


def test_dimension_scan_lengths_and_small(spark):
    """Vectors of different lengths: the largest inner product is not the smallest angle."""
    vecs = clustered(1500, 24, seed=3) * np.linspace(0.2, 3, 1500)[:, None].astype(np.float32)
    rows = list(enumerate(vecs.tolist()))
    got, wanted = lists(scan.nearest(made(spark, rows), 20, 20)), exact(rows, 20, 20, lambda x: x, False)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted) >= 0.9 * 20 * len(wanted)
    assert scan.nearest(made(spark, rows[:1]), 20, 20).count() == 0
    assert scan.nearest(made(spark, [(20, [0.0, 0.0])]), 20, 20).count() == 0
    assert lists(scan.nearest(made(spark, [(0, [1.0, 0.0]), (1, [0.5, 1.0])]), 20, 20)) == {0: [(1, 0.5)]}


def test_abandoning_keeps_the_near():
    rng = np.random.default_rng(4)
    cell, query = rng.normal(size=(500, 64)), rng.normal(size=64)
    away = ((cell - query) ** 2).sum(axis=1)
    limit = np.sort(away)[20]
    alive = scan.survivors(np.ascontiguousarray(cell.T), query, limit)
    assert set(alive) <= set(np.flatnonzero(away <= limit * (1 + 1e-6))) and len(alive) >= 19


def test_a_vec_id_with_several_vectors_counts_once(spark):
    rng = np.random.default_rng(9)
    rows = [(50, [1.0, 0.0, 0.0, 0.0])] + [(7001, (np.eye(4)[0] * 5 + rng.normal(size=4) * 0.01).tolist()) for _ in range(8)]
    rows += [(i, (np.eye(4)[0] + rng.normal(size=4) * 0.1).tolist()) for i in range(1, 30)]
    got = lists(topk.exact_top_k(made(spark, rows), 50, 5))[50]
    score = lambda v: int(np.floor(256 * np.array(v)) @ np.array([256.0, 0, 0, 0]))
    best = {}
    for i, v in rows[1:]:
        best[i] = max(best.get(i, -10**9), score(v))
    assert [(i, int(s)) for i, s in got] == sorted(best.items(), key=lambda e: (-e[1], e[0]))[:5]


def test_annuli_expand_and_stop():
    """Cells visited by their gap give the exact best, and a block stops before the far cells."""
    rng = np.random.default_rng(8)
    near, far = rng.normal(size=(64, 6)), rng.normal(size=(64, 6)) - 80.0
    longest = float(np.sqrt((far * far).sum(axis=1).max()))
    pivot = np.zeros(6)

    def cell(ids, mat):
        dists = np.sqrt((mat * mat).sum(axis=1))
        order = np.argsort(dists)
        return {"n": [len(ids)], "ids": [ids[order].tobytes()], "dists": [dists[order].tobytes()],
                "mat": [topk.vectors.to_bytes(mat[order])], "extra": [b""]}

    query = 70 * np.ones(6)
    block = cell(np.array([5000]), query[None, :]) | {"extra": [np.array([-np.inf]).tobytes()]}
    bests = topk.Bests(block, 0, 5, longest)
    assert not bests.done(1e9)  # nothing found yet: every cell may hold one of the best
    bests.visit(cell(np.arange(64), near), 0, pivot)
    assert bests.rows().to_pydict()["vec_id"] == np.argsort(-(near @ query))[:5].tolist()
    reach = float(np.sqrt(query @ query + longest**2 - 2 * np.sort(near @ query)[-5]))
    assert bests.done(reach * 1.01) and not bests.done(reach * 0.99)
    bests.visit(cell(np.arange(100, 164), far), 0, pivot)
    assert max(bests.rows().to_pydict()["vec_id"]) < 64


def test_slices_of_a_block_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(topk.vectors, "CELL", 64)
    monkeypatch.setattr(topk, "VISITS", 4)
    rows = list(enumerate(clustered(2500, 12, seed=5).tolist()))
    assert lists(topk.exact_top_k(made(spark, rows), 50, 5)) == exact(rows, 50, 5, topk.whole_numbers, True)
