import random

import pytest

from tillweave.operators import clusters


def one_by_one(docs, edges, prior):
    """The sequential rule on small input: (center of each document, id of each document)."""
    near = {}
    for a, b in edges:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    center, ids = {}, {}
    for _, d in sorted((at, d) for d, at in docs):
        if d in center:
            continue
        center[d], ids[d] = d, prior.get(d, f"new-{d}")
        for other in near.get(d, []):
            if other not in center:
                center[other], ids[other] = d, prior.get(other, ids[d])
    return center, ids


@pytest.mark.parametrize("seed, in_one_task", [(0, 100_000), (1, 0), (2, 30), (3, 0), (4, 100_000)])
def test_random_graphs(spark, seed, in_one_task):
    draw = random.Random(seed)
    docs = [(d, draw.randrange(8)) for d in range(40)]
    known = [d for d, _ in docs]
    edges = {tuple(sorted(draw.sample(known + [100, 101], 2))) for _ in range(draw.choice([15, 45, 120]))}
    edges = {(a, b) for a, b in edges if not (a >= 100 and b >= 100)}
    prior = {d: f"old-{d % 5}" for d in draw.sample(known, 8)}
    center, ids = one_by_one(docs, edges, prior)
    d = spark.createDataFrame(docs, "doc_id bigint, published_at int")
    m = spark.createDataFrame([(a, b, 0.9) for a, b in edges], "id_a bigint, id_b bigint, jaccard double")
    p = spark.createDataFrame(list(prior.items()), "doc_id bigint, cluster_id string")
    stars = clusters.star_clusters(d, m, in_one_task)
    assert {r.doc_id: r.center for r in stars.collect()} == center
    mapping = clusters.stable_mapping(stars, p).collect()
    new = {spark.range(1).select(clusters.cluster_id(clusters.F.lit(c))).first()[0]: f"new-{c}" for c in set(center.values())}
    assert {r.doc_id: new.get(r.cluster_id, r.cluster_id) for r in mapping} == ids


def test_chain_is_not_merged_through_its_middle(spark):
    d = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "doc_id bigint, published_at int")
    m = spark.createDataFrame([(1, 2), (2, 3)], "id_a bigint, id_b bigint")
    assert {r.doc_id: r.center for r in clusters.star_clusters(d, m).collect()} == {1: 1, 2: 1, 3: 3}
    later = spark.createDataFrame([(1, 2), (2, 1), (3, 3)], "doc_id bigint, published_at int")
    assert {r.doc_id: r.center for r in clusters.star_clusters(later, m).collect()} == {1: 2, 2: 2, 3: 2}


@pytest.mark.parametrize("in_one_task", [100_000, 0])
def test_a_long_chain_needs_few_rounds(spark, monkeypatch, in_one_task):
    """2,000 re-posts, each like the one before: decisions alternate, and no round settles one link only."""
    written = []
    counted = lambda df, name="step", real=clusters.write_through: written.append(name) or real(df, name)
    monkeypatch.setattr(clusters, "write_through", counted)
    monkeypatch.setattr("tillweave.operators.components.write_through", counted)
    order = list(range(2000))
    random.Random(4).shuffle(order)
    d = spark.createDataFrame(list(zip(order, range(2000))), "doc_id bigint, published_at int")
    links = list(zip(order, order[1:]))
    m = spark.createDataFrame(links, "id_a bigint, id_b bigint")
    center, _ = one_by_one(list(zip(order, range(2000))), links, {})
    assert {r.doc_id: r.center for r in clusters.star_clusters(d, m, in_one_task).collect()} == center
    assert written.count("components") <= 30 and written.count("jumps") <= 30 and written.count("decided") <= 2


def test_components(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)]
    parent = list(range(300))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    got = clusters.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == {x: top(x) for a, b in edges if a != b for x in (a, b)}


def test_ids_survive_a_rerun_with_more_documents(spark):
    d = spark.createDataFrame([(5, 5), (6, 6)], "doc_id bigint, published_at int")
    m = spark.createDataFrame([(5, 6)], "id_a bigint, id_b bigint")
    first = clusters.stable_mapping(clusters.star_clusters(d, m))
    prior = first.select("doc_id", "cluster_id")
    # An earlier document joins the group: the old members keep their id.
    d2 = spark.createDataFrame([(1, 1), (5, 5), (6, 6)], "doc_id bigint, published_at int")
    m2 = spark.createDataFrame([(5, 6), (1, 5), (1, 6)], "id_a bigint, id_b bigint")
    second = clusters.stable_mapping(clusters.star_clusters(d2, m2), prior)
    before, after = ({r.doc_id: r.cluster_id for r in x.collect()} for x in (first, second))
    assert all(after[k] == v for k, v in before.items()) and after[1] != after[5]
    again = clusters.stable_mapping(clusters.star_clusters(d2, m2), second.select("doc_id", "cluster_id"))
    assert {r.doc_id: r.cluster_id for r in again.collect()} == after
    summary = clusters.cluster_summary(again).first()
    assert (summary.created, summary.reused, summary.mapped) == (0, 1, 3)


def test_no_matches(spark):
    d = spark.createDataFrame([(1, 1)], "doc_id bigint, published_at int")
    m = spark.createDataFrame([], "id_a bigint, id_b bigint")
    assert [tuple(r) for r in clusters.star_clusters(d, m).collect()] == [(1, 1)]
