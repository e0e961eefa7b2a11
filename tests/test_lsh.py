import random
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tillweave.operators import evaluation as ev, lsh
from tillweave.sources.tables import plan_text


def random_signatures(n, seed):
    """Few values per position, so that buckets of many sizes arise, and a third with one signature."""
    draw = random.Random(seed)
    hot = [draw.randrange(3) for _ in range(128)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            sig = list(hot)
        else:
            sig = [draw.randrange(2) if p < 32 else draw.randrange(9) for p in range(128)]
            if i % 3 == 1:
                sig[:8] = hot[:8]
        rows.append((i, sig))
    return rows


def bands(sig, shape):
    b, r = shape
    return [(i, tuple(sig[i * r:(i + 1) * r])) for i in range(b)]


def brute_buckets(rows, shape):
    buckets = defaultdict(list)
    for i, sig in rows:
        for key in bands(sig, shape):
            buckets[key].append(i)
    return buckets


@pytest.fixture(scope="module")
def rows():
    return random_signatures(60, 5)


@pytest.fixture(scope="module")
def sigs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, sig array<bigint>")


@pytest.mark.parametrize("cap", [2, 5, 19, 100])
def test_capped_candidates(sigs, rows, cap):
    buckets = brute_buckets(rows, (32, 4))
    expected = {p for ids in buckets.values() if len(ids) <= cap for p in combinations(sorted(ids), 2)}
    got = lsh.candidates(lsh.lsh_buckets(sigs), cap).collect()
    assert len(got) == len(expected) and {(r.id_a, r.id_b) for r in got} == expected


def test_candidate_counts_are_unions_of_buckets(spark, sigs, rows):
    ids = spark.createDataFrame([(i, "p") for i, _ in rows] + [(999, "q")], "doc_id bigint, portal string")
    got = {(r.configuration, r.doc_id): r.candidate_count for r in lsh.candidate_counts(lsh.buckets_of_all(sigs), ids).collect()}
    for name, shape in lsh.CONFIGURATIONS.items():
        near = defaultdict(set)
        for members in brute_buckets(rows, shape).values():
            for i in members:
                near[i].update(members)
        for i, _ in rows:
            assert got[name, i] == len(near[i] - {i})
        assert got[name, 999] == 0


def test_a_crowded_bucket_makes_no_pairs(spark):
    """3,000 documents in one bucket, and each with a partner in another: the bitmaps are a few rows, the counts exact."""
    rows = [("c", 0, 7, i) for i in range(3000)] + [("c", 1 + i % 2, 100 + i // 2, i) for i in range(3000)]
    rows += [("c", 5, 1, 1), ("c", 5, 1, 5000), ("c", 6, 2, 6000)]
    buckets = spark.createDataFrame(rows, "configuration string, band int, bucket_hash bigint, doc_id bigint")
    sets = lsh.member_sets(buckets)
    assert sets.count() == 2
    copies = buckets.unionByName(buckets.selectExpr("configuration", "band + 10 AS band", "bucket_hash", "doc_id"))
    assert lsh.member_sets(copies).select("members").distinct().count() == 2
    places = lsh.dense_ids(buckets.select("doc_id").distinct(), "doc_id")
    bits = lsh.bitmaps(buckets.where("band = 0").join(places, "doc_id").select("configuration", "bucket_hash", "place"))
    assert bits.count() == 1 and bits.selectExpr("bitmap_count(bits) AS n").first().n == 3000
    ids = spark.createDataFrame([(i,) for i in (0, 1, 5000, 6000)], "doc_id bigint")
    old = dict(lsh.CONFIGURATIONS)
    lsh.CONFIGURATIONS.clear()
    lsh.CONFIGURATIONS["c"] = (1, 1)
    try:
        got = {r.doc_id: r.candidate_count for r in lsh.candidate_counts(copies, ids).collect()}
        plan = plan_text(lsh.candidate_counts(copies, ids))
    finally:
        lsh.CONFIGURATIONS.clear()
        lsh.CONFIGURATIONS.update(old)
    assert got == {0: 2999, 1: 3000, 5000: 1, 6000: 0}
    assert "id_a" not in plan


def test_dense_numbers(spark):
    rows = spark.range(1000).selectExpr("id % 7 AS a", "id AS b").repartition(9)
    got = lsh.dense_ids(rows, "a", "b").collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.place)] == sorted((i % 7, i) for i in range(1000))
    assert sorted(r.place for r in got) == list(range(1000))
    assert lsh.dense_ids(rows.where("a > 10"), "a").count() == 0


def test_largest_bucket_is_cut_before_the_exchange(sigs):
    plan = plan_text(lsh.candidates(lsh.lsh_buckets(sigs)))
    before, after = plan.split("Exchange", 1)
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.count("+- Exchange") + plan.count(":- Exchange") <= 2


def test_survival_and_cap_sweep(spark, sigs, rows):
    by_id = dict(rows)
    draw = random.Random(1)
    pairs = [(a, b, draw.choice(["same", "different"])) for a, b in draw.sample(list(combinations(range(60), 2)), 200)]
    pairs.append((0, 999, "same"))
    df = spark.createDataFrame(pairs, "id_a bigint, id_b bigint, label string")
    got = {(r.configuration, r.id_a, r.id_b): r.candidate_survived for r in lsh.survival(df, sigs).collect()}
    for name, shape in lsh.CONFIGURATIONS.items():
        for a, b, _ in pairs:
            expected = b in by_id and bool(set(bands(by_id[a], shape)) & set(bands(by_id[b], shape)))
            assert got[name, a, b] == expected
    buckets = brute_buckets(rows, (32, 4))
    swept = {(r.cap, r.label): (r.retrieved, r.total) for r in lsh.cap_sweep(df, sigs, (3, 10, 30)).collect()}
    for cap in (3, 10, 30):
        for label in ("same", "different"):
            mine = [(a, b) for a, b, l in pairs if l == label]
            hit = sum(
                b in by_id and any(len(buckets[k]) <= cap for k in set(bands(by_id[a], (32, 4))) & set(bands(by_id[b], (32, 4))))
                for a, b in mine
            )
            assert swept[cap, label] == (hit, len(mine))


def test_bin_edges_are_right_closed(spark):
    values = [0.0, 0.1, 0.10000001, 0.3, 0.30000000000000004, 1.0, 0.5]
    df = spark.createDataFrame([(v,) for v in values], "jaccard double")
    assert [r[0] for r in df.select(ev.bin_number(F.col("jaccard"))).collect()] == [0, 0, 1, 2, 3, 9, 4]
    assert [ev.bin_label(i) for i in (0, 1, 9)] == ["(-0.001, 0.1]", "(0.1, 0.2]", "(0.9, 1.0]"]


def test_thresholds_and_cost(spark):
    rows = [("same", 0.9)] * 3 + [("same", 0.52)] * 2 + [("different", 0.7)] + [("different", 0.1)] * 4
    scored = spark.createDataFrame(rows, "label string, jaccard double")
    by = {r.threshold: r for r in ev.threshold_eval(scored).collect()}
    assert (by[0.5].tp, by[0.5].fp, by[0.5].tn, by[0.5].fn) == (5, 1, 4, 0)
    assert (by[0.95].precision, by[0.95].recall, by[0.95].f1) == (0.0, 0.0, 0.0)
    best = {r.ratio: (r.minimum_cost, r.threshold) for r in ev.cheapest_threshold(ev.cost_curve(ev.threshold_eval(scored))).collect()}
    assert best == {10: (2, 0.75), 50: (2, 0.75), 100: (2, 0.75)}


def test_sets_of_one_group_lie_close_together(spark, monkeypatch):
    """40 groups of 30 documents, each in a bucket of 25 and in small ones: the numbers of a bucket's documents stay within its group."""
    draw = random.Random(3)
    rows = []
    for group in range(40):
        ids = [group + 40 * i for i in range(30)]
        rows += [("32x4", 0, group, i) for i in ids[:25]]
        for band in range(1, 12):
            rows += [("32x4", band, 100 * group + k, i) for k in range(5) for i in draw.sample(ids, 4)]
    buckets = spark.createDataFrame(sorted(set(rows)), "configuration string, band int, bucket_hash bigint, doc_id bigint")
    numbered, bitmaps = [], lsh.bitmaps
    monkeypatch.setattr(lsh, "bitmaps", lambda sets: numbered.append(sets) or bitmaps(sets))
    ids = buckets.select("doc_id").distinct().unionByName(spark.range(5000, 5001).toDF("doc_id"))
    got = {r.doc_id: r.candidate_count for r in lsh.candidate_counts(buckets, ids).where("configuration = '32x4'").collect()}
    met = {}
    for row in rows:
        met.setdefault(row[:3], set()).add(row[3])
    others = {i: set() for i in got}
    for members in met.values():
        for i in members:
            others[i] |= members - {i}
    assert got == {i: len(o) for i, o in others.items()} and got[5000] == 0
    spans = numbered[0].groupBy("configuration", "members").agg((F.max("place") - F.min("place")).alias("span")).collect()
    assert max(r.span for r in spans) < 30
