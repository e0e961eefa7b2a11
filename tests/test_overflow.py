import random
from itertools import combinations

import pytest

from test_clusters import one_by_one
from test_text import docs_of, grams, plain
from tillweave.operators import clusters, evaluation as ev, lsh, minhash as mh, overflow, shingles as sh


def crowd(seed):
    """A third of the texts are copies of one, another third share most of their words."""
    draw = random.Random(seed)
    words = [f"v{i}" for i in range(400)]
    base = [draw.choice(words) for _ in range(60)]
    texts = []
    for i in range(60):
        if i % 3 == 0:
            texts.append(" ".join(base))
        elif i % 3 == 1:
            cut = draw.randrange(5, 40)
            texts.append(" ".join(base[:cut] + [draw.choice(words) for _ in range(60 - cut)]))
        else:
            texts.append(" ".join(draw.choice(words) for _ in range(draw.choice([2, 30, 60]))))
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("cap,threshold", [(2, 0.5), (5, 0.3), (100, 0.5)])
def test_nothing_is_lost_above_the_cap(spark, cap, threshold):
    texts = crowd(cap)
    docs = docs_of(spark, texts).selectExpr("doc_id", "text", "doc_id % 7 as published_at")
    sets = sh.shingle_sets(docs, "word5").cache()
    sigs = mh.signatures(docs).cache()
    ids = {r.doc_id: r.sig for r in sigs.collect()}
    exact = {i: grams(plain(t).split(), 5, " ") for i, t in enumerate(texts)}
    alike = {
        (a, b) for a, b in combinations(sorted(ids), 2)
        if any(ids[a][4 * k:4 * k + 4] == ids[b][4 * k:4 * k + 4] for k in range(32))
        and len(exact[a] & exact[b]) / len(exact[a] | exact[b]) >= threshold
    }
    buckets = lsh.lsh_buckets(sigs)
    paired = ev.final_matches(sh.pair_jaccard(lsh.candidates(buckets, cap), sets), threshold)
    found = paired.unionByName(overflow.crowded_matches(buckets, sets, sigs, threshold, cap)).distinct()
    assert {(r.id_a, r.id_b) for r in found.collect()} == alike
    if cap < 20:
        assert paired.count() < len(alike)

    groups = overflow.content_groups(docs.select("doc_id", "published_at"), sets)
    by_content = {}
    for i in sorted(ids, key=lambda i: (i % 7, i)):
        by_content.setdefault(frozenset(exact[i]), i)
    assert {r.doc_id: r.rep for r in groups.collect()} == {i: by_content[frozenset(exact[i])] for i in ids}

    reps = groups.where("doc_id = rep").select("doc_id")
    rep_sigs = sigs.join(reps, "doc_id", "left_semi")
    rep_buckets = lsh.lsh_buckets(rep_sigs)
    rep_matches = ev.final_matches(sh.pair_jaccard(lsh.candidates(rep_buckets, cap), sets), threshold).unionByName(
        overflow.crowded_matches(rep_buckets, sets, rep_sigs, threshold, cap)).distinct()
    copies = groups.where("doc_id <> rep")
    stars = overflow.with_copies(
        clusters.star_clusters(docs.join(copies, "doc_id", "left_anti").select("doc_id", "published_at"), rep_matches), copies)
    expected, _ = one_by_one([(i, i % 7) for i in range(len(texts))], alike, {})
    assert {r.doc_id: r.center for r in stars.collect()} == expected


@pytest.mark.parametrize("threshold, size", [(0.5, 8), (0.3, 5), (0.8, 16), (0.5, 1000)])
def test_blocks_lose_no_match(spark, threshold, size):
    draw = random.Random(size)
    common = [draw.randrange(10**9) for _ in range(60)]
    rows = []
    for i in range(90):
        kept = draw.sample(common, draw.randrange(5, 60)) if i % 2 else common[: draw.randrange(10, 60)]
        rows.append((i, sorted({*kept, *(draw.randrange(10**9) for _ in range(draw.randrange(0, 40)))})))
    sets = spark.createDataFrame(rows, "doc_id bigint, word5 array<bigint>")
    cut = overflow.blocks(overflow.rare_first(sets, threshold), threshold, size).cache()
    met = {(r.id_a, r.id_b) for r in overflow.meetings(cut, threshold).collect()}
    jaccard = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    alike = {(a, b) for (a, x), (b, y) in combinations(rows, 2) if jaccard(x, y) >= threshold}
    assert alike and alike <= met and all(a < b for a, b in met)
    if size < 1000:
        assert cut.where("block IS NOT NULL").count() > 0


def test_a_preamble_of_many_documents_makes_bounded_work(spark):
    """2,000 documents share 90 shingles and have 80 of their own: Jaccard 0.35, so the bounds rule every block pair out."""
    preamble = list(range(90))
    rows = [(i, preamble + [1000 + 100 * i + k for k in range(80)]) for i in range(2000)]
    rows += [(2000 + i, preamble + [1000 + 100 * i + k for k in range(78)]) for i in range(3)]
    sets = spark.createDataFrame(rows, "doc_id bigint, word5 array<bigint>")
    postings = overflow.rare_first(sets, 0.5).cache()
    assert postings.where("docs > 2").count() >= 2000
    cut = overflow.blocks(postings, 0.5).cache()
    assert cut.selectExpr("max(size(items)) AS n").first().n <= 2 * overflow.BLOCK
    assert overflow.block_pairs(cut, 0.5).count() == 0
    assert {(r.id_a, r.id_b) for r in overflow.meetings(cut, 0.5).collect()} == {(i, 2000 + i) for i in range(3)}


def test_near_copies_make_no_row_for_each_pair(spark, monkeypatch):
    """240 texts of 40 shared and a few own words, some of them repeated rows, in cells of 32: only the result has rows for pairs."""
    draw = random.Random(5)
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base[: draw.randrange(24, 40)] + [f"x{i}y{k}" for k in range(draw.randrange(0, 12))]) for i in range(240)]
    docs = docs_of(spark, texts)
    docs = docs.unionByName(docs.where("doc_id % 10 = 0"))
    sets, sigs = sh.shingle_sets(docs, "word5").cache(), mh.signatures(docs).cache()
    written, write = [], overflow.write_through
    monkeypatch.setattr(overflow, "write_through", lambda df, name: written.append(write(df, name)) or written[-1])
    monkeypatch.setattr(overflow, "CELL", 32)
    found = overflow.crowded_matches(lsh.lsh_buckets(sigs), sets, sigs, 0.5, 60).distinct().collect()
    ids = {r.doc_id: [tuple(r.sig[4 * k : 4 * k + 4]) for k in range(32)] for r in sigs.collect()}
    sizes = {}
    for bands in (row for r in sigs.collect() for row in [ids[r.doc_id]]):
        for k, band in enumerate(bands):
            sizes[k, band] = sizes.get((k, band), 0) + 1
    exact = {i: grams(plain(t).split(), 5, " ") for i, t in enumerate(texts)}
    alike = {(a, b): len(exact[a] & exact[b]) / len(exact[a] | exact[b]) for a, b in combinations(sorted(ids), 2)
             if any(x == y and sizes[k, x] > 60 for k, (x, y) in enumerate(zip(ids[a], ids[b])))}
    alike = {pair: score for pair, score in alike.items() if score >= 0.5}
    assert len(alike) > 10_000 and {(r.id_a, r.id_b): r.jaccard for r in found} == alike
    assert max(table.count() for table in written if "cell" in table.columns or "id_a" in table.columns) < 3000
    assert all("id_a" not in table.columns for table in written)
