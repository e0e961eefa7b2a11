"""Weighted near-duplicates and components against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from tillweave.llm import frames, graph, sampling


def words(text):
    return [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]


class Union(dict):
    def top(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self[max(a, b)] = min(a, b)


def brute(rows):
    texts = {doc_id: words(text) for doc_id, text in rows}
    frequency = Counter(w for _, text in rows for w in set(words(text)))
    total = len(rows)
    idf = lambda w: min(math.log(total / frequency[w]) / -math.log(sampling.RARE), 1.0)
    sets = {}
    for doc_id, found in texts.items():
        n = min(5, len(found))
        grams = Counter(tuple(found[i : i + n]) for i in range(len(found) - n + 1)) if n else Counter()
        sets[doc_id] = {g: count * (1 + max(map(idf, g))) for g, count in grams.items()}
    union, holders = Union(), defaultdict(list)
    for doc_id, weights in sets.items():
        union.top(doc_id)
        for gram in weights:
            holders[gram].append(doc_id)
    for a, b in {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}:
        both = sum(min(w, sets[b].get(g, 0)) for g, w in sets[a].items())
        if both / (sum(sets[a].values()) + sum(sets[b].values()) - both) >= sampling.SIMILAR - 1e-9:
            union.join(a, b)
    return {doc_id: union.top(doc_id) for doc_id in texts}


def test_against_brute_force(documents):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    line = "one line that many of the texts have in common with each other"
    rows = []
    for family in range(25):
        text = rng.choices(vocabulary, k=rng.randint(20, 120))
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(text)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy) + (" " + line if rng.random() < 0.5 else "")))
    # A chain: each text is near the next, the ends are far apart.
    chain = rng.choices(vocabulary, k=80)
    for step in range(8):
        rows.append((500 + step, " ".join(chain)))
        chain = chain[6:] + rng.choices(vocabulary, k=6)
    rows += [(600, None), (601, ""), (602, "..."), (603, "one two"), (604, "One, two!"), (605, "one two three"), (606, "w1 " * 5000)]
    got = {r["doc_id"]: r["class_id"] for r in sampling.near_duplicates(documents(rows)).collect()}
    assert got == brute(rows)


def test_many_near_copies_cost_one_comparison_each(documents):
    text = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        copy = list(text)
        copy[i % 150] = f"own{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(text)) for i in range(300)]
    got = sampling.near_duplicates(documents(rows)).collect()
    assert {r["class_id"] for r in got} == {0} and len(got) == 600


def test_repeated_rows_and_empty(documents):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "A b c d e f")]
    got = [(r["doc_id"], r["class_id"]) for r in sampling.near_duplicates(documents(rows)).collect()]
    assert sorted(got) == [(3, 3), (5, 3), (5, 3)]
    assert sampling.near_duplicates(documents([(1, "a")]).where("doc_id < 0")).count() == 0


def test_sampler_agrees_like_weighted_jaccard():
    import numpy as np

    from tillweave.llm import kernels

    grams = kernels.stream(300, 77)
    agreed = []
    for seed in range(60):
        sampler = sampling.Sampler()
        sampler.seeds = kernels.stream(36, 1000 + seed)
        a = sampler(grams[:200], np.full(200, 2.0, np.float32))
        b = sampler(grams[100:300], np.full(200, 2.0, np.float32))
        agreed.append((a == b).mean())
    assert abs(sum(agreed) / 60 - 1 / 3) < 0.03


def test_components(spark, documents):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i + 1000, i + 1001) for i in range(40)] + [(7, 7)]
    union = Union()
    for a, b in pairs:
        if a != b:
            union.join(a, b)
    frames.ready(spark)
    links = frames.store(spark.createDataFrame(pairs, "a bigint, b bigint"), "pairs")
    got = {r["node"]: r["component"] for r in graph.components(links).collect()}
    assert got == {x: union.top(x) for pair in pairs if pair[0] != pair[1] for x in pair}


def test_profiles_bound_the_similarity():
    """No pair of similarity SIMILAR is ruled out, most pairs well below it are, whatever the numbers of bins."""
    rng = np.random.default_rng(3)
    dropped = far = 0
    for trial in range(300):
        grams = np.unique(rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64))
        weight = (rng.integers(1, 4, len(grams)) * (1 + rng.random(len(grams)))).astype(np.float32)
        kept = rng.random(len(grams)) < rng.uniform(0.6, 1.0)
        more = rng.integers(0, 2**63, rng.integers(0, 2 + len(grams) // 3)).astype(np.uint64)
        other = np.unique(np.concatenate((grams[kept], more)))
        own = dict(zip(grams.tolist(), weight.tolist()))
        other_weight = np.array([own.get(g, 1.5) for g in other.tolist()], dtype=np.float32)
        if not len(other):
            continue
        both = sum(own.get(g, 0.0) for g in other.tolist() if g in own)
        totals = weight.sum(dtype=np.float64), other_weight.sum(dtype=np.float64)
        similarity = both / (sum(totals) - both)
        a, b = sampling.profile(grams, weight), sampling.profile(other, other_weight)
        possible = sampling.hopeful([a], [b], totals[0:1] * np.ones(1), totals[1:2] * np.ones(1))[0, 0]
        assert possible or similarity < sampling.SIMILAR
        far += similarity < 0.6
        dropped += similarity < 0.6 and not possible
    assert far > 30 and dropped > 0.8 * far


def test_texts_without_a_partner_are_not_shuffled(spark, monkeypatch):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('t', id) AS text").unionByName(
        spark.sql("SELECT CAST(null AS bigint) AS doc_id, 'x' AS text"))
    wanted = spark.range(20_000).where("id % 100 = 7").toDF("doc_id")
    for marks in (sampling.MARKS, 1 << 17):
        monkeypatch.setattr(sampling, "MARKS", marks)
        left = {r.doc_id: r.text for r in sampling.marked(docs, wanted).collect()}
        assert {i: left[i] for i in range(7, 20_000, 100)} == {i: f"t{i}" for i in range(7, 20_000, 100)}
        assert len(left) < 400


def test_sets_are_made_in_tasks_with_one_python_process(spark, monkeypatch):
    plans = []
    inner = sampling.weighted_sets

    def planned(texts, words, idf):
        found = inner(texts, words, idf)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(sampling, "weighted_sets", planned)
    rows = [(i, " ".join(f"v{i // 2}x{k}" for k in range(30))) for i in range(40)] + [(40 + i, f"v{i}x0 " * 30) for i in range(2)]
    rows += [(50 + i, " ".join(f"w{k}" for k in range(60)) + f" own{i}") for i in range(2)]
    found = {r.doc_id: r.class_id for r in sampling.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[51] == found[50] == 50 and found[1] == 0
    assert [plan.count("MapInArrow") for plan in plans] == [1]


def test_only_marked_texts_reach_the_join(spark, monkeypatch):
    seen = []
    inner = sampling.marked
    monkeypatch.setattr(sampling, "marked", lambda docs, wanted: seen.append(inner(docs, wanted)) or seen[-1])
    same = " ".join(f"w{k}" for k in range(30))
    rows = [(i, " ".join(f"v{i}x{k}" for k in range(30))) for i in range(300)] + [(300, same), (301, same + " more")]
    found = {r.doc_id: r.class_id for r in sampling.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {i: min(i, 300) for i in range(302)}
    assert {r.doc_id for r in seen[0].collect()} == {300, 301}
