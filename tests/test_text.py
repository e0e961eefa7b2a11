import hashlib
import random

from pyspark.sql import functions as F

from tillweave.functions.text import normalize_text
from tillweave.operators import minhash as mh, shingles as sh
from tillweave.plans import neardup
from tillweave.sources.tables import plan_text

ODD = [
    None, "", "   ", "Hello, WORLD!  x", "see https://a.b/c?d=1 now", "http://x y HTTPS://Z.q　w www.foo.bar/baz end",
    "é1À tab\tnew\nline\x0bvt", "a" * 12, "one two three four", "one two three four five", "x y\u0085z",
]


LETTERS_AND_DIGITS = set("abcdefghijklmnopqrstuvwxyz0123456789")


def plain(text):
    """What is left of each word: the runs of letters and digits before a link in it."""
    runs = []
    for word in (text or "").lower().split():
        links = [word.index(start) for start in ("http://", "https://") if start in word and not word.endswith(start)]
        run = ""
        for char in [*word[: min(links, default=len(word))], None]:
            if char in LETTERS_AND_DIGITS:
                run += char
            elif run:
                runs.append(run)
                run = ""
    return " ".join(runs)


def grams(seq, n, joiner):
    return {joiner.join(seq[i:i + n]) for i in range(len(seq) - n + 1)}


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def random_texts(n, seed=3):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    return [" ".join(draw.choice(words) for _ in range(draw.choice([0, 3, 5, 9, 40]))) for _ in range(n)]


def test_normalisation(spark):
    rows = docs_of(spark, ODD).select("doc_id", normalize_text(F.col("text")).alias("n")).collect()
    assert {r.doc_id: r.n for r in rows} == {i: plain(t) for i, t in enumerate(ODD)}
    www = docs_of(spark, ["go www.foo.bar/x now"]).select(normalize_text(F.col("text"), True).alias("n")).first().n
    assert www == "go now"


def test_ngram_sets(spark):
    texts = ODD + random_texts(20)
    docs = docs_of(spark, texts)
    for n in (3, 5):
        got = {(r.doc_id, r.shingle) for r in sh.word_ngrams(docs, n).collect()}
        assert got == {(i, g) for i, t in enumerate(texts) for g in grams(plain(t).split(), n, " ")}
    got = sh.char_ngrams(docs, 5).collect()
    assert len(got) == len(set(got))
    assert {(r.doc_id, r.shingle) for r in got} == {(i, g) for i, t in enumerate(texts) for g in grams(plain(t), 5, "")}


def test_jaccard_of_pairs(spark):
    texts = ODD + random_texts(20)
    docs = docs_of(spark, texts)
    ids = range(len(texts))
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "id_a bigint, id_b bigint")
    scored = sh.pair_jaccard(pairs, sh.shingle_sets(docs, *sh.SETS), {m: m for m in sh.SETS})

    def exact(a, b):
        return 1.0 if not a and not b else len(a & b) / len(a | b)

    for r in scored.collect():
        a, b = plain(texts[r.id_a]), plain(texts[r.id_b])
        for name, n, joiner, cut in (("word3", 3, " ", str.split), ("word5", 5, " ", str.split), ("char5", 5, "", list)):
            assert r[name] == exact(grams(cut(a), n, joiner), grams(cut(b), n, joiner))


def test_text_is_normalised_once_per_document(spark):
    docs = docs_of(spark, ["a b c d e f"])
    for df in (sh.shingle_sets(docs, *sh.SETS).where(F.size("word5") == 0), sh.word_ngrams(docs, 5).where("shingle > 'a'"), mh.signatures(docs)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace(") == 2
        assert "Exchange" not in plan_text(df)


def _sig(shingles, k):
    hashes = [int(hashlib.md5(s.encode()).hexdigest(), 16) % mh.PRIME for s in shingles]
    return [min((a * h + b) % mh.PRIME for h in hashes) for a, b in mh.coefficients(k)]


def test_hashes_and_signatures_equal_big_integer_arithmetic(spark):
    texts = random_texts(30, 9) + [" ".join(f"t{i}" for i in range(9000))]
    docs = docs_of(spark, texts)
    expected = {i: grams(plain(t).split(), 5, " ") for i, t in enumerate(texts)}
    got = {r.shingle: r.h for r in sh.word_ngrams(docs, 5).select("shingle", mh.shingle_hash(F.col("shingle")).alias("h")).collect()}
    assert all(h == int(hashlib.md5(s.encode()).hexdigest(), 16) % mh.PRIME for s, h in got.items())
    sigs = {r.doc_id: r.sig for r in mh.signatures(docs, 16).collect()}
    assert sigs == {i: _sig(s, 16) for i, s in expected.items() if s}
    native = {r.doc_id: r.sig for r in mh.signatures_native(sh.word_ngrams(docs, 5), 16).collect()}
    assert native == sigs
    short = {r.doc_id for r in mh.too_short(docs).collect()}
    assert short == {i for i, s in expected.items() if not s}


def test_coefficients_are_prefixes():
    assert mh.coefficients(256)[:128] == mh.coefficients(128)
    random.seed(mh.SEED)
    drawn = [(random.randint(1, mh.PRIME - 1), random.randint(0, mh.PRIME - 1)) for _ in range(3)]
    assert mh.coefficients(3) == drawn


def test_estimates_of_short_documents(spark):
    docs = docs_of(spark, ["a b c d e f", "x", "y", "a b c d e f"])
    pairs = spark.createDataFrame([(0, 1), (1, 2), (0, 3)], "id_a bigint, id_b bigint")
    rows = mh.minhash_estimate(pairs, mh.signatures(docs), (32,)).collect()
    assert {(r.id_a, r.id_b): r.minhash_32 for r in rows} == {(0, 1): 0.0, (1, 2): 1.0, (0, 3): 1.0}


def test_range_of_character_runs_is_taken_before_rows_are_made(spark):
    texts = [(1, "abcdefg"), (1, "bcdefgh"), (2, "abc"), (3, None), (None, "a-b c d")]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    rows = sh.char_ngrams(docs, 5).groupBy("doc_id").agg(
        F.count("*").alias("shingles"), F.min("shingle").alias("first"), F.max("shingle").alias("last"))
    got = sh.char_ngram_range(docs, 5)
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.collect())) and got.where("doc_id = 1").first()["shingles"] == 6


def test_character_runs_are_rows_and_their_range_needs_no_sort(spark):
    docs = spark.createDataFrame([(1, "abcdefghij"), (1, "zbcdefgh 0"), (2, "abc"), (3, None), (4, "0-b 9 d z1 aaaaaaaaaa"), (None, "q w e r t y")], "doc_id int, text string")
    for n in (1, 5, 7, 8):
        rows = sh.char_ngrams(docs, n).groupBy("doc_id").agg(
            F.count("*").alias("shingles"), F.min("shingle").alias("first"), F.max("shingle").alias("last"))
        got = sh.char_ngram_range(docs, n)
        assert sorted(map(str, got.collect())) == sorted(map(str, rows.collect())) and got.dtypes == rows.dtypes
    plan = plan_text(sh.char_ngram_range(docs, 5))
    assert "explode(array_distinct(" in plan and "HashAggregate" in plan and "Sort" not in plan


def test_texts_give_the_scores_of_their_sets(spark):
    texts = ["a b c d e f g", "a b c d e x", "", None, "a b", "A, b; C d e f g http://x.y/z", "a b c d e f g"]
    docs = spark.createDataFrame([(i % 6, t) for i, t in enumerate(texts)], "doc_id int, text string")
    pairs = docs.select(F.col("doc_id").alias("id_a")).distinct().crossJoin(docs.select(F.col("doc_id").alias("id_b")).distinct())
    measures = {name: f"{name}_jaccard" for name in sh.SETS}
    of_sets = sh.pair_jaccard(pairs, sh.shingle_sets(docs, *sh.SETS), measures)
    of_texts = sh.text_jaccard(pairs, sh.normal_texts(docs), measures)
    assert sorted(map(str, of_texts.collect())) == sorted(map(str, of_sets.collect())) and of_texts.columns == of_sets.columns


def test_labelled_pairs_store_no_sets(spark, monkeypatch):
    monkeypatch.setattr(sh, "shingle_sets", None)
    job = neardup.NearDup(spark, "/root/testdata/sf0.001", 0.99)
    assert job.similarity().count() == job.exact().count() == job.pairs().count()


def test_signatures_send_texts_in_short_batches(spark):
    docs = neardup.NearDup(spark, "/root/testdata/sf0.001").docs()
    assert "md5(" not in plan_text(mh.signatures(docs))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
