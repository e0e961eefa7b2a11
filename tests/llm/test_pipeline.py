"""The pipeline end to end, each stage against what it promises."""

import corpus_pipeline as pipeline
from tillweave.llm import frames, queries
from tillweave.session import write_through
from test_duplicates import brute

MIDDLE = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = frames.table(spark, MIDDLE, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    kept = write_through(pipeline.STAGES[0][1](spark, docs, MIDDLE), "t0")
    assert kept.columns == pipeline.COLUMNS
    gone = set(before) - {r["doc_id"] for r in kept.collect()}
    assert all(not any(c.isalpha() for c in before[i]["text"] or "") for i in gone)
    apart = write_through(pipeline.STAGES[1][1](spark, kept, MIDDLE), "t1")
    classes = brute([(r["doc_id"], r["text"]) for r in kept.collect()])
    assert {r["doc_id"] for r in apart.collect()} == set(classes.values())
    cut = write_through(pipeline.STAGES[2][1](spark, apart, MIDDLE), "t2")
    assert cut.columns == pipeline.COLUMNS and cut.count() == apart.count()
    seen = set()
    for r in sorted(cut.collect(), key=lambda r: r["doc_id"]):
        assert r["n_chars"] == len(r["text"]) and len(r["text"]) <= len(before[r["doc_id"]]["text"])
        seen.add(r["doc_id"])
    mixed = write_through(pipeline.STAGES[3][1](spark, cut, MIDDLE), "t3")
    assert mixed.columns == pipeline.COLUMNS and {r["doc_id"] for r in mixed.collect()} <= seen
    packed = pipeline.STAGES[4][1](spark, mixed, MIDDLE).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed.collect()}


def test_awkward_rows(spark, documents, folder):
    rows = [(1, None), (2, ""), (3, "..."), (4, "words of a text that stays here", None, None), (4, "words of a text that stays here", None, None), (5, "x " * 9000)]
    rows += [(10 + i, f"some plain english text number {i} with the words of it", "en") for i in range(9)]
    made = documents(rows)
    made.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/sf/documents.parquet")
    got = pipeline.run(spark, f"{folder}/sf").collect()
    assert got and {1, 2, 3}.isdisjoint(r["doc_id"] for r in got)
    made.where("doc_id < 0").select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/none/documents.parquet")
    assert pipeline.run(spark, f"{folder}/none").count() == 0


def test_repeated_and_missing_ids(spark, documents):
    """Different texts under one doc_id, or under none, are different rows; only exact repeats and later class members go."""
    text = lambda word: " ".join(f"{word}{i}" for i in range(40))
    rows = [(1, text("a")), (1, text("a")), (3, text("a")), (3, text("b")), (3, text("c")), (4, text("c")), (4, text("d"))]
    rows += [(None, text("e")), (None, text("f")), (None, text("e")), (None, text("b"))]
    got = pipeline.drop_near_duplicates(spark, documents(rows), MIDDLE)
    assert got.columns == pipeline.COLUMNS
    wanted = [(1, "a"), (3, "b"), (3, "c"), (4, "d"), (None, "e"), (None, "f")]
    assert sorted((str(r["doc_id"]), r["text"]) for r in got.collect()) == sorted((str(i), text(word)) for i, word in wanted)


def test_every_query_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in queries.QUERIES}
    assert numbers == set(range(1, 14)) and len(queries.QUERIES) == 13 and set(queries.SQL) <= set(queries.QUERIES)
