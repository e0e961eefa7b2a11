"""Star clusters over matched documents, with ids that survive re-runs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.operators.components import components
from tillweave.session import shared_dir, write_through

# A component of at most so many edges is settled by one task.
COMPONENT_EDGES = 100_000


def _ranked_edges(ranks: DataFrame, matches: DataFrame) -> DataFrame:
    """Matches both ways round as (v, v_rank, u, u_rank); a rank is null outside ``ranks``."""
    both = matches.select(F.inline(F.array(
        F.struct(F.col("id_a").alias("v"), F.col("id_b").alias("u")),
        F.struct(F.col("id_b").alias("v"), F.col("id_a").alias("u")),
    ))).where("v <> u").distinct()
    of = lambda c: ranks.select(F.col("doc_id").alias(c), F.col("rank").alias(f"{c}_rank"))
    return both.join(of("v"), "v", "left").join(of("u"), "u", "left")


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered documents of whole components whose edges come in order of the later end.

    When an edge is read, all edges that could cover its earlier end have been read, so that end is a center unless covered.
    """
    root, covered = None, set()
    for batch in batches:
        fresh = []
        for own, lo, hi in zip(*(batch[name].to_pylist() for name in ("root", "lo", "hi"))):
            if own != root:
                root, covered = own, set()
            if lo not in covered and hi not in covered:
                covered.add(hi)
                fresh.append(hi)
        yield pa.RecordBatch.from_arrays([pa.array(fresh, batch["hi"].type)], names=["hi"])


def _first_chain(live: DataFrame) -> DataFrame:
    """(doc_id, center) for the documents that are decided now.

    A document without an earlier neighbour is a center. One with a single earlier neighbour is a center if and only if that neighbour
    is not, so along runs of such documents the decisions alternate. Jumps are doubled until they reach the start of their
    run; runs that start at a center are decided at once, whatever their length.
    """
    nodes = live.groupBy(F.col("hi").alias("doc_id")).agg(F.count("*").alias("n"), F.min("lo").alias("to"))
    sources = live.select(F.col("lo").alias("doc_id")).distinct().join(nodes, "doc_id", "left_anti")
    jumps = write_through(nodes.where("n = 1").select("doc_id", "to", F.lit(True).alias("odd")), "jumps")
    while True:
        on = jumps.select(F.col("doc_id").alias("to"), F.col("to").alias("further"), F.col("odd").alias("odd_further"))
        longer = jumps.join(on, "to", "left").select(
            "doc_id", F.coalesce("further", "to").alias("to"),
            F.when(F.col("odd_further"), ~F.col("odd")).otherwise(F.col("odd")).alias("odd"), F.col("further").isNotNull().alias("moved"))
        longer = write_through(longer, "jumps")
        jumps = longer.drop("moved")
        if longer.where("moved").isEmpty():
            break
    decided = jumps.join(sources.select(F.col("doc_id").alias("to")), "to", "left_semi").select("doc_id", (~F.col("odd")).alias("center"))
    return sources.select("doc_id", F.lit(True).alias("center")).unionByName(decided)


def covered_documents(edges: DataFrame, in_one_task: int = COMPONENT_EDGES) -> DataFrame:
    """Documents that end up next to an earlier center.

    In document order, the first document not yet covered becomes a center and covers its direct neighbours. Only blocking
    edges (lo before hi, both ordered) take part; everything that is never covered is a center. Components do not influence
    each other: those of at most ``in_one_task`` edges are settled by one sorted pass of a task each, many to a
    task. Larger ones are decided in rounds by many tasks: centers and the runs behind them are decided, their later neighbours
    are covered, decided documents leave. The covered documents of all rounds are parts of one folder.
    """
    live = write_through(
        edges.where("v_rank is not null and u_rank is not null and v_rank < u_rank")
        .select(F.col("v").alias("lo"), F.col("u").alias("hi"), F.col("u_rank").alias("hi_rank")), "live"
    )
    roots = write_through(components(live.select(F.col("lo").alias("u"), F.col("hi").alias("v"))), "roots")
    tagged = write_through(live.join(roots.withColumnRenamed("node", "lo"), "lo"), "live")
    sizes = write_through(tagged.groupBy("root").agg(F.count("*").alias("n")), "component_sizes")
    small = tagged.join(sizes.where(F.col("n") <= in_one_task).select("root"), "root", "left_semi")
    key = live.schema["hi"].dataType.simpleString()
    settled = (
        small.repartition("root").sortWithinPartitions("root", "hi_rank").select("root", "lo", "hi")
        .mapInArrow(_settle, f"hi {key}")
    )
    folder = f"{shared_dir(edges.sparkSession)}/tables/covered-{uuid.uuid4().hex}"
    settled.write.parquet(folder)
    live = write_through(tagged.join(sizes.where(F.col("n") > in_one_task).select("root"), "root", "left_semi").select("lo", "hi"), "live")
    while not live.isEmpty():
        decided = write_through(_first_chain(live), "decided")
        centers = decided.where("center").select(F.col("doc_id").alias("lo"))
        fresh = live.join(centers, "lo", "left_semi").select("hi").distinct()
        gone = write_through(fresh.unionByName(decided.select(F.col("doc_id").alias("hi"))).distinct(), "gone")
        fresh.write.mode("append").parquet(folder)
        live = write_through(
            live.join(gone, "hi", "left_anti").join(gone.select(F.col("hi").alias("lo")), "lo", "left_anti").select("lo", "hi"), "live")
    return edges.sparkSession.read.schema(f"hi {key}").parquet(folder).select(F.col("hi").alias("doc_id"))


def star_clusters(docs: DataFrame, matches: DataFrame, in_one_task: int = COMPONENT_EDGES) -> DataFrame:
    """(doc_id, center) for every document, and for matched ids that are not among the documents.

    ``docs`` has (doc_id, published_at). The order is (published_at, doc_id). The center of a covered
    document is its earliest neighbour that is a center; membership does not spread any further.
    """
    ranks = docs.select("doc_id", F.struct("published_at", "doc_id").alias("rank"))
    edges = write_through(_ranked_edges(ranks, matches), "edges")
    covered = covered_documents(edges, in_one_task)
    centers = ranks.join(covered, "doc_id", "left_anti").select(F.col("doc_id").alias("u"))
    owner = (
        edges.join(centers, "u", "left_semi")
        .where("u_rank is not null and (v_rank is null or u_rank < v_rank)")
        .groupBy("v")
        .agg(F.min("u_rank").alias("first"))
        .select(F.col("v").alias("doc_id"), F.col("first.doc_id").alias("center"))
    )
    own = centers.select(F.col("u").alias("doc_id"), F.col("u").alias("center"))
    return own.unionByName(owner)


def cluster_id(center: Column) -> Column:
    """An id that only depends on the canonical document, so a re-run makes the same one."""
    h = F.sha2(center.cast("string"), 256)
    return F.concat_ws("-", *[F.substring(h, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def stable_mapping(stars: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """(doc_id, center, cluster_id, created, reused).

    A document keeps the id it has in ``prior`` (doc_id, cluster_id). Otherwise it takes the id of its
    center, which is the center's prior id or a new one.
    """
    if prior is None:
        known = stars.withColumn("own_id", F.lit(None).cast("string")).withColumn("center_id", F.lit(None).cast("string"))
    else:
        of = lambda key, name: prior.select(F.col("doc_id").alias(key), F.col("cluster_id").alias(name))
        known = stars.join(of("doc_id", "own_id"), "doc_id", "left").join(of("center", "center_id"), "center", "left")
    is_center = F.col("doc_id") == F.col("center")
    return known.select(
        "doc_id", "center",
        F.coalesce("own_id", "center_id", cluster_id(F.col("center"))).alias("cluster_id"),
        (is_center & F.col("own_id").isNull()).alias("created"),
        (is_center & F.col("own_id").isNotNull()).alias("reused"),
    )


def cluster_table(mapping: DataFrame) -> DataFrame:
    """New clusters: (cluster_id, canonical document)."""
    return mapping.where("created").select("cluster_id", F.col("center").alias("canonical_doc_id"))


def cluster_summary(mapping: DataFrame) -> DataFrame:
    """Clusters, mapped documents, ids created and ids reused."""
    per_id = mapping.groupBy("cluster_id").agg(
        F.count("*").alias("docs"), F.sum(F.col("created").cast("int")).alias("created"),
        F.sum(F.col("reused").cast("int")).alias("reused"),
    )
    return per_id.agg(
        F.count("*").alias("clusters"), F.sum("docs").alias("mapped"),
        F.sum("created").alias("created"), F.sum("reused").alias("reused"), F.max("docs").alias("largest"),
    )
