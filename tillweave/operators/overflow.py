"""What a bucket cap leaves out, found exactly: identical contents and matches inside crowded buckets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.operators import lsh
from tillweave.session import write_through


# Documents of one shingle in a block, and what comparisons of sizes leave for rounding.
BLOCK = 128
SLACK = 1e-6
# Documents of a cell, and different shingles that two cells are compared by at a time.
CELL = 256
COLUMNS = 4096


def content_groups(docs: DataFrame, sets: DataFrame, column: str = "word5") -> DataFrame:
    """(doc_id, rep): documents with the same shingle set share the earliest of them as ``rep``.

    ``docs`` has (doc_id, published_at). Copies have the same neighbours in the match graph, so star
    clusters over the representatives, with the copies put back, are the clusters over all documents.
    A group of any size costs one row per document.
    """
    ordered = F.sort_array(column)
    keyed = docs.select("doc_id", "published_at").join(
        sets.where(F.size(column) > 0).select(
            "doc_id", F.xxhash64(ordered).alias("k1"), F.xxhash64(F.lit(1), ordered).alias("k2")
        ),
        "doc_id",
    )
    shared = (
        keyed.groupBy("k1", "k2")
        .agg(F.min(F.struct("published_at", "doc_id")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("k1", "k2", F.col("first.doc_id").alias("rep"))
    )
    return keyed.join(shared, ["k1", "k2"], "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"))


def rare_first(sets: DataFrame, threshold: float) -> DataFrame:
    """(shingle, docs, doc_id, n, place): the shared shingles among each set's rarest n - ceil(t * n) + 1, with their places.

    Two sets with Jaccard >= t have one of these in common. Sets of one doc_id are told apart by a hash, and equal ones have equal places.
    """
    long = sets.select("doc_id", F.size("word5").alias("n"), F.xxhash64("word5").alias("set"), F.explode("word5").alias("shingle"))
    frequency = long.groupBy("shingle").agg(F.count("*").alias("docs"))
    order = Window.partitionBy("doc_id", "set").orderBy("docs", "shingle")
    length = F.col("n") - F.ceil(F.col("n") * threshold - SLACK) + 1
    placed = long.join(frequency, "shingle").withColumn("place", F.dense_rank().over(order))
    return placed.where((F.col("place") <= length) & (F.col("docs") > 1)).select("shingle", "docs", "doc_id", "n", "place")


def may_match(a: Column, b: Column, threshold: float) -> Column:
    """Can two items of ``n`` to ``high`` shingles that meet in a shingle with ``rest`` shingles behind it reach the threshold?

    Their sizes have to fit, and if this is the first shingle they share, the common ones are it and at most the smaller
    rest. A pair that fails here is either too different or was found at an earlier shingle.
    """
    sizes = (a["high"] >= b["n"] * threshold - SLACK) & (b["high"] >= a["n"] * threshold - SLACK)
    return sizes & (F.least(a["rest"], b["rest"]) + 1 >= (a["n"] + b["n"]) * (threshold / (1 + threshold)) - SLACK)


def blocks(postings: DataFrame, threshold: float, size: int = BLOCK) -> DataFrame:
    """(shingle, block, items, bounds): the documents of each shingle in blocks of about ``size``, with bounds on what they hold.

    A shingle of at most ``size`` documents is one block. Others are cut by set size, in steps that no match is wider than two of, and
    within a step by a hash of the document, so a shingle that a third of all documents have is spread over as many rows as needed.
    Items may stand for several sets, of ``n`` to ``high`` shingles.
    """
    high = F.col("high" if "high" in postings.columns else "n").alias("high")
    hot = F.col("docs") > size
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold)) if threshold < 1 else F.col("n")
    part = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("docs") / size))
    block = F.when(hot, F.struct(step.cast("bigint").alias("step"), part.cast("bigint").alias("part")))
    rest = (F.col("n") - F.col("place")).alias("rest")
    return postings.select("shingle", block.alias("block"), "doc_id", "n", high, rest).groupBy("shingle", "block").agg(
        F.collect_list(F.struct("doc_id", "n", "high", "rest")).alias("items"),
        F.min("n").alias("n_min"), F.max("high").alias("n_max"), F.max("rest").alias("rest_max"))


def block_pairs(cut: DataFrame, threshold: float) -> DataFrame:
    """(shingle, block_a, block_b): the blocks of frequent shingles that can hold a match, by their bounds alone; each pair once."""
    side = lambda s: cut.where("block IS NOT NULL").select(
        "shingle", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "n_min", "n_max", "rest_max")])
    fits = (
        (F.col("block_a") <= F.col("block_b"))
        & (F.col("n_max_a") >= F.col("n_min_b") * threshold - SLACK) & (F.col("n_max_b") >= F.col("n_min_a") * threshold - SLACK)
        & (F.least("rest_max_a", "rest_max_b") + 1 >= (F.col("n_min_a") + F.col("n_min_b")) * (threshold / (1 + threshold)) - SLACK)
    )
    return side("a").join(side("b"), "shingle").where(fits).select("shingle", "block_a", "block_b")


def _met(a: Column, b: Column, threshold: float, keep) -> Column:
    """Pairs (id_a, id_b) of the items ``a`` x ``b`` that pass ``keep`` and may match, one row of pairs for each item of ``a``."""
    found = F.filter(b, lambda y: keep(a, y) & may_match(a, y, threshold))
    return F.transform(found, lambda y: F.struct(
        F.least(a["doc_id"], y["doc_id"]).alias("id_a"), F.greatest(a["doc_id"], y["doc_id"]).alias("id_b")))


def meetings(cut: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (id_a, id_b) that meet in a shingle where they may match.

    A row of work is one document against one block, so what a task holds does not depend on how frequent a shingle is.
    """
    later = lambda x, y: x["doc_id"] < y["doc_id"]
    inside = cut.where("block IS NULL AND size(items) > 1").select("items", F.explode("items").alias("item"))
    near = inside.select(F.explode(_met(F.col("item"), F.col("items"), threshold, later)).alias("pair"))
    pairs = write_through(block_pairs(cut, threshold), "block_pairs")
    holds = lambda s: cut.select("shingle", F.col("block").alias(f"block_{s}"), F.col("items").alias(f"items_{s}"))
    faced = (
        pairs.join(holds("a"), ["shingle", "block_a"]).join(holds("b"), ["shingle", "block_b"])
        .select((F.col("block_a") == F.col("block_b")).alias("own"), F.explode("items_a").alias("item"), "items_b")
    )
    other = lambda x, y: ~F.col("own") | later(x, y)
    far = faced.select(F.explode(_met(F.col("item"), F.col("items_b"), threshold, other)).alias("pair"))
    return near.unionByName(far).select("pair.*").distinct()


def cells(held: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, n, cell, crowds): documents of crowded buckets in cells of about ``CELL`` that are likely to match one another.

    ``held`` has (doc_id, bucket_size, crowd), a row for each crowded bucket of a document, ``sizes`` (doc_id, n). A document's home
    is the largest of its buckets; the documents of a home are cut by set size and by a hash. ``crowds`` are all its buckets.
    """
    homes = held.groupBy("doc_id").agg(
        F.max(F.struct("bucket_size", "crowd"))["crowd"].alias("home"), F.collect_set("crowd").alias("crowds"))
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold)) if threshold < 1 else F.col("n")
    placed = write_through(homes.join(sizes, "doc_id").withColumn("step", step.cast("bigint")), "homes")
    parts = placed.groupBy("home", "step").agg(F.ceil(F.count("*") / CELL).alias("parts"))
    cell = F.xxhash64("home", "step", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    return placed.join(parts, ["home", "step"]).select("doc_id", "n", cell.alias("cell"), "crowds")


def cell_pairs(postings: DataFrame, placed: DataFrame, threshold: float) -> DataFrame:
    """(cell_a, cell_b): pairs of cells that can hold a match, and every cell of several rows with itself.

    Cells are searched like single documents: they meet in the rarest shingles of their documents, and may match if any two of those may.
    """
    met = postings.join(placed.select("doc_id", "n", "cell").distinct(), ["doc_id", "n"]).groupBy("shingle", "cell").agg(
        F.min("n").alias("n"), F.max("n").alias("high"), F.max(F.col("n") - F.col("place")).alias("rest"))
    met = write_through(met, "cell_postings")
    shared = met.groupBy("shingle").agg(F.count("*").alias("docs")).where("docs > 1")
    of_cells = met.join(shared, "shingle").select(
        "shingle", "docs", F.col("cell").alias("doc_id"), "n", "high", (F.col("n") - F.col("rest")).alias("place"))
    pairs = meetings(write_through(blocks(of_cells, threshold), "blocks"), threshold)
    own = placed.groupBy("cell").agg(F.count("*").alias("rows")).where("rows > 1")
    return pairs.select(F.col("id_a").alias("cell_a"), F.col("id_b").alias("cell_b")).unionByName(
        own.select(F.col("cell").alias("cell_a"), F.col("cell").alias("cell_b")))


def _common(sets: pa.Array, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Matrix (left, right) of the numbers of elements that two of the duplicate-free arrays ``sets`` have in common."""
    values, sizes = sets.flatten().to_numpy(), sets.value_lengths().to_numpy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, code = np.unique(values, return_inverse=True)
    places, inside = [], np.ones(code.max(initial=-1) + 1, dtype=bool)
    for side in (left, right):
        place = np.full(len(sizes), -1)
        place[side] = np.arange(len(side))
        places.append(place[owner])
        inside &= np.bincount(code[places[-1] >= 0], minlength=len(inside)) > 0
    if left is right:
        inside &= np.bincount(code, minlength=len(inside)) > 1
    column = np.where(inside, np.cumsum(inside) - 1, -1)[code]
    order = np.flatnonzero(column >= 0)
    order = order[np.argsort(column[order], kind="stable")]
    column, places = column[order], [place[order] for place in places]
    found = np.zeros((len(left), len(right)), dtype=np.float64)
    for first in range(0, int(inside.sum()), COLUMNS):
        within = slice(*np.searchsorted(column, (first, first + COLUMNS)))
        sides = []
        for side, place in zip((left, right), places):
            one = np.zeros((len(side), COLUMNS), dtype=np.float32)
            here = place[within] >= 0
            one[place[within][here], column[within][here] - first] = 1
            sides.append(one)
        found += sides[0] @ sides[1].T
    return found


def _compared(threshold: float):
    """Function for the documents of a pair of cells: (id_a, id_b, jaccard) of those that match and share a crowded bucket."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        column = lambda name: table[name].chunk(0)
        ids, sets = column("doc_id").to_numpy(zero_copy_only=False), column("word5")
        cell, cell_a, cell_b = (column(name).to_numpy() for name in ("cell", "cell_a", "cell_b"))
        left = np.flatnonzero(cell == cell_a)
        right = left if cell_a[0] == cell_b[0] else np.flatnonzero(cell == cell_b)
        sizes = sets.value_lengths().to_numpy().astype(np.float64)
        common = _common(sets, left, right)
        jaccard = common / (sizes[left][:, None] + sizes[right][None, :] - common)
        a, b = ids[left][:, None], ids[right][None, :]
        kept = (jaccard >= threshold) & (a < b if right is left else a != b)
        if kept.any():
            kept &= _common(column("crowds"), left, right) > 0
        at = np.nonzero(kept)
        first, second = ids[left[at[0]]], ids[right[at[1]]]
        kind = table.schema.field("doc_id").type
        return pa.table({
            "id_a": pa.array(np.minimum(first, second), kind), "id_b": pa.array(np.maximum(first, second), kind),
            "jaccard": pa.array(jaccard[at], pa.float64())})

    return compare


def crowded_matches(
    buckets: DataFrame, sets: DataFrame, sigs: DataFrame, threshold: float,
    cap: int = lsh.CAP, bands: int = 32, rows: int = 4,
) -> DataFrame:
    """(id_a, id_b, jaccard) of all pairs at or above ``threshold`` that share a bucket above ``cap``.

    Documents are dealt to cells by their largest bucket. Two cells are compared if documents of theirs meet in one of their rarest
    shingles and the places of that shingle leave room for a match; frequent shingles are searched block by block. Sets travel once for
    each pair of cells, and no row stands for a pair of documents that do not match. A pair is one row unless documents are repeated.
    """
    large = write_through(lsh.bucket_sizes(buckets).where(F.col("bucket_size") > cap), "crowded_buckets")
    held = lsh.lsh_buckets(sigs, bands, rows).join(large, list(lsh.BUCKET)).select(
        "doc_id", "bucket_size", F.xxhash64(*lsh.BUCKET).alias("crowd"))
    inside = write_through(held.where("doc_id IS NOT NULL"), "crowded_docs")
    found = write_through(sets.join(inside, "doc_id", "left_semi").select("doc_id", "word5"), "crowded_sets")
    placed = write_through(cells(inside, found.select("doc_id", F.size("word5").alias("n")).distinct(), threshold), "cells")
    pairs = write_through(cell_pairs(rare_first(found, threshold), placed, threshold), "cell_pairs")
    faced = pairs.select("cell_a", "cell_b", F.explode(F.array_distinct(F.array("cell_a", "cell_b"))).alias("cell"))
    items = found.withColumn("n", F.size("word5")).join(placed, ["doc_id", "n"])
    kind = sets.schema["doc_id"].dataType.simpleString()
    return (
        faced.join(items.select("cell", "doc_id", "word5", "crowds"), "cell")
        .groupBy("cell_a", "cell_b").applyInArrow(_compared(threshold), f"id_a {kind}, id_b {kind}, jaccard double")
    )


def with_copies(stars: DataFrame, groups: DataFrame) -> DataFrame:
    """Centers of the representatives carried over to all their copies."""
    of_rep = stars.select(F.col("doc_id").alias("rep"), "center")
    copies = groups.where("doc_id <> rep").join(of_rep, "rep").select("doc_id", "center")
    return stars.select("doc_id", "center").unionByName(copies)
