"""LSH buckets, candidate pairs, and the statistics of a banding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.operators.dense import dense_ids
from tillweave.session import write_through

# The three bandings compared, the bucket caps tried, the cap in use.
CONFIGURATIONS = {"32x4": (32, 4), "16x8": (16, 8), "8x16": (8, 16)}
CAPS = (50, 100, 150, 200, 300)
CAP = 100

BUCKET = ("band", "bucket_hash")


def band_slice(sig: Column, band: int, rows: int) -> Column:
    return F.slice(sig, band * rows + 1, rows)


def band_hashes(sig: Column, bands: int, rows: int) -> Column:
    return F.array(*[F.xxhash64(F.lit(b), band_slice(sig, b, rows)) for b in range(bands)])


def lsh_buckets(sigs: DataFrame, bands: int = 32, rows: int = 4) -> DataFrame:
    """(band, bucket_hash, doc_id), one row per document and band."""
    hashes = F.posexplode(band_hashes(F.col("sig"), bands, rows)).alias("band", "bucket_hash")
    return sigs.select("doc_id", hashes).select(*BUCKET, "doc_id")


def buckets_of_all(sigs: DataFrame, configurations: dict[str, tuple[int, int]] = CONFIGURATIONS) -> DataFrame:
    """Buckets of several bandings with a ``configuration`` column, from one scan of the signatures."""
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("configuration"), F.lit(b).alias("band"),
            F.xxhash64(F.lit(b), band_slice(F.col("sig"), b, rows)).alias("bucket_hash"),
        )
        for name, (bands, rows) in configurations.items()
        for b in range(bands)
    ])
    return sigs.select("doc_id", F.inline(entries)).select("configuration", *BUCKET, "doc_id")


def bucket_sizes(buckets: DataFrame) -> DataFrame:
    keys = [c for c in buckets.columns if c != "doc_id"]
    return buckets.groupBy(*keys).agg(F.count("*").alias("bucket_size"))


def bucket_stats(sizes: DataFrame) -> DataFrame:
    """Number, mean, median and largest size of the buckets per configuration."""
    freq = sizes.groupBy("configuration", "bucket_size").agg(F.count("*").alias("n"))
    return freq.groupBy("configuration").agg(
        F.sum("n").alias("buckets"),
        F.round(F.sum(F.col("bucket_size") * F.col("n")) / F.sum("n"), 2).alias("mean_size"),
        F.percentile("bucket_size", F.lit(0.5), F.col("n")).alias("median_size"),
        F.max("bucket_size").alias("max_size"),
    )


def _members(buckets: DataFrame, cap: int) -> DataFrame:
    """Every bucket with at least two members, as a list of at most ``cap + 1`` of them.

    The limit also runs before the exchange, so the largest bucket sends ``cap + 1`` rows per map
    task; a list of ``cap + 1`` only says that the bucket is over the cap.
    """
    limit = int(buckets.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if cap + 1 > limit:  # beyond it the limit would only run after the exchange
        raise ValueError(f"cap {cap} needs spark.sql.optimizer.windowGroupLimitThreshold above {cap}, it is {limit}")
    keys = [c for c in buckets.columns if c != "doc_id"]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id"))
    bounded = buckets.withColumn("n", position).where(F.col("n") <= cap + 1)
    return bounded.groupBy(*keys).agg(F.sort_array(F.collect_list("doc_id")).alias("ids")).where(F.size("ids") > 1)


def _pairs_of(members: DataFrame, cap: int) -> DataFrame:
    rest = [c for c in members.columns if c not in (*BUCKET, "ids")]
    first = members.where(F.size("ids") <= cap).select(*rest, "ids", F.posexplode("ids").alias("i", "id_a"))
    return first.select(
        *rest, "id_a", F.explode(F.slice(F.col("ids"), F.col("i") + 2, F.size("ids"))).alias("id_b")
    ).distinct()


def candidates(buckets: DataFrame, cap: int = CAP) -> DataFrame:
    """Distinct pairs id_a < id_b that share a bucket of at most ``cap`` documents.

    Over-cap buckets form no pairs here; ``tillweave.operators.overflow`` finds their matches exactly.
    """
    return _pairs_of(_members(buckets, cap), cap)


def member_sets(buckets: DataFrame) -> DataFrame:
    """Buckets of two or more documents with their size and ``members``, a hash that tells different sets of documents apart.

    Exact copies, and near copies that agree in several bands, fill several buckets with the same documents; these are
    one set from here on.
    """
    keys = [c for c in buckets.columns if c != "doc_id"]
    sized = buckets.groupBy(*keys).agg(
        F.count("*").alias("bucket_size"),
        F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "doc_id")).alias("y"),
    )
    return sized.where("bucket_size > 1").select(*keys, "bucket_size", F.xxhash64("bucket_size", "x", "y").alias("members"))


def bitmaps(sets: DataFrame) -> DataFrame:
    """(set key..., chunk, bits): the places of each set as bitmaps of 32,768 bits."""
    keys = [c for c in sets.columns if c != "place"]
    number = F.col("place") + 1  # the first bitmap holds the numbers from 1
    return sets.groupBy(*keys, F.bitmap_bucket_number(number).alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def union_sizes(profiles: DataFrame, bits: DataFrame, keys: list[str]) -> DataFrame:
    """(configuration, profile_id, reach): the number of documents in the union of a profile's sets.

    ``profiles`` has (configuration, profile_id, members), one row for each set of a profile, ``bits`` the bitmaps of the sets.
    """
    chunks = profiles.join(bits, [*keys, "members"]).groupBy(*keys, "profile_id", "chunk").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return chunks.groupBy(*keys, "profile_id").agg(F.sum("n").alias("reach"))


def neighbourhoods(members: DataFrame) -> DataFrame:
    """(doc_id, label): documents that share sets, or share sets with the same others, mostly have one label.

    A document's first label is the largest of its sets. A set takes the greatest label among its documents, a document the greatest
    among its sets; the second time over, the label has come to the documents that are in no set with the largest one's.
    """
    labels = members.groupBy("doc_id").agg(F.max(F.struct("bucket_size", "members")).alias("label"))
    keyed = members.select(F.xxhash64("configuration", "members").alias("set"), "doc_id")
    for _ in range(2):
        of_set = keyed.join(labels, "doc_id").groupBy("set").agg(F.max("label").alias("label"))
        labels = write_through(keyed.join(of_set, "set").groupBy("doc_id").agg(F.max("label").alias("label")), "labels")
    return labels


def candidate_counts(buckets: DataFrame, ids: DataFrame) -> DataFrame:
    """Number of other documents that share any bucket with each document, with no bucket left out and no pair made.

    The documents that share a bucket with a document are the union of its buckets. Equal buckets are one set, a document's sets are
    its profile, and a profile of one set needs no union. Each other profile's union is taken once, however many documents
    have it, by or-ing bitmaps over dense document numbers. Numbers follow ``neighbourhoods``, so a set takes few bitmaps however many
    documents there are. Only buckets of two or more documents are stored and read again.
    """
    sets = write_through(member_sets(buckets), "member_sets")
    held = write_through(buckets.join(sets, ["configuration", *BUCKET]), "held")
    profiles = held.groupBy("configuration", "doc_id").agg(F.collect_set(F.struct("members", "bucket_size")).alias("sets"))
    profiles = write_through(profiles.withColumn("sets", F.sort_array("sets")).withColumn("profile_id", F.xxhash64("sets")), "profiles")

    several = write_through(
        profiles.where(F.size("sets") > 1).groupBy("configuration", "profile_id").agg(F.first("sets").alias("sets"))
        .select("configuration", "profile_id", F.explode("sets.members").alias("members")), "unions")
    needed = several.select("configuration", "members").distinct()
    shown = sets.join(needed, ["configuration", "members"], "left_semi").groupBy("configuration", "members").agg(
        F.min(F.struct(*BUCKET)).alias("bucket")).select("configuration", "members", "bucket.*")
    members = write_through(held.select("configuration", *BUCKET, "doc_id", "bucket_size").join(shown, ["configuration", *BUCKET]).select(
        "configuration", "members", "bucket_size", "doc_id"), "members")
    # Documents of one set only are numbered too: they are in the unions of others.
    numbers = dense_ids(neighbourhoods(members), "label", "doc_id").select("doc_id", "place")
    bits = write_through(
        bitmaps(members.select("configuration", "members", "doc_id").join(write_through(numbers, "numbers"), "doc_id").drop("doc_id")), "bitmaps")
    reach = union_sizes(several, bits, ["configuration"])

    counted = profiles.join(reach, ["configuration", "profile_id"], "left").select(
        "configuration", "doc_id", (F.coalesce("reach", F.col("sets")[0]["bucket_size"]) - 1).alias("others"))
    names = F.array(*[F.lit(n) for n in CONFIGURATIONS])
    every = ids.select("*", F.explode(names).alias("configuration"))
    return every.join(counted, ["configuration", "doc_id"], "left").select(
        *every.columns, F.coalesce("others", F.lit(0)).alias("candidate_count"))


def candidate_distribution(counts: DataFrame) -> DataFrame:
    """Mean, percentiles (linear interpolation) and maximum per configuration, documents without any included."""
    freq = counts.groupBy("configuration", "candidate_count").agg(F.count("*").alias("n"))
    point = lambda p, name: F.round(F.percentile("candidate_count", F.lit(p), F.col("n")), 2).alias(name)
    return freq.groupBy("configuration").agg(
        F.round(F.sum(F.col("candidate_count") * F.col("n")) / F.sum("n"), 2).alias("mean_candidates"),
        point(0.5, "p50_candidates"), point(0.9, "p90_candidates"),
        point(0.95, "p95_candidates"), point(0.99, "p99_candidates"),
        F.max("candidate_count").alias("max_candidates"),
    )


def shares_band(bands: int, rows: int) -> Column:
    same = [band_slice(F.col("sig_a"), b, rows) == band_slice(F.col("sig_b"), b, rows) for b in range(bands)]
    return reduce(lambda x, y: x | y, same)


def with_signatures(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs with both signatures; null where a document is too short to have one."""
    side = lambda s: sigs.select(F.col("doc_id").alias(f"id_{s}"), F.col("sig").alias(f"sig_{s}"))
    return pairs.join(side("a"), "id_a", "left").join(side("b"), "id_b", "left")


def survival(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """One row per pair and configuration: do the two share at least one bucket?

    Sharing a bucket is having an equal band, so the two signatures are compared and no bucket is built.
    """
    flags = F.array(*[
        F.struct(
            F.lit(name).alias("configuration"),
            F.coalesce(shares_band(*shape), F.lit(False)).alias("candidate_survived"),
        )
        for name, shape in CONFIGURATIONS.items()
    ])
    return with_signatures(pairs, sigs).select(*pairs.columns, F.inline(flags))


def _pct(condition: Column) -> Column:
    return F.round(F.avg(F.when(condition, F.col("candidate_survived").cast("int"))) * 100, 2)


def lsh_recall(survived: DataFrame) -> DataFrame:
    return survived.groupBy("configuration").agg(
        _pct(F.col("label") == "same").alias("same_pair_recall"),
        _pct(F.col("label") == "different").alias("different_pair_survival"),
    )


def label_summary(survived: DataFrame) -> DataFrame:
    flag = F.col("candidate_survived").cast("int")
    return survived.groupBy("configuration", "label").agg(
        F.count("*").alias("count"), F.sum(flag).alias("sum"), F.round(F.avg(flag), 4).alias("mean")
    )


def config_summary(sizes: DataFrame, counts: DataFrame, survived: DataFrame) -> DataFrame:
    """One row per banding: shape, buckets, candidate distribution, recall and survival."""
    shapes = F.create_map(*[
        F.lit(v) for name, (b, r) in CONFIGURATIONS.items() for v in (name, f"{b}|{r}")
    ])
    shape = F.split(shapes[F.col("configuration")], r"\|")
    buckets = sizes.groupBy("configuration").agg(F.count("*").alias("buckets"))
    return (
        candidate_distribution(counts)
        .join(buckets, "configuration", "left")
        .join(lsh_recall(survived), "configuration", "left")
        .select(
            "configuration", shape[0].cast("int").alias("bands"), shape[1].cast("int").alias("rows"),
            F.coalesce("buckets", F.lit(0)).alias("buckets"),
            "mean_candidates", "p50_candidates", "p90_candidates", "p95_candidates", "p99_candidates",
            "max_candidates", "same_pair_recall", "different_pair_survival",
        )
    )


def shared_bands(bands: int, rows: int) -> Column:
    """Array of (band, bucket_hash) in which sig_a and sig_b agree."""
    return F.array_compact(F.array(*[
        F.when(
            band_slice(F.col("sig_a"), b, rows) == band_slice(F.col("sig_b"), b, rows),
            F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), band_slice(F.col("sig_a"), b, rows)).alias("bucket_hash")),
        )
        for b in range(bands)
    ]))


def cap_sweep(pairs: DataFrame, sigs: DataFrame, caps: tuple[int, ...] = CAPS, bands: int = 32, rows: int = 4) -> DataFrame:
    """Retrieved pairs per bucket cap and label: a pair needs one shared bucket no larger than the cap."""
    keyed = with_signatures(pairs, sigs).select(*pairs.columns, F.inline_outer(shared_bands(bands, rows)))
    sizes = bucket_sizes(lsh_buckets(sigs, bands, rows))
    smallest = (
        keyed.join(sizes, list(BUCKET), "left")
        .groupBy(*pairs.columns)
        .agg(F.min("bucket_size").alias("smallest"))
    )
    totals = smallest.groupBy("label").agg(
        F.count("*").alias("total"),
        *[F.count(F.when(F.col("smallest") <= cap, 1)).alias(f"cap_{cap}") for cap in caps],
    )
    rows_ = F.array(*[F.struct(F.lit(cap).alias("cap"), F.col(f"cap_{cap}").alias("retrieved")) for cap in caps])
    return totals.select("label", "total", F.inline(rows_)).select(
        "cap", "label", "retrieved", "total",
        F.round(F.col("retrieved") / F.col("total"), 4).alias("share"),
    )
