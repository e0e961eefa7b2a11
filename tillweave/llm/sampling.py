"""MinHash near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its five-word shingles; a text of one to four words has one shingle, all of it. A shingle weighs
its count times 1 + idf, where the idf of a shingle is that of its rarest word, ln(documents / documents with the word) over
ln(1 / ``RARE``), at most 1. The plain part of the weight keeps the copies of a very frequent text together. Words rarer than that need not be told apart, so only words in at least ``RARE`` of all documents are looked
up, and there can be no more of those than the words of an average document over ``RARE``.

Two texts agree in a consistent weighted sample with a probability equal to their weighted Jaccard similarity. ``BANDS`` bands of
``ROWS`` samples retrieve a pair of similarity 0.8 with probability 0.9998, and the exact weighted Jaccard similarity, at least
``SIMILAR``, decides. Texts with equal weighted sets are one member; their copies never meet in a bucket.

In a bucket every member is compared with its head, the member that meets most others in all its buckets. First each member is
compared with its best head, then with its other heads unless links have joined the two already, and last, in pairs of blocks, with
those members of its buckets that are in other classes by then. So no bucket is capped, n similar texts cost about n
comparisons, and a link is only left out between texts that are in one class without it. Texts that share buckets but stay unlinked
(similarity just below ``SIMILAR``) are all compared with each other. Classes are the connected components of the links.

Sets travel only where a link is possible. The shingles of a set are dealt by hash to about half as many bins as it has shingles;
the bins' total weights are its *profile*, and the sum of the smaller of two bins bounds the weight that two sets share, so a pair whose
bound is below ``SIMILAR`` has no link. The bound is exact: it never leaves out a pair. Texts are shuffled to make these sets only if a
bitmap of ``MARKS`` hashed ids says that their document may share a bucket.

Defined results: a null text or one without words is a class of its own. Repeated rows of one doc_id and text fall together;
of a doc_id with different texts every row gets the smallest class. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import frames, graph, kernels

SIMILAR = 0.8
BANDS, ROWS = 12, 3
RARE = 1e-3
# Words of one block of documents whose counts are summed before they are shuffled.
BLOCK_WORDS = 2_000_000
SHINGLE_WORDS = 5
BLOCK = 256  # members of a block that is compared with another one at once
MARKS = 1 << 25  # bits that tell most documents without a partner apart before their texts are shuffled
U = np.uint64


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, docs): in how many documents each hashed word occurs, summed per block of documents before the shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            word, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, U), np.zeros(0, np.int64))
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

        for batch in batches:
            for hashes in kernels.document_words(batch["text"]):
                distinct = np.unique(hashes)
                held.append(distinct)
                size += len(distinct)
                if size >= BLOCK_WORDS:
                    yield flush()
        yield flush()

    found = docs.select("text").mapInArrow(kernels.lean(work), "word bigint, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("docs"))


def common_words(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(word hash ascending, idf) of the words in at least ``RARE`` of all documents; their number is bounded, see above."""
    total = docs.count()
    rows = word_counts(docs).where(F.col("docs") >= total * RARE).collect()
    word = np.array([row["word"] for row in rows], dtype=np.int64).view(U)
    idf = np.log(total / np.array([row["docs"] for row in rows], dtype=float)) / -np.log(RARE) if rows else np.zeros(0)
    order = np.argsort(word)
    return word[order], idf[order]


def weighted_set(hashes: np.ndarray, words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingle ascending, weight) of one document's words."""
    n = min(SHINGLE_WORDS, len(hashes))
    if not n:
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.float32)
    rarity = np.ones(len(hashes))
    if len(words):
        at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        rarity = np.where(words[at] == hashes, idf[at], rarity)
    grams = kernels.shingles(hashes, n)
    rarest = rarity[: len(grams)]
    for i in range(1, n):
        rarest = np.maximum(rarest, rarity[i : i + len(grams)])
    order = np.argsort(grams)
    grams, rarest = grams[order], rarest[order]
    starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    count = np.diff(starts, append=len(grams))
    return grams[starts], (count * (1.0 + rarest[starts])).astype(np.float32)


class Sampler:
    """Consistent samples: for each of BANDS x ROWS draws the shingle and level that the weighted set selects."""

    def __init__(self):
        draws = kernels.stream(4 * 65536, 3).astype(float) / 2.0**64 + 2.0**-65
        u = draws.reshape(4, 65536)
        tables = np.random.default_rng(23)
        self.r = (-np.log(u[0]) - np.log(tables.random(65536) + 1e-12)).astype(np.float32)
        self.log_c = np.log(-np.log(u[1]) - np.log(u[2])).astype(np.float32)
        self.beta = u[3].astype(np.float32)
        self.seeds = kernels.stream(BANDS * ROWS, 29)
        self.low = U(0xFFFF)

    def __call__(self, grams: np.ndarray, weight: np.ndarray) -> np.ndarray:
        log_weight = np.log(weight)[None, :]
        picked = np.empty(len(self.seeds), dtype=U)
        for first in range(0, len(self.seeds), 6):  # a few draws at a time keep the work arrays in cache
            seeds = self.seeds[first : first + 6]
            bits = kernels.mix(grams[None, :] ^ seeds[:, None])
            r = self.r[(bits & self.low).astype(np.intp)]
            beta = self.beta[(bits >> U(16) & self.low).astype(np.intp)]
            log_c = self.log_c[(bits >> U(32) & self.low).astype(np.intp)]
            level = np.floor(log_weight / r + beta)
            best = (log_c - r * (level - beta + 1)).argmin(axis=1)
            own = np.arange(len(seeds))
            picked[first : first + 6] = grams[best] * U(0x9E3779B97F4A7C15) + level[own, best].astype(np.int64).view(U)
        return picked


def members(docs: DataFrame, words: np.ndarray, idf: np.ndarray) -> DataFrame:
    """(doc_id, k1, k2, total, bands): a 128-bit key of each weighted set, its total weight and its band keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        band_seeds = kernels.stream(BANDS, 31)
        for batch in batches:
            ids, first, second, totals, bands = [], [], [], [], []
            for doc_id, hashes in zip(batch["doc_id"].to_pylist(), kernels.document_words(batch["text"])):
                grams, weight = weighted_set(hashes, words, idf)
                if not len(grams):
                    continue
                level = weight.view(np.uint32).astype(U)
                ids.append(doc_id)
                first.append(int(kernels.mix(grams + level * U(0xD6E8FEB86659FD93)).sum().view(np.int64)))
                second.append(int(kernels.mix((grams ^ U(0x5851F42D4C957F2D)) + level * U(0xC2B2AE3D27D4EB4F)).sum().view(np.int64)))
                totals.append(float(weight.sum(dtype=np.float64)))
                picked = sampler(grams, weight).reshape(BANDS, ROWS)
                key = band_seeds.copy()
                for column in range(ROWS):
                    key = kernels.mix(key + picked[:, column])
                bands.append(key.view(np.int64))
            if ids:
                flat = np.concatenate(bands)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(totals),
                     pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32), flat)],
                    names=["doc_id", "k1", "k2", "total", "bands"])

    return docs.select("doc_id", "text").mapInArrow(
        kernels.lean(work), "doc_id bigint, k1 bigint, k2 bigint, total double, bands array<bigint>")


def profile(grams: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Total weight of each bin, rounded up; the number of bins is a power of two, and a bin's number the first bits of a hash."""
    bits = max(len(grams).bit_length() - 1, 1)
    bins = (kernels.mix(grams ^ U(0x94D049BB133111EB)) >> U(64 - bits)).astype(np.intp)
    total = np.bincount(bins, weights=weight, minlength=1 << bits)
    return np.nextafter(total.astype(np.float32), np.float32(np.inf), where=total > 0, out=np.zeros(1 << bits, np.float32))


def folded(profiles: np.ndarray, bins: int) -> np.ndarray:
    """Profiles (one a row) with neighbouring bins added up until ``bins`` are left."""
    return profiles.reshape(len(profiles), bins, -1).sum(axis=2, dtype=np.float64)


def hopeful(left: list[np.ndarray], right: list[np.ndarray], left_totals: np.ndarray, right_totals: np.ndarray) -> np.ndarray:
    """Matrix (right, left): whether the profiles allow a weighted Jaccard similarity of ``SIMILAR``."""
    found = np.zeros((len(right), len(left)), dtype=bool)
    sizes = [np.array([len(one) for one in side]) for side in (left, right)]
    for bins_left in np.unique(sizes[0]):
        lefts = np.flatnonzero(sizes[0] == bins_left)
        stacked = np.stack([left[i] for i in lefts])
        for bins_right in np.unique(sizes[1]):
            rights = np.flatnonzero(sizes[1] == bins_right)
            few = min(bins_left, bins_right)
            mine = folded(stacked, few)
            for i in rights:
                most = np.minimum(mine, folded(right[i][None, :], few)).sum(axis=1)
                found[i, lefts] = most >= (SIMILAR - 1e-6) * (left_totals[lefts] + right_totals[i] - most)
    return found


def weighted_sets(docs: DataFrame, words: np.ndarray, idf: np.ndarray) -> DataFrame:
    """(doc_id, grams, weights, profile) as packed arrays."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [weighted_set(hashes, words, idf) for hashes in kernels.document_words(batch["text"])]
            packed = lambda arrays: pa.array([one.tobytes() for one in arrays], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], packed(g for g, _ in found), packed(w for _, w in found), packed(profile(g, w) for g, w in found)],
                names=["doc_id", "grams", "weights", "profile"])

    return docs.select("doc_id", "text").mapInArrow(kernels.lean(work), "doc_id bigint, grams binary, weights binary, profile binary")


def marked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows (doc_id, text) of ``wanted`` ids and few others: those whose id has the hash of a wanted one, of ``MARKS``.

    The marks are a bitmap of fixed size, however many ids there are; the more, the more other rows stay.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)) + 1  # the first bitmap holds the numbers from 1
    chunks = wanted.groupBy(F.bitmap_bucket_number(place).alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    found = np.zeros(MARKS // 8, dtype=np.uint8)
    for row in chunks:
        bits = np.frombuffer(row["bits"], dtype=np.uint8)
        found[(row["chunk"] - 1) * 4096 :][: len(bits)] = bits[: MARKS // 8]
    marks = docs.sparkSession.sparkContext.broadcast(found)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch["mark"].to_numpy()
            keep = marks.value[at >> 3] >> (at & 7).astype(np.uint8) & 1
            yield batch.select(["doc_id", "text"]).filter(pa.array(keep.astype(bool)))

    return docs.select("doc_id", "text", (place - 1).alias("mark")).mapInArrow(kernels.lean(work), docs.select("doc_id", "text").schema)


def with_both(pairs: DataFrame, rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Rows (a, b) with the columns ``names`` of both, as name_a and name_b.

    A member that is compared with very many others would be one hot key, so its row is spread over as many salts
    as it has blocks of 64 comparisons.
    """
    times = pairs.groupBy("a").agg(F.ceil(F.count("*") / 64).cast("int").alias("salts"))
    left = rows.join(times.withColumnRenamed("a", "doc_id"), "doc_id").select(
        F.col("doc_id").alias("a"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        *[F.col(name).alias(f"{name}_a") for name in names])
    right = rows.select(F.col("doc_id").alias("b"), *[F.col(name).alias(f"{name}_b") for name in names])
    salted = pairs.join(times, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    return salted.join(right, "b").join(left, ["a", "salt"]).drop("salt")


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows (a, b) whose profiles allow a link."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[np.frombuffer(value.as_buffer(), np.float32) for value in batch[name]] for name in ("profile_a", "profile_b")]
            total = lambda one: np.array([one.sum(dtype=np.float64)])
            keep = [bool(hopeful([a], [b], total(a), total(b))[0, 0]) for a, b in zip(*sides)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return with_both(pairs.select("a", "b"), sets, ("profile",)).mapInArrow(kernels.lean(work), "a bigint, b bigint")


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similarity) for rows (a, b): exact weighted Jaccard."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            result = []
            columns = [batch[name] for name in ("grams_a", "weights_a", "grams_b", "weights_b")]
            for row in zip(*columns):
                grams_a, weight_a, grams_b, weight_b = (
                    np.frombuffer(value.as_buffer(), dtype=kind) for value, kind in zip(row, (U, np.float32) * 2))
                at = np.minimum(np.searchsorted(grams_a, grams_b), len(grams_a) - 1)
                same = grams_a[at] == grams_b
                both = np.minimum(weight_a[at[same]], weight_b[same]).sum(dtype=np.float64)
                either = weight_a.sum(dtype=np.float64) + weight_b.sum(dtype=np.float64) - both
                result.append(float(both / either))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(result, pa.float64())], names=["a", "b", "similarity"])

    return with_both(pairs.select("a", "b"), sets, ("grams", "weights")).mapInArrow(kernels.lean(work), "a bigint, b bigint, similarity double")


def with_heads(buckets: DataFrame) -> DataFrame:
    """(band, n, id, total, head, head_total, score): members of buckets of two or more, with the head of their bucket.

    The head meets the most members in all its buckets, the smallest id among equals; ``score`` is how many it meets.
    """
    shared = frames.store(buckets.groupBy("band").agg(F.count("*").alias("members")).where("members > 1"), "near-shared")
    inside = frames.store(buckets.join(shared, "band"), "near-inside")
    score = inside.groupBy("id").agg(F.sum("members").alias("score"))
    scored = inside.join(score, "id")
    heads = scored.groupBy("band").agg(F.max(F.struct("score", (-F.col("id")).alias("least"), "total")).alias("head"))
    return frames.store(scored.join(heads, "band").select(
        "band", "n", "id", "total", (-F.col("head.least")).alias("head"), F.col("head.total").alias("head_total"),
        F.col("head.score").alias("score")), "near-heads")


def rest_links(headed: DataFrame, classes: DataFrame, sets: DataFrame, bands: DataFrame) -> DataFrame:
    """(a, b) of different classes that share a bucket and are similar, where one is outside the class of the bucket's head.

    Members are dealt to blocks of about ``BLOCK`` by a hash, and each pair of blocks with members outside is one group: profiles travel once
    for each pair of blocks, then the sets of those members that have a possible partner in the group, and no row stands for a pair of members.
    Pairs that share several buckets are judged in the first.
    """
    own = classes.select(F.col("node").alias("id"), F.col("component").alias("own"))
    of_head = classes.select(F.col("node").alias("head"), F.col("component").alias("head_class"))
    placed = headed.join(own, "id", "left").join(of_head, "head", "left").select(
        "band", "n", "id", F.coalesce("own", "id").alias("own"),
        (F.coalesce("own", "id") != F.coalesce("head_class", "head")).alias("outside"))
    placed = frames.store(placed, "near-placed")
    blocks = lambda c: F.ceil(F.sum(F.col(c).cast("int")) / BLOCK).cast("int")
    mixed = placed.withColumn("within", ~F.col("outside")).groupBy("band").agg(
        blocks("outside").alias("out_blocks"), blocks("within").alias("in_blocks")).where("out_blocks > 0")
    placed = placed.join(mixed, "band")
    dealt = lambda count: F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    upto = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    out = placed.where("outside").withColumn("block", dealt("out_blocks"))
    keys = ("band", "n", "id", "own")
    groups = (
        out.select(*keys, F.lit(True).alias("left"), F.lit(False).alias("crossed"), F.explode(upto("out_blocks")).alias("j"), "block")
        .select(*keys, "left", "crossed", F.least("block", "j").alias("first"), F.greatest("block", "j").alias("second"),
                (F.col("block") <= F.col("j")).alias("is_first"), (F.col("block") >= F.col("j")).alias("is_second"))
        .unionByName(out.where("in_blocks > 0").select(
            *keys, F.lit(True).alias("left"), F.lit(True).alias("crossed"), F.col("block").alias("first"),
            F.explode(upto("in_blocks")).alias("second"), F.lit(True).alias("is_first"), F.lit(False).alias("is_second")))
        .unionByName(placed.where("NOT outside").select(
            *keys, F.lit(False).alias("left"), F.lit(True).alias("crossed"), F.explode(upto("out_blocks")).alias("first"),
            dealt("in_blocks").alias("second"), F.lit(False).alias("is_first"), F.lit(True).alias("is_second")))
    )
    group = ("band", "crossed", "first", "second")
    flags = ("n", "id", "own", "is_first", "is_second")
    of_member = lambda *names: sets.select(F.col("doc_id").alias("id"), *names)

    def pairable(rows: dict[str, list], totals: np.ndarray, column: int) -> tuple[list[int], list[int], np.ndarray]:
        """Numbers of the left and right members, and a matrix (right, left) of the pairs to be judged here."""
        left = [i for i, flag in enumerate(rows["is_first"]) if flag]
        right = [i for i, flag in enumerate(rows["is_second"]) if flag]
        ids, own, shared = np.array(rows["id"]), np.array(rows["own"]), np.array(rows["bands"], dtype=np.int64)
        wanted = np.zeros((len(right), len(left)), dtype=bool)
        for place, i in enumerate(right if left else []):
            first = (shared[left] == shared[i]).argmax(axis=1) == column
            fits = np.minimum(totals[left], totals[i]) >= SIMILAR * np.maximum(totals[left], totals[i]) * (1 - 1e-6) - 1e-6
            wanted[place] = first & fits & (own[left] != own[i]) & (ids[left] != ids[i])
        return left, right, wanted

    def choose(table: pa.Table) -> pa.Table:
        """The members of a group that have a possible partner in it."""
        rows = {name: table[name].to_pylist() for name in ("id", "own", "is_first", "is_second", "profile", "bands")}
        profiles = [np.frombuffer(p, dtype=np.float32) for p in rows["profile"]]
        totals = np.array([p.sum(dtype=np.float64) for p in profiles])
        left, right, wanted = pairable(rows, totals, table["n"][0].as_py())
        keep = np.zeros(len(profiles), dtype=bool)
        if wanted.any():
            rights, lefts = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
            left, right = np.array(left)[lefts], np.array(right)[rights]
            pick = lambda numbers: ([profiles[i] for i in numbers], totals[numbers])
            (left_profiles, left_totals), (right_profiles, right_totals) = pick(left), pick(right)
            good = wanted[np.ix_(rights, lefts)] & hopeful(left_profiles, right_profiles, left_totals, right_totals)
            keep[left[good.any(axis=0)]] = True
            keep[right[good.any(axis=1)]] = True
        return table.select([*group, *flags]).filter(pa.array(keep))

    schema = "band bigint, crossed boolean, first int, second int, n int, id bigint, own bigint, is_first boolean, is_second boolean"
    outlined = groups.select(*group, *flags).join(of_member("profile"), "id").join(bands, "id")
    chosen = frames.store(outlined.groupBy(*group).applyInArrow(choose, schema), "near-chosen")
    full = chosen.join(of_member("grams", "weights"), "id").join(bands, "id")

    def compare(table: pa.Table) -> pa.Table:
        found_a, found_b = [], []
        rows = {name: table[name].to_pylist() for name in ("id", "own", "is_first", "is_second", "grams", "weights", "bands")}
        grams = [np.frombuffer(g, dtype=U) for g in rows["grams"]]
        weights = [np.frombuffer(w, dtype=np.float32).astype(np.float64) for w in rows["weights"]]
        totals = np.array([w.sum() for w in weights])
        left, right, judged = pairable(rows, totals, table["n"][0].as_py())
        if judged.any():
            ids = np.array(rows["id"])
            owner = np.repeat(np.arange(len(left)), [len(grams[i]) for i in left])
            pool = np.concatenate([grams[i] for i in left])
            order = np.argsort(pool, kind="stable")
            pool, owner = pool[order], owner[order]
            held = np.concatenate([weights[i] for i in left])[order]
            left_ids, left_totals = ids[left], totals[left]
            for i, wanted in zip(right, judged):
                if not wanted.any():
                    continue
                low, high = np.searchsorted(pool, grams[i], "left"), np.searchsorted(pool, grams[i], "right")
                size = high - low
                ends = np.cumsum(size)
                at = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(low, size)
                both = np.bincount(owner[at], weights=np.minimum(held[at], np.repeat(weights[i], size)), minlength=len(left))
                alike = both / (left_totals + totals[i] - both) >= SIMILAR - 1e-9
                for other in left_ids[wanted & alike].tolist():
                    found_a.append(min(other, int(ids[i])))
                    found_b.append(max(other, int(ids[i])))
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return full.groupBy(*group).applyInArrow(compare, "a bigint, b bigint").distinct()


def linked(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("similarity") >= SIMILAR - 1e-9).select("a", "b")


def member_links(buckets: DataFrame, bands: DataFrame, sets_of) -> DataFrame:
    """(node, component) over the members. ``sets_of`` makes the weighted sets of the members it is given."""
    headed = with_heads(buckets)
    sets = frames.store(sets_of(headed.select(F.col("id").alias("doc_id")).distinct()), "near-sets")
    fitting = F.least("total", "head_total") >= SIMILAR * F.greatest("total", "head_total") - 1e-6
    star = headed.where((F.col("id") != F.col("head")) & fitting).select(
        F.col("head").alias("a"), F.col("id").alias("b"), "score").distinct()
    star = frames.store(star, "near-star")
    best = star.groupBy("b").agg(F.max(F.struct("score", (-F.col("a")).alias("least"))).alias("best"))
    best = best.select((-F.col("best.least")).alias("a"), "b")
    first = frames.store(similarities(frames.store(possible(best, sets), "near-possible"), sets), "near-first")
    classes = graph.components(linked(first))
    of = lambda side: classes.select(F.col("node").alias(side), F.col("component").alias(f"class_{side}"))
    others = star.select("a", "b").join(best, ["a", "b"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left")
    others = frames.store(others.where(F.coalesce("class_a", "a") != F.coalesce("class_b", "b")).select("a", "b"), "near-others")
    others = frames.store(possible(others, sets), "near-possible")
    links = frames.store(linked(first.unionByName(similarities(others, sets))), "near-links")
    classes = graph.components(links)
    rest = frames.store(rest_links(headed, classes, sets, bands), "near-rest")
    return classes if rest.isEmpty() else graph.components(links.unionByName(rest))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, member_id): class and weighted-set representative of every document."""
    words, idf = common_words(docs)
    keyed = frames.store(members(docs, words, idf), "near-members")
    alike = keyed.groupBy("k1", "k2").agg(F.min("doc_id").alias("id"), F.max("total").alias("total"), F.first("bands").alias("bands"))
    alike = frames.store(alike, "near-alike")
    banded = alike.select("id", "total", F.posexplode("bands").alias("n", "key"))
    buckets = banded.select(F.xxhash64("n", "key").alias("band"), "n", "id", "total")

    def sets_of(wanted: DataFrame) -> DataFrame:
        wanted = frames.store(wanted, "near-wanted")
        # Stored, so that no task runs two Python processes at once: Spark would keep them all, each with its memory.
        texts = frames.store(marked(docs, wanted).join(wanted, "doc_id", "left_semi"), "near-texts")
        return weighted_sets(texts, words, idf)

    classes = member_links(buckets, alike.select("id", "bands"), sets_of)
    of_member = alike.select("k1", "k2", "id").join(classes.withColumnRenamed("node", "id"), "id", "left").select(
        "k1", "k2", F.col("id").alias("member_id"), F.coalesce("component", "id").alias("class_id"))
    found = keyed.select("doc_id", "k1", "k2").join(of_member, ["k1", "k2"]).select("doc_id", "class_id", "member_id")
    found = found.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.min("member_id").alias("member_id"))
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("member_id", "doc_id").alias("member_id"))


def op8_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(frames.table(spark, sf_dir, "documents").select("doc_id", "text"))
