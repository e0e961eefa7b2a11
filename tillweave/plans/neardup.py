"""Near-duplicate job: sets and signatures, buckets, candidates, scores, matches, clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.functions.text import normalize_text
from tillweave.operators import clusters, evaluation, lsh, minhash, overflow, portals, preambles, shingles
from tillweave.operators.joins import insert_if_absent, upsert
from tillweave.plans import neardup_inputs as inputs
from tillweave.session import stage, tune, write_through

FILTER_SHARE = 0.1


class NearDup:
    """Tables of the job; stage tables are written once per application and read by what follows."""

    def __init__(self, spark: SparkSession, sf_dir: str, boilerplate_share: float | None = None, parallelism: int | None = None):
        """With ``boilerplate_share`` the job runs on texts without their portal's common lines.

        With ``parallelism`` the texts are dealt to so many tasks as they are read, for tables of few row groups.
        """
        self.spark, self.sf_dir, self.share, self.parallelism = tune(spark), sf_dir, boilerplate_share, parallelism

    def _stage(self, name, make) -> DataFrame:
        suffix = "" if self.share is None else f"_filtered_{self.share}"
        return stage(self.spark, self.sf_dir, name + suffix, make)

    def docs(self) -> DataFrame:
        docs = inputs.documents(self.spark, self.sf_dir, self.parallelism)
        if self.share is None:
            return docs
        return self._stage("documents", lambda: portals.boilerplate_filter(docs, self.share).select(
            "doc_id", "portal", F.col("filtered").alias("text"), F.col("doc_id").alias("published_at")
        ))

    def notices(self) -> DataFrame:
        """The documents with the dates, amounts, references and links that notices carry."""
        return inputs.notices(self.docs())

    def sets(self) -> DataFrame:
        return self._stage("shingle_sets", lambda: shingles.shingle_sets(self.docs(), "word5"))

    def texts(self) -> DataFrame:
        return self._stage("normal_texts", lambda: shingles.normal_texts(self.docs()))

    def pairs(self) -> DataFrame:
        return self._stage("labelled_pairs", lambda: inputs.labelled_pairs(self.docs()))

    def endpoints(self) -> DataFrame:
        return shingles.only_endpoints(self.docs(), self.pairs())

    def signatures(self) -> DataFrame:
        return self._stage("signatures", lambda: minhash.signatures(self.docs()))

    def similarity(self) -> DataFrame:
        """Labelled pairs with the three exact measures."""
        return self._stage("pair_similarity", lambda: shingles.text_jaccard(
            self.pairs(), self.texts(), {m: f"{m}_jaccard" for m in shingles.SETS}))

    def exact(self) -> DataFrame:
        return self._stage("exact", lambda: shingles.text_jaccard(self.pairs(), self.texts(), {"word5": "jaccard"}))

    def errors(self) -> DataFrame:
        def make() -> DataFrame:
            sigs = write_through(minhash.signatures(self.endpoints(), max(evaluation.ESTIMATE_SIZES)), "pair_signatures")
            estimated = minhash.minhash_estimate(self.exact(), sigs, evaluation.ESTIMATE_SIZES)
            return evaluation.estimate_errors(estimated)
        return self._stage("estimate_errors", make)

    def buckets(self) -> DataFrame:
        return lsh.lsh_buckets(self.signatures())

    def all_buckets(self) -> DataFrame:
        return lsh.buckets_of_all(self.signatures())

    def sizes(self) -> DataFrame:
        return lsh.bucket_sizes(self.all_buckets())

    def counts(self) -> DataFrame:
        ids = self.docs().select("doc_id", "portal")
        return self._stage("candidate_counts", lambda: lsh.candidate_counts(self.all_buckets(), ids))

    def survived(self) -> DataFrame:
        return self._stage("survival", lambda: lsh.survival(self.exact(), self.signatures()))

    def candidates(self) -> DataFrame:
        return self._stage("candidates", lambda: lsh.candidates(self.buckets()))

    def scored(self) -> DataFrame:
        return self._stage("scored", lambda: shingles.pair_jaccard(self.candidates(), self.sets()))

    def contents(self) -> DataFrame:
        return self._stage("contents", lambda: overflow.content_groups(self.docs(), self.sets()))

    def links(self, threshold: float = evaluation.MATCH_THRESHOLD, cap: int = lsh.CAP) -> DataFrame:
        """Pairs of different contents at or above ``threshold`` with no bucket left out.

        Buckets up to ``cap`` are paired, larger ones are searched by rare shingles; the cap only decides which way is taken.
        """
        copies = self.contents().where("doc_id <> rep")
        sigs = self.signatures().join(copies, "doc_id", "left_anti")
        buckets = lsh.lsh_buckets(sigs)
        paired = shingles.pair_jaccard(lsh.candidates(buckets, cap), self.sets()).where(F.col("jaccard") >= threshold)
        searched = overflow.crowded_matches(buckets, self.sets(), sigs, threshold, cap)
        return paired.unionByName(searched).distinct()

    def matches(self) -> DataFrame:
        return self._stage("matches", self.links)

    def stars(self) -> DataFrame:
        """Clusters of the match graph; copies follow the first document of their content."""
        return self._stage("stars", self.make_stars)

    def make_stars(self, in_one_task: int = clusters.COMPONENT_EDGES) -> DataFrame:
        copies = self.contents().where("doc_id <> rep")
        docs = self.docs().select("doc_id", "published_at").join(copies, "doc_id", "left_anti")
        return overflow.with_copies(clusters.star_clusters(docs, self.matches(), in_one_task), copies)


def normalized(n: NearDup, strip_www: bool = False) -> DataFrame:
    return n.notices().select("doc_id", normalize_text(F.col("text"), strip_www).alias("normalized"))


def lsh_buckets(n: NearDup) -> DataFrame:
    """Buckets shared by at least two documents, named by their first document."""
    sized = n.buckets().groupBy("band", "bucket_hash").agg(
        F.min("doc_id").alias("first_doc"), F.count("*").alias("bucket_size")
    )
    return sized.where("bucket_size > 1").select("band", "first_doc", "bucket_size")


def signature_upsert(n: NearDup) -> DataFrame:
    """A stored table with outdated values for every third document, brought up to date."""
    current = minhash.signature_long(n.signatures())
    stored = current.where("doc_id % 3 = 0").withColumn("hash_value", F.col("hash_value") + 1)
    return upsert(current, stored, ["doc_id", "hash_position"])


def insert_matches(n: NearDup) -> DataFrame:
    """Load matches into a table that already holds every pair of an even first document."""
    loaded = n.matches().where("id_a % 2 = 0").withColumn("jaccard", F.lit(0.0))
    return insert_if_absent(n.matches(), loaded, ["id_a", "id_b"])


def boilerplate(n: NearDup) -> DataFrame:
    cleaned = portals.boilerplate_filter(n.docs(), FILTER_SHARE)
    return cleaned.select("doc_id", "portal", F.md5("filtered").alias("filtered_md5"), "removed")


def preambles_cut(n: NearDup) -> DataFrame:
    cut = preambles.preamble_filter(inputs.aggregated(n.docs()), FILTER_SHARE)
    return cut.select("doc_id", "portal", F.md5("filtered").alias("filtered_md5"), "head_words", "tail_words")


def corrigendum_links(n: NearDup) -> DataFrame:
    """Corrections among the notices, with their references, and what they correct."""
    notices = n.notices()
    flags = portals.corrigendum_flag(notices).select("doc_id", (F.col("in_title") | F.col("in_body")).alias("flag"))
    named = portals.parsed_fields(notices).select("doc_id", "portal", "reference")
    rows = write_through(notices.select("doc_id", "published_at").join(flags, "doc_id").join(named, "doc_id"), "notice_references")
    return portals.corrigendum_links(n.matches(), rows)


def filtered(n: NearDup) -> NearDup:
    return NearDup(n.spark, n.sf_dir, FILTER_SHARE, n.parallelism)


def filtered_eval(n: NearDup) -> DataFrame:
    """Thresholds against the labels of the raw texts, scored on filtered texts with ``www`` links removed."""
    f = filtered(n)
    sets = write_through(shingles.shingle_sets(f.docs(), "word5", strip_www=True), "www_sets")
    scored = shingles.pair_jaccard(n.pairs(), sets)
    return evaluation.threshold_eval(scored)


def stable_mapping(n: NearDup) -> DataFrame:
    """Mapping when every tenth document already has an id from an earlier run."""
    prior = n.docs().where("doc_id % 10 = 0").select(
        "doc_id", F.concat(F.lit("old-"), F.col("doc_id").cast("string")).alias("cluster_id")
    )
    return clusters.stable_mapping(n.stars(), prior)


QUERIES = {
    "normalize_text": normalized,
    "normalize_text_www": lambda n: normalized(n, True),
    "word_tokens": lambda n: shingles.word_tokens(n.docs()),
    "word_ngrams": lambda n: shingles.word_ngrams(n.docs(), 5),
    "char_ngrams": lambda n: shingles.char_ngram_range(n.docs(), 5),
    "shingle_hash": lambda n: shingles.word_ngrams(n.docs(), 5).select(
        "doc_id", "shingle", minhash.shingle_hash(F.col("shingle")).alias("hash")
    ),
    "label_counts": lambda n: evaluation.label_counts(n.pairs()),
    "pair_endpoints": lambda n: shingles.pair_endpoints(n.pairs()),
    "pair_jaccard": lambda n: n.exact(),
    "pair_similarity": lambda n: n.similarity(),
    "similarity_summary": lambda n: evaluation.similarity_summary(n.similarity()),
    "pair_extremes": lambda n: evaluation.pair_extremes(n.similarity()),
    "minhash_signature": lambda n: n.signatures().select(
        "doc_id", F.md5(F.array_join(F.transform("sig", lambda v: v.cast("string")), ",")).alias("signature_md5")
    ),
    "signature_long": lambda n: minhash.signature_long(n.signatures()),
    "signature_upsert": signature_upsert,
    "minhash_estimate": lambda n: n.errors().select("id_a", "id_b", "signature_size", "estimate"),
    "minhash_error": lambda n: evaluation.error_summary(n.errors()),
    "minhash_error_by_label": lambda n: evaluation.error_by_label(n.errors()),
    "minhash_worst": lambda n: evaluation.worst_errors(n.errors()),
    "lsh_buckets": lsh_buckets,
    "bucket_stats": lambda n: lsh.bucket_stats(n.sizes()),
    "candidate_counts": lambda n: n.counts(),
    "candidate_distribution": lambda n: lsh.candidate_distribution(n.counts()),
    "lsh_recall": lambda n: lsh.lsh_recall(n.survived()),
    "lsh_label_summary": lambda n: lsh.label_summary(n.survived()),
    "survival_by_bin": lambda n: evaluation.survival_by_bin(n.survived()),
    "survival_curve": lambda n: evaluation.survival_curve(evaluation.survival_by_bin(n.survived())),
    "lsh_config_summary": lambda n: lsh.config_summary(n.sizes(), n.counts(), n.survived()),
    "bucket_cap_sweep": lambda n: lsh.cap_sweep(n.pairs(), n.signatures()),
    "lsh_candidates": lambda n: n.candidates(),
    "scored_candidates": lambda n: n.scored(),
    "threshold_counts": lambda n: evaluation.threshold_counts(n.links(min(evaluation.SCORE_THRESHOLDS))),
    "threshold_eval": lambda n: evaluation.threshold_eval(n.exact()),
    "threshold_cost": lambda n: evaluation.cheapest_threshold(
        evaluation.cost_curve(evaluation.threshold_eval(n.exact()))
    ),
    "match_pairs": lambda n: n.matches(),
    "insert_if_absent": insert_matches,
    "star_clusters": lambda n: n.stars(),
    "content_copies": lambda n: n.contents().where("doc_id <> rep"),
    "uncapped_matches": lambda n: n.links(cap=1),  # every bucket searched by rare shingles
    "uncapped_clusters": lambda n: n.make_stars(in_one_task=0),  # every component decided in rounds
    "match_pairs_filtered": lambda n: filtered(n).matches(),
    "threshold_eval_filtered": filtered_eval,
    "stable_mapping": stable_mapping,
    "cluster_table": lambda n: clusters.cluster_table(stable_mapping(n)),
    "cluster_summary": lambda n: clusters.cluster_summary(stable_mapping(n)),
    "portal_volume": lambda n: portals.portal_volume(n.docs()),
    "boilerplate_filter": boilerplate,
    "corrigendum_flag": lambda n: portals.corrigendum_flag(n.notices()),
    "corrigendum_links": corrigendum_links,
    "portal_field_parse": lambda n: portals.parse_coverage(portals.parsed_fields(n.notices())),
    "portal_profile": lambda n: portals.portal_profile(inputs.truncated(n.docs())),
    "length_spikes": lambda n: portals.length_spikes(inputs.truncated(n.docs())),
    "preamble_filter": preambles_cut,
}
