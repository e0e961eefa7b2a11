"""Publisher habits: volume, boilerplate, corrigenda, truncation, date and money texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.session import write_through

# Date forms and their patterns, money forms, reference families.
DATE_FORMS = {
    "d-M-yyyy": r"\b(\d{1,2}-\d{1,2}-\d{4})\b",
    "d/M/yyyy": r"\b(\d{1,2}/\d{1,2}/\d{4})\b",
    "d.M.yyyy": r"\b(\d{1,2}\.\d{1,2}\.\d{4})\b",
    "yyyy-M-d": r"\b(\d{4}-\d{1,2}-\d{1,2})\b",
    "d MMM yyyy": r"\b(\d{1,2} [A-Z][A-Za-z]{2} \d{4})\b",
    "MMM d, yyyy": r"\b([A-Z][A-Za-z]{2} \d{1,2}, \d{4})\b",
    "d-MMM-yy": r"\b(\d{1,2}-[A-Z][A-Za-z]{2}-\d{2})\b",
}
# A bare number of seven to twelve digits is an amount, unless it starts with 0: then, with eight digits, it is a reference.
MONEY = r"(?i)(?:rs\.?|inr|rupees)\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*(lakh|cr)?|\b([1-9][0-9]{6,11})\b"
UNITS = {"lakh": 100000, "cr": 10000000}
REFERENCE = (
    r"\b(NPAS-\d{4}-\d{7}|SPC/\d{4}-\d{2}/\d{6}|PWD/\d{4}/\d{5}|ref-\d{4}-\d{5}|"
    r"MC/\d{4}/W/\d{5}|TN-\d{6}/\d{4}|0\d{7})\b"
)
CORRIGENDUM = r"(?i)corrigend(um|a)"

# What makes a spike in a portal's lengths: texts of that length, how far its neighbourhood reaches, how much it stands out.
SPIKE_DOCS = 3
SPIKE_REACH = 50
SPIKE_FACTOR = 20

# A line is a portal's boilerplate only if at least so many different contents of the portal have it.
MIN_CONTENTS = 3


def portal_volume(docs: DataFrame, n: int = 15) -> DataFrame:
    counts = docs.groupBy("portal").agg(F.count("*").alias("docs"))
    return counts.orderBy(F.desc("docs"), "portal").limit(n)


def segments(text: Column) -> Column:
    return F.array_remove(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.trim(line)), "")


def boilerplate_filter(docs: DataFrame, share: float = 0.3, least: int = MIN_CONTENTS) -> DataFrame:
    """Drop lines that at least ``share`` of a portal's different contents contain, and at least ``least`` of them.

    Re-posts of one content count once, so a portal of few documents keeps its lines; a text that would lose every line
    stays as it is. Adds filtered and removed to (doc_id, portal, text). Only 64-bit hashes are shuffled; the text stays where it
    was read. A portal has at most mean-lines / share such lines, so the list that travels to its documents is short whatever the
    number of documents. The lists are written first: the planner then knows their size when it decides whether to broadcast them.
    """
    lines = segments(F.col("text"))
    cut = docs.select("doc_id", "portal", F.explode(F.array(lines)).alias("lines"))
    hashed = cut.select(
        "portal", F.xxhash64("lines").alias("content"),
        F.explode(F.array_distinct(F.transform("lines", lambda line: F.xxhash64(line)))).alias("line"),
    )
    per_line = hashed.groupBy("portal", "line").agg(F.countDistinct("content").alias("contents"))
    per_portal = cut.groupBy("portal").agg(F.countDistinct(F.xxhash64("lines")).alias("portal_contents"))
    common = write_through(
        per_line.join(per_portal, "portal")
        .where(F.col("contents") >= F.greatest(F.lit(least), F.col("portal_contents") * share))
        .groupBy("portal")
        .agg(F.collect_list("line").alias("common")), "common_lines"
    )
    kept = F.filter("lines", lambda line: ~F.array_contains("common", F.xxhash64(line)))
    return (
        cut.join(common, "portal", "left")
        .withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))
        .select("doc_id", "portal", "lines", F.explode(F.array(kept)).alias("kept"))
        .withColumn("kept", F.when(F.size("kept") > 0, F.col("kept")).otherwise(F.col("lines")))
        .select(
            "doc_id", "portal", F.array_join("kept", "\n").alias("filtered"),
            (F.size("lines") - F.size("kept")).alias("removed"),
        )
    )


def corrigendum_flag(docs: DataFrame) -> DataFrame:
    """(doc_id, in_title, in_body): the first line stands for the title where there is none."""
    title = F.col("title") if "title" in docs.columns else F.split_part("text", F.lit("\n"), F.lit(1))
    return docs.select(
        "doc_id", F.coalesce(title.rlike(CORRIGENDUM), F.lit(False)).alias("in_title"),
        F.coalesce(F.col("text").rlike(CORRIGENDUM), F.lit(False)).alias("in_body"),
    )


def corrigendum_links(matches: DataFrame, notices: DataFrame) -> DataFrame:
    """(correction, original, by_reference, by_match): every corrigendum with the notice that it most likely corrects.

    ``notices`` has (doc_id, portal, published_at, reference, flag). The original is the nearest earlier notice, by time and then
    by id, that is no corrigendum itself and has the same reference number on the same portal or matches in text. Both ways are
    as-of lookups: a running last value along a reference, a maximum over the matches, so no pairs of notices are made beyond the matches.
    """
    time = F.struct("published_at", "doc_id")
    plain = F.when(~F.col("flag"), time)
    before = Window.partitionBy("portal", "reference").orderBy("published_at", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    named = notices.where("reference IS NOT NULL").select(
        "doc_id", "flag", F.last(plain, ignorenulls=True).over(before).alias("named")).where("flag AND named IS NOT NULL")
    side = lambda name: notices.select(F.col("doc_id").alias(name), F.col("flag").alias(f"{name}_flag"), time.alias(f"{name}_time"))
    both = matches.select(F.inline(F.array(
        F.struct(F.col("id_a").alias("later"), F.col("id_b").alias("earlier")),
        F.struct(F.col("id_b").alias("later"), F.col("id_a").alias("earlier")))))
    alike = (
        both.join(side("later"), "later").join(side("earlier"), "earlier")
        .where("later_flag AND NOT earlier_flag AND earlier_time < later_time")
        .groupBy(F.col("later").alias("doc_id")).agg(F.max("earlier_time").alias("alike"))
    )
    joined = named.select("doc_id", "named").join(alike, "doc_id", "full_outer")
    original = F.greatest("named", "alike")  # the null of a missing way is skipped
    return joined.select(
        F.col("doc_id").alias("correction"), original["doc_id"].alias("original"),
        F.coalesce(F.col("named") == original, F.lit(False)).alias("by_reference"),
        F.coalesce(F.col("alike") == original, F.lit(False)).alias("by_match"))


def found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def date_of(token: Column) -> Column:
    """A date in any of the known forms."""
    named = F.regexp_extract(token, "[A-Z][A-Za-z]{2}", 0)  # months come as Mar or MAR
    token = F.when(named != "", F.replace(token, named, F.initcap(named))).otherwise(token)
    return F.coalesce(*[F.try_to_date(token, form) for form in DATE_FORMS])


def amount_of(token: Column) -> Column:
    """An amount in units of one; lakh and crore are scaled."""
    number = F.regexp_replace(F.regexp_extract(token, r"[0-9][0-9,]*(?:\.[0-9]+)?", 0), ",", "")
    unit = F.lower(found(token, "(?i)(lakh|cr)$"))
    scale = F.when(unit == "lakh", UNITS["lakh"]).when(unit == "cr", UNITS["cr"]).otherwise(1)
    return (number.try_cast("decimal(20,3)") * scale).cast("decimal(22,3)")


def parsed_fields(docs: DataFrame) -> DataFrame:
    """First date, amount and reference of every text: one scan of the text for each, parsed from what it finds."""
    any_date = "|".join(f"(?:{p})" for p in DATE_FORMS.values())
    tokens = F.struct(
        found(F.col("text"), any_date, 0).alias("date_text"), found(F.col("text"), MONEY, 0).alias("money_text"),
        found(F.col("text"), REFERENCE).alias("reference"),
    )
    cut = docs.select("doc_id", "portal", F.explode(F.array(tokens)).alias("t"))
    return cut.select(
        "doc_id", "portal", "t.date_text", date_of(F.col("t.date_text")).alias("date"),
        "t.money_text", amount_of(F.col("t.money_text")).alias("amount"), "t.reference",
    )


def parse_coverage(fields: DataFrame) -> DataFrame:
    """Per portal: how many texts look dated or priced, and how many of them parse."""
    n = lambda condition: F.count(F.when(condition, 1))
    return fields.groupBy("portal").agg(
        F.count("*").alias("docs"), F.count("date_text").alias("date_texts"),
        n(F.col("date").isNotNull()).alias("dates"), F.count("money_text").alias("money_texts"),
        n(F.col("amount").isNotNull()).alias("amounts"), n(F.col("reference").isNotNull()).alias("refs"),
    )


def length_histogram(docs: DataFrame) -> DataFrame:
    return docs.groupBy("portal", F.length(F.coalesce("text", F.lit(""))).alias("length")).agg(F.count("*").alias("docs"))


def length_spikes(docs: DataFrame) -> DataFrame:
    """(portal, length, docs, around): lengths that stand out from the lengths near them, as cut texts do.

    A length is a spike if at least ``SPIKE_DOCS`` of the portal's texts have it, ``SPIKE_FACTOR`` times as many as an average length
    within ``SPIKE_REACH`` characters on either side (``around`` counts their texts), and twice as many as any of these. The windows run over
    the histogram, whose rows are lengths.
    """
    lengths = Window.partitionBy("portal").orderBy("length")
    side = lambda what, low, high: F.coalesce(what("docs").over(lengths.rangeBetween(low, high)), F.lit(0))
    both = lambda what: (side(what, -SPIKE_REACH, -1), side(what, 1, SPIKE_REACH))
    below, above = both(F.sum)
    near = length_histogram(docs).withColumns({"around": below + above, "highest": F.greatest(*both(F.max))})
    tall = (F.col("docs") >= SPIKE_DOCS) & (F.col("docs") * 2 * SPIKE_REACH >= F.col("around") * SPIKE_FACTOR)
    return near.where(tall & (F.col("docs") >= 2 * F.col("highest")) & (F.col("length") > 0)).drop("highest")


def portal_profile(docs: DataFrame) -> DataFrame:
    """Upper-case share, the length at which most texts are cut, if any, and the most frequent length."""
    one = docs.groupBy("portal").agg(
        F.count("*").alias("docs"), F.round(F.avg((F.col("text") == F.upper("text")).cast("int")), 6).alias("upper_share"))
    tallest = lambda lengths: lengths.groupBy("portal").agg(F.max(F.struct("docs", (-F.col("length")).alias("minus"))).alias("top"))
    named = lambda lengths, name: tallest(lengths).select(
        "portal", (-F.col("top.minus")).alias(f"{name}_length"), F.col("top.docs").alias(f"{name}_docs"))
    return one.join(named(length_spikes(docs), "cut"), "portal", "left").join(named(length_histogram(docs), "mode"), "portal")
