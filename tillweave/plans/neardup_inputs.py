"""Document inputs derived from the driver tables: documents are the notices, source is the portal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.plans.retail_inputs import table

LONG_LINE = 80


def documents(spark: SparkSession, sf_dir: str, parallelism: int | None = None) -> DataFrame:
    """(doc_id, portal, text, published_at); the id stands for the time of publication."""
    return table(spark, sf_dir, "documents", parallelism).select(
        "doc_id", F.col("source").alias("portal"), "text", F.col("doc_id").alias("published_at")
    )


def notices(docs: DataFrame) -> DataFrame:
    """The documents with a last line as a notice has it: date, amount, reference, link and now and then a correction.

    Every form of the portals comes up, chosen by the id; one date of each form in eleven is no date, a seventh of the lines is in capitals.
    A correction has the reference number of the notice twenty ids before it.
    """
    n = F.col("doc_id")
    named = F.when((n % 9 == 0) & (n >= 20), n - 20).otherwise(n)
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(n, F.lit(366)).cast("int"))
    dated = lambda form: F.date_format(day, form)
    date = F.element_at(F.array(*[dated(f) for f in ("dd-MM-yyyy", "dd/MM/yyyy", "dd.MM.yyyy", "yyyy-MM-dd", "dd MMM yyyy", "MMM dd, yyyy", "dd-MMM-yy")]),
                        (n % 7 + 1).cast("int"))
    date = F.when(n % 11 == 0, "41-13-2024").otherwise(date)
    digits = lambda width: F.lpad(n.cast("string"), width, "0")
    money = F.element_at(F.array(
        F.concat(F.lit("Rs. 4,50,"), digits(3), F.lit("/-")), F.concat(F.lit("Rs. "), n.cast("string"), F.lit(".50 lakh")),
        F.concat(F.lit("INR 4."), digits(3), F.lit(" Cr")), F.concat(F.lit("4"), digits(7)), F.lit("no amount")), (n % 5 + 1).cast("int"))
    number = lambda width: F.lpad(named.cast("string"), width, "0")
    reference = F.element_at(F.array(
        F.concat(F.lit("NPAS-2024-"), number(7)), F.concat(F.lit("SPC/2024-25/"), number(6)), F.concat(F.lit("PWD/2024/"), number(5)),
        F.concat(F.lit("0"), number(7)), F.concat(F.lit("ref-2024-"), number(5)), F.concat(F.lit("MC/2025/W/"), number(5)),
        F.concat(F.lit("TN-"), number(6), F.lit("/2024")), F.lit("none")), (named % 8 + 1).cast("int"))
    link = F.element_at(F.array(F.concat(F.lit("http://portal.example/"), n.cast("string")), F.concat(F.lit("www.portal.example/"), n.cast("string")), F.lit("no link")),
                        (n % 3 + 1).cast("int"))
    word = F.when(n % 9 == 0, "Corrigendum").otherwise("Notice")
    line = F.concat_ws(" ", word, F.lit("dated"), date, F.lit("value"), money, F.lit("no."), reference, F.lit("see"), link)
    line = F.when((n % 7 == 4) & (n % 2 == 0), F.upper(line)).otherwise(line)
    return docs.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), line))


def aggregated(docs: DataFrame) -> DataFrame:
    """The documents as aggregators publish them: one run-on text, with a long preamble on portals 0 to 5 and a footer on three of these."""
    clauses = lambda word, count: " ".join(f"{word} {i} of the terms applies to this notice," for i in range(1, count + 1))
    number = F.regexp_extract("portal", r"(\d+)$", 1).try_cast("int")
    body = F.regexp_replace(F.coalesce("text", F.lit("")), r"\n", " ")
    head = F.when(number <= 5, F.concat(F.lit(clauses("Clause", 30) + " "), F.when(number <= 2, "National ").otherwise("State "))).otherwise("")
    tail = F.when(number.isin(1, 2, 5), F.lit(" " + clauses("Remark", 12))).otherwise("")
    return docs.withColumn("text", F.concat(F.coalesce(head, F.lit("")), body, F.coalesce(tail, F.lit(""))))


def truncated(docs: DataFrame) -> DataFrame:
    """The documents as two portals show them that cut long notices, each at a length of its own."""
    at = F.regexp_extract("portal", r"^src([67])$", 1).try_cast("int") * 100 + 30
    return docs.withColumn("text", F.when(at.isNotNull(), F.left("text", at)).otherwise(F.col("text")))


def labelled_pairs(docs: DataFrame) -> DataFrame:
    """(id_a, id_b, label), derived over all documents.

    same       a document and the first document that holds the same long line
    different  neighbours in id order, unless they are labelled same
    """
    line = F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")
    lines = docs.select("doc_id", line).select("doc_id", F.trim("line").alias("line"))
    keyed = lines.where(F.length("line") >= LONG_LINE).select("doc_id", F.md5("line").alias("line"))
    first = keyed.groupBy("line").agg(F.min("doc_id").alias("id_a"), F.count("*").alias("n")).where("n > 1")
    same = (
        keyed.join(first, "line").where("id_a < doc_id")
        .select("id_a", F.col("doc_id").alias("id_b")).distinct()
    )
    ids = docs.select("doc_id")
    following = ids.select((F.col("doc_id") + 1).alias("doc_id"), F.col("doc_id").alias("id_a"))
    neighbours = ids.join(following, "doc_id").select("id_a", F.col("doc_id").alias("id_b"))
    different = neighbours.join(same, ["id_a", "id_b"], "left_anti")
    return same.withColumn("label", F.lit("same")).unionByName(different.withColumn("label", F.lit("different")))
