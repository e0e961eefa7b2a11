"""Notice files and labelled pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillweave.session import write_through

# Columns of the notice files.
NOTICE_COLUMNS = ("notice_id", "portal_id", "title", "body", "estimated_value", "closing_date", "published_at")
MOST_COLUMNS = 16  # cells of a record that are read
PAIR_SCHEMA = "notice_id_a string, notice_id_b string, label string"


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """(file, start, record): the records of all CSV files, which may hold line breaks between quotes.

    Files are read by lines, so a large one is read by many tasks. A line starts a record if the number of quotes before it in its file is
    even: those of the blocks before are prefix sums over one row a block, those within the block a running sum. Lines between two starts are one
    record, also across blocks. (A doubled quote counts twice and changes nothing.)
    """
    read = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.csv").text(folder)
    lines = read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("bigint").alias("quotes"))
    lines = write_through(lines, "notice_lines")
    before = lambda what, *by: F.coalesce(F.sum(what).over(
        Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("in_block"))
    blocks = blocks.select("file", "block", before("in_block", "file", "block").alias("before"))
    inside = lines.withColumn("within", before("quotes", "file", "block", "line")).join(blocks, ["file", "block"])
    begun = F.when((F.col("before") + F.col("within")) % 2 == 0, F.struct("block", "line"))
    upto = Window.partitionBy("file", "block").orderBy("line")
    marked = write_through(inside.select("file", "block", "line", "value", F.last(begun, ignorenulls=True).over(upto).alias("start")), "notice_starts")
    # The first lines of a block may belong to the last record of a block before.
    ends = marked.groupBy("file", "block").agg(F.max("start").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("file", "block", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    owned = marked.join(ends, ["file", "block"]).withColumn("start", F.coalesce("start", "carried"))
    listed = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    records = owned.groupBy("file", "start").agg(F.array_join(F.transform(listed, lambda row: row["value"]), "\n").alias("record"))
    whole = F.regexp_replace("record", "^\ufeff|\r$", "")
    return records.select("file", "start", whole.alias("record")).where("record <> ''")


def read_notices(spark: SparkSession, folder: str, columns: tuple[str, ...] = NOTICE_COLUMNS) -> DataFrame:
    """All CSV files of a folder as one table, with the wanted columns only.

    Bodies hold line breaks and doubled quotes. Every file is read under its own header, whatever the order of its columns; a column that
    a file does not have is null. Values stay text except the estimate and the time of publication.
    """
    names = [f"c{i}" for i in range(MOST_COLUMNS)]
    cells = F.from_csv("record", ", ".join(f"{name} string" for name in names), {"escape": '"', "mode": "PERMISSIVE"})
    records = write_through(_records(spark, folder).select("file", "start", F.array(*[cells[name] for name in names]).alias("cells")), "notice_records")
    headers = records.groupBy("file").agg(F.min_by("cells", "start").alias("names"), F.min("start").alias("start"))
    named = headers.select("file", "start", F.transform("names", lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))).alias("names"))
    data = records.join(named.select("file", "names"), "file").join(named.select("file", "start"), ["file", "start"], "left_anti")
    cell = lambda column: F.try_element_at("cells", F.nullif(F.array_position("names", column), F.lit(0)).cast("int"))
    typed = {"estimated_value": "double", "published_at": "timestamp_ntz"}
    return data.select(*[cell(c).try_cast(typed.get(c, "string")).alias(c) for c in columns])


def as_documents(notices: DataFrame) -> DataFrame:
    """(doc_id, portal, title, text, published_at) with title and body as one text; nulls count as ''."""
    return notices.select(
        F.col("notice_id").alias("doc_id"), F.col("portal_id").alias("portal"), "title",
        F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit(""))).alias("text"), "published_at",
    )


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(PAIR_SCHEMA).option("header", "true").option("enforceSchema", "false").csv(path)
    return rows.withColumnsRenamed({"notice_id_a": "id_a", "notice_id_b": "id_b"})
