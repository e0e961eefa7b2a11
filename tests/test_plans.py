import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracles import neardup_sql, retail_sql
from tillweave.operators.joins import join_valid
from tillweave.operators.lines import dedup_lines
from tillweave.plans import file_side, neardup, retail
from tillweave.plans.retail import Retail
from tillweave.sources.tables import plan_text

SMALL = "/root/testdata/sf0.001"
# Queries outside the training-data subpackage, whose queries have tests of their own.
OWN = {name: query for name, query in entry.queries().items() if name in {**retail.QUERIES, **neardup.QUERIES, **file_side.QUERIES}}


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_text(query(spark, SMALL)) for name, query in OWN.items()}


def test_no_query_multiplies_tables_or_runs_python_row_by_row(plans):
    for name, plan in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in plan, name


def test_every_query_has_its_sql():
    assert set(OWN) == {**retail_sql.SQL, **neardup_sql.SQL}.keys() and set(OWN) <= set(entry.oracle_sql())


def test_dedup_limits_each_key_before_the_exchange(spark):
    plan = plan_text(dedup_lines(Retail(spark, SMALL).raw()))
    assert plan.count("WindowGroupLimit") >= 4  # twice in the tree, twice in the details


def test_lines_are_read_in_small_splits(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    Retail(spark, SMALL)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_date_range_reaches_the_scan(spark):
    plan = plan_text(Retail(spark, SMALL).fact().where("business_date >= date'1998-07-01' and line_type = 'SALE'").select("revenue"))
    assert "GreaterThanOrEqual(business_date" in plan and "EqualTo(line_type,SALE)" in plan
    assert "ReadSchema: struct<business_date:date,line_type:string,revenue:decimal(18,5)>" in plan


def test_text_columns_are_pruned(plans):
    assert "html" not in plans["portal_volume"] and "text:string" not in plans["portal_volume"]


def test_hot_product_code_is_split_in_the_validity_join(spark):
    """A third of the lines carry one code and no side is small enough to broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        lines = spark.range(0, 300000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 5000).cast("string"))).alias("product_code"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("business_date"), "id",
        )
        codes = spark.range(5000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("product_code")).union(
            spark.sql("select 'hot'")
        ).selectExpr("product_code", "date'2020-01-01' as lo", "date'2030-01-01' as hi", "1 as one")
        joined = join_valid(lines, codes, "product_code", "business_date", "lo", "hi")
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == 300000
        out = io.StringIO()
        joined.cache().count()
        with redirect_stdout(out):
            joined.explain("formatted")
        assert "skew=true" in joined._jdf.queryExecution().toString() or "skew=true" in out.getvalue()
        joined.unpersist()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
