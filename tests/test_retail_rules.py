from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import exports
from tillweave.functions.money import RULE_TYPES, revenue_expr
from tillweave.operators import calendar, lines as ln, products as pr, quality, reconcile, revenue
from tillweave.operators.joins import insert_if_absent, join_valid, upsert
from tillweave.sources.sales_files import normalise_lines


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("exports"))
    exports.write_exports(folder)
    kept = ln.dedup_lines(normalise_lines(spark, folder)[0]).cache()
    kept.count()
    return kept


def total(df, column="revenue"):
    return df.agg(F.sum(column)).first()[0]


def test_tax_and_tender_never_count(clean):
    for rule in RULE_TYPES:
        counted = clean.withColumn("revenue", revenue_expr(rule)).where("line_type in ('TAX', 'TENDER')")
        assert total(counted) is None
    canonical = total(clean.withColumn("revenue", revenue_expr()))
    assert canonical < total(clean.withColumn("revenue", F.col("qty") * F.col("unit_price")))


def test_keeping_both_void_sides_equals_dropping_the_bill(clean):
    both = total(clean.withColumn("revenue", revenue_expr()))
    dropped = total(ln.without_void_bills(clean).withColumn("revenue", revenue_expr()))
    half = total(clean.where("line_type <> 'VOID'").withColumn("revenue", revenue_expr()))
    assert both == dropped and half == both + 200


def test_discount_and_return_signs_differ_between_rules(clean):
    by = {
        rule: {r.line_type: r.v for r in clean.groupBy("line_type").agg(F.sum(revenue_expr(rule)).alias("v")).collect()}
        for rule in RULE_TYPES
    }
    assert by["canonical"]["DISCOUNT"] == -1 and by["fact_script"]["DISCOUNT"] == 1 and by["cross_system"]["DISCOUNT"] == -1
    assert {by[r]["RETURN"] for r in RULE_TYPES} == {Decimal(-50)}


def test_reissued_code_goes_to_the_product_of_the_day(spark, clean):
    products, _ = exports.masters(spark)
    fact = revenue.fact_sales(clean, products)
    found = {(str(r.business_date), r.product_sk, r.category_id) for r in fact.collect() if r.product_sk in (1, 2)}
    assert found == {("2024-05-30", 1, "C01"), ("2024-07-02", 2, "C02")}
    counted = clean.where(F.col("line_type").isin(*RULE_TYPES["canonical"])).count()
    assert fact.count() == counted
    bill_level = fact.where("product_sk = -1")
    assert {r.line_type for r in bill_level.collect()} == {"DISCOUNT", "SALE"}
    assert {r.product_code: r.rows for r in pr.unmatched_codes(clean, products).collect()} == {"ZZ": 1, None: 3}
    assert pr.unmatched_sales(clean, products).first().unmatched_sales == 4


def test_script_variant_drops_void_bills_and_lines_without_product(spark, clean):
    products, _ = exports.masters(spark)
    fact = revenue.fact_sales(clean, products, "fact_script")
    assert fact.where("bill_no = 'S01-20240702-3' or product_sk = -1").count() == 0
    assert fact.where("line_type = 'DISCOUNT'").count() == 0


def test_prices_follow_the_reporting_date(spark):
    products, revisions = exports.masters(spark)
    price = lambda day: {r.product_sk: r.historical_price for r in pr.price_as_of(products, revisions, day).collect()}
    assert price("2024-03-01") == {1: Decimal("10.00"), 3: Decimal("50.00")}
    assert price("2024-10-01") == {1: Decimal("10.00"), 2: Decimal("90.00"), 3: Decimal("55.00")}
    assert price("2024-07-14")[3] == Decimal("50.00") and price("2024-07-15")[3] == Decimal("55.00")
    counts = {r.product_sk: r.revision_count for r in pr.price_change_count(products, revisions).collect()}
    assert counts == {3: 2}


def test_stale_printed_price_is_found(spark, clean):
    products, revisions = exports.masters(spark)
    sold = revenue.fact_sales(clean, products).where("product_sk >= 0 and line_type = 'SALE'")
    rows = {r.store_id: r for r in pr.price_variance(pr.line_prices(sold, revisions)).collect()}
    assert (rows["S11"].lines, rows["S11"].off_list, rows["S11"].amount_difference) == (3, 1, Decimal("-5.00"))
    assert rows["S01"].off_list == 0


def test_slices_of_the_pre_aggregate_add_up(spark, clean):
    products, _ = exports.masters(spark)
    fact = revenue.fact_sales(clean, products)
    daily = revenue.store_category_day(fact)
    whole = F.round(F.sum("revenue"), 2)
    expected = fact.agg(whole).first()[0]
    for cols in (["store_id"], ["category_id"], ["line_type"]):
        assert total(revenue.revenue_by(daily, *cols)) == expected
    dates = calendar.dates_of(daily)
    weekday = {r.day_of_week: r.revenue for r in revenue.revenue_by_calendar(daily, dates, "day_of_week_num", "day_of_week").collect()}
    assert sum(weekday.values()) == expected and weekday["Thursday"] == Decimal("19.00")
    cube = revenue.revenue_cube(daily)
    assert cube.where("store_id is null and category_id is null and day_of_week_num is null and month is null").first().revenue == expected
    july = revenue.revenue_between(daily, "2024-07-01", "2024-08-01")
    assert total(july) == expected - 19


def test_calendar_has_one_row_per_day(spark):
    dates = calendar.dim_date(spark, "2024-01-01", "2024-12-31")
    assert dates.count() == 366
    first = dates.where("date_key = date'2024-01-01'").first()
    assert (first.day_of_week_num, first.day_of_week, first.month_name) == (1, "Monday", "January")


def test_missing_days_follow_the_declared_ranges(spark, clean):
    """Edges count, a store that never sent anything counts, days before the opening and after the closing do not."""
    stores = spark.sql("""select * from values ('S07', date'2024-07-01', cast(null as date)), ('S11', date'2019-01-01', date'2024-07-03'),
        ('S12', date'2024-07-14', null), ('S99', date'2030-01-01', null) as t(store_id, opened_on, closed_on)""")
    dates = calendar.dim_date(spark, "2024-07-01", "2024-07-16")
    ranges = calendar.trading_ranges(stores, dates)
    assert {r.store_id: (r.lo.day, r.hi.day) for r in ranges.collect()} == {"S07": (1, 16), "S11": (1, 3), "S12": (14, 16)}
    gaps = {}
    for r in calendar.missing_days(clean, ranges).collect():
        gaps.setdefault(r.store_id, set()).add(r.business_date.day)
    assert gaps == {"S07": set(range(1, 17)) - {2, 5}, "S11": {1, 3}, "S12": {14, 15, 16}}
    assert calendar.trading_ranges(stores.drop("closed_on"), dates).where("store_id = 'S11'").first().hi.day == 16


def test_expected_takings_are_medians_of_store_and_weekday(spark):
    days = [("S1", f"2024-01-{d:02d}", v) for d, v in ((1, 100), (8, 110), (15, 9000), (2, 50))]  # three Mondays, one Tuesday
    daily = spark.createDataFrame(days, "store_id string, d string, revenue int").selectExpr(
        "store_id", "date(d) business_date", "cast(revenue as decimal(24,5)) revenue")
    expected = reconcile.expected_takings(daily.unionByName(daily.where("business_date = '2024-01-02'")))
    assert {(r.day_of_week_num, int(r.expected)) for r in expected.collect()} == {(1, 110), (2, 100)}
    missing = spark.sql("""select * from values ('S1', date'2024-01-22'), ('S1', date'2024-01-09'), ('S1', date'2024-01-10'),
        ('S2', date'2024-02-05') as t(store_id, business_date)""")
    sizes = {r.month: (r.missing_store_days, int(r.expected_gap)) for r in reconcile.gap_sizes(missing, expected).collect()}
    assert sizes == {"2024-01": (3, 210), "2024-02": (1, 0)}


def test_causes_of_differences(spark):
    months = [f"2024-{m:02d}" for m in range(1, 10)]
    rules = spark.createDataFrame([(m, 100, 90, 80) for m in months if m != "2024-05"],
                                  "month string, canonical int, fact_script int, cross_system int")
    rules = rules.select("month", *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("canonical", "fact_script", "cross_system")])
    figures = {"2024-01": 100, "2024-02": 80, "2024-03": 140, "2024-04": 140, "2024-05": 7, "2024-07": 70, "2024-08": 140, "2024-09": 90}
    finance = spark.createDataFrame(list(figures.items()), "month string, v int").select(
        "month", F.col("v").cast("decimal(18,2)").alias("revenue_inr"))
    # Three days of 45 missing in March; in July the pipeline has more, in August far too little is missing, in April nothing.
    gaps = spark.createDataFrame([("2024-01", 1, 5), ("2024-03", 3, 45), ("2024-07", 3, 30), ("2024-08", 1, 4)],
                                 "month string, missing_store_days bigint, g int").select(
        "month", "missing_store_days", F.col("g").cast("decimal(18,2)").alias("expected_gap"))
    causes = {r.month: r.cause for r in reconcile.label_causes(rules, finance, gaps).collect()}
    assert causes == {
        "2024-01": "match", "2024-02": "definition:cross_system", "2024-03": "source_gap", "2024-04": "pipeline", "2024-05": "no_pipeline",
        "2024-06": "not_closed", "2024-07": "pipeline", "2024-08": "pipeline", "2024-09": "definition:fact_script",
    }
    monthly = rules.select("month", F.col("canonical").alias("pipeline_revenue"))
    rows = {r.month: r for r in reconcile.reconcile(monthly, finance).collect()}
    assert rows["2024-03"].difference_pct == -28.57 and rows["2024-05"].pipeline_revenue is None
    assert rows["2024-06"].finance_revenue is None and len(rows) == 9


def test_store_daily_counts_clean_lines(spark, clean):
    products, _ = exports.masters(spark)
    daily = revenue.store_category_day(revenue.fact_sales(clean, products))
    rows = {str(r.business_date): r for r in revenue.store_daily(daily, clean, "S01", "2024-05-01", "2024-07-31").collect()}
    assert (rows["2024-05-30"].rows, rows["2024-05-30"].revenue) == (4, Decimal("19.00"))  # TAX and TENDER are lines, not revenue
    assert set(rows) == {"2024-05-30", "2024-07-02"}


def test_interval_checks_find_overlaps_and_gaps(spark):
    rows = spark.sql("""select * from values (1, date'2024-01-01', date'2024-01-31'), (1, date'2024-01-31', date'2024-02-10'),
        (2, date'2024-01-01', date'2024-01-31'), (2, date'2024-02-02', date'2024-02-10') as t(k, lo, hi)""")
    assert quality.interval_overlaps(rows, "k", "lo", "hi", "x").first().violations == 1
    assert quality.interval_gaps(rows, "k", "lo", "hi", "x").first().violations == 1


def test_insert_and_upsert_keep_one_row_per_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "y"), (3, "z")], "k int, v string")
    assert sorted(map(tuple, insert_if_absent(new, old, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "y")]
    assert sorted(map(tuple, upsert(new, old, ["k"]).collect())) == [(1, "a"), (2, "x"), (3, "z")]
    dated = spark.createDataFrame([(2, "x", 1), (3, "z", 1), (3, "y", 2)], "k int, v string, at int")
    kept = upsert(dated, old.selectExpr("*", "0 AS at"), ["k"], ["at"])
    assert sorted(map(tuple, kept.collect())) == [(1, "a", 0), (2, "x", 1), (3, "y", 2)]


def test_left_join_keeps_lines_and_their_null_keys(spark, clean):
    products, _ = exports.masters(spark)
    joined = join_valid(clean, products, "product_code", "business_date", "valid_from", "valid_to", "left")
    assert joined.count() == clean.count()
