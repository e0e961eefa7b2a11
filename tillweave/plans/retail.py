"""Retail job over one set of input tables: clean lines, facts, daily pre-aggregate, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.functions.money import RULE_TYPES, fix_return_sign, amount, money_sum, revenue_expr
from tillweave.operators import calendar, lines, products, quality, reconcile, revenue
from tillweave.operators.joins import join_valid
from tillweave.plans import retail_inputs as inputs
from tillweave.session import SMALL_SPLITS, stage, tune
from tillweave.sources.sales_files import file_contract


class Retail:
    """Tables of the job. The three stage tables are written once per application, as the nightly job would."""

    def __init__(self, spark: SparkSession, sf_dir: str, parallelism: int | None = None):
        """With ``parallelism`` the lines are dealt to so many tasks as they are read, for tables of few row groups."""
        self.spark, self.sf_dir, self.parallelism = tune(spark, SMALL_SPLITS), sf_dir, parallelism

    def raw(self) -> DataFrame:
        return inputs.sales_lines(self.spark, self.sf_dir, self.parallelism)

    def clean(self) -> DataFrame:
        return stage(self.spark, self.sf_dir, "clean_lines", lambda: lines.dedup_lines(self.raw()))

    def products(self) -> DataFrame:
        return inputs.products(self.spark, self.sf_dir)

    def revisions(self) -> DataFrame:
        return inputs.price_revisions(self.spark, self.sf_dir)

    def stores(self) -> DataFrame:
        return inputs.stores(self.spark, self.sf_dir)

    def categories(self) -> DataFrame:
        return inputs.categories(self.spark, self.sf_dir)

    def fact(self, rule: str = "canonical") -> DataFrame:
        if rule != "canonical":
            return revenue.fact_sales(self.clean(), self.products(), rule)
        return stage(
            self.spark, self.sf_dir, "fact_sales",
            lambda: revenue.fact_sales(self.clean(), self.products()),
        )

    def daily(self) -> DataFrame:
        return stage(
            self.spark, self.sf_dir, "store_category_day",
            lambda: revenue.store_category_day(self.fact()),
        )

    def dates(self) -> DataFrame:
        return calendar.dates_of(self.daily())

    def by_rule(self) -> DataFrame:
        per_rule = []
        for rule in RULE_TYPES:
            facts = self.fact(rule) if rule == "fact_script" else None
            if rule == "canonical":
                daily = self.daily().select("business_date", "revenue")
            elif facts is not None:
                daily = facts.select("business_date", "revenue")
            else:
                daily = self._cross_system_days()
            per_rule.append(daily.select(F.lit(rule).alias("rule"), "business_date", "revenue"))
        return reconcile.monthly_by_rule(per_rule[0].unionByName(per_rule[1]).unionByName(per_rule[2]))

    def _cross_system_days(self) -> DataFrame:
        sums = (
            revenue.counted_lines(self.clean(), "cross_system")
            .select("product_code", "business_date", revenue_expr("cross_system").alias("revenue"))
            .groupBy("product_code", "business_date")
            .agg(F.sum("revenue").alias("revenue"))
        )
        valid = self.products().select("product_code", "valid_from", "valid_to")
        return join_valid(sums, valid, "product_code", "business_date", "valid_from", "valid_to")

    def staged_by_rule(self) -> DataFrame:
        return stage(self.spark, self.sf_dir, "month_by_rule", self.by_rule)

    def missing(self) -> DataFrame:
        return calendar.missing_days(self.daily(), calendar.trading_ranges(self.stores(), self.dates()))

    def gaps(self) -> DataFrame:
        return stage(self.spark, self.sf_dir, "gap_sizes", lambda: reconcile.gap_sizes(
            self.missing(), reconcile.expected_takings(self.daily())))

    def finance(self) -> DataFrame:
        return inputs.finance_monthly(self.staged_by_rule(), self.gaps())

    def monthly(self) -> DataFrame:
        return revenue.revenue_by_month_key(self.daily())


def file_name_contract(r: Retail) -> DataFrame:
    """Store, business date, re-send number and format from every file name, checked against the lines."""
    files = r.raw().groupBy("source_file", "store_id", "business_date").agg(F.count("*").alias("rows"))
    return file_contract(files.withColumnsRenamed({"store_id": "line_store", "business_date": "line_date"}), "source_file")


def line_type_filter(r: Retail) -> DataFrame:
    kept = r.clean().where(F.col("line_type").isin("SALE", "RETURN", "DISCOUNT"))
    return kept.groupBy("line_type").agg(F.count("*").alias("rows"), F.sum("qty").alias("qty"))


def revenue_rule(r: Retail) -> DataFrame:
    """The three revenue rules side by side, per line type."""
    return r.clean().groupBy("line_type").agg(
        *[F.round(F.sum(revenue_expr(rule)), 2).cast("decimal(18,2)").alias(rule) for rule in RULE_TYPES],
        F.round(F.sum(amount()), 2).cast("decimal(18,2)").alias("every_row"),
    )


def return_sign_fix(r: Retail) -> DataFrame:
    """Returns negated once (wrong for rows that are already negative) and then repaired."""
    returns = r.clean().where("line_type = 'RETURN'").withColumn("revenue", -amount())
    return returns.groupBy("store_id").agg(
        money_sum().alias("before"),
        F.round(F.sum(fix_return_sign(F.col("revenue"))), 2).cast("decimal(18,2)").alias("after"),
    )


def scd2_join(r: Retail) -> DataFrame:
    """Item lines with the product that owned the code on the business date."""
    items = r.clean().where("product_code is not null").select("bill_no", "line_no", "business_date", "product_code")
    valid = r.products().select("product_code", "product_sk", "category_id", "valid_from", "valid_to")
    return join_valid(items, valid, "product_code", "business_date", "valid_from", "valid_to").drop(
        "valid_from", "valid_to"
    )


def void_anti(r: Retail) -> DataFrame:
    kept = lines.without_void_bills(r.clean())
    return kept.groupBy("line_type").agg(F.count("*").alias("rows"), F.countDistinct("bill_no").alias("bills"))


def price_as_of(r: Retail) -> DataFrame:
    """The same report for two reporting dates."""
    march = products.price_as_of(r.products(), r.revisions(), "1997-03-01")
    october = products.price_as_of(r.products(), r.revisions(), "1999-10-01")
    return march.unionByName(october)


def _item_facts(r: Retail) -> DataFrame:
    return r.fact().where("product_sk >= 0 and line_type = 'SALE'")


def line_list_price(r: Retail) -> DataFrame:
    priced = products.line_prices(_item_facts(r), r.revisions())
    return priced.select("bill_no", "line_no", "product_sk", "business_date", "unit_price", "list_price")


def price_variance(r: Retail) -> DataFrame:
    return products.price_variance(products.line_prices(_item_facts(r), r.revisions()))


def table_counts(r: Retail) -> DataFrame:
    return revenue.named_counts({
        "clean_sales": r.clean(), "fact_sales": r.fact(), "dim_store": r.stores(),
        "dim_category": r.categories(), "dim_product": r.products(), "dim_date": r.dates(),
    })


def star_scorecard(r: Retail) -> DataFrame:
    dims = {"stores": r.stores(), "categories": r.categories(), "products": r.products(), "dates": r.dates()}
    return revenue.scorecard(dims, r.fact())


def july_by_store(r: Retail) -> DataFrame:
    july = revenue.revenue_between(r.daily(), "1998-07-01", "1998-08-01")
    return revenue.revenue_by(july, "store_id").withColumnRenamed("revenue", "july_pipeline_revenue")


def reconcile_causes(r: Retail) -> DataFrame:
    return reconcile.label_causes(r.staged_by_rule(), r.finance(), r.gaps())


def price_list(r: Retail) -> DataFrame:
    """The first fifty price revisions in product order."""
    return r.revisions().orderBy("product_sk", "effective_from", "revision_id").limit(50)


QUERIES = {
    "file_name_contract": file_name_contract,
    "duplicate_keys": lambda r: lines.duplicate_keys(r.raw()),
    "conflicting_keys": lambda r: lines.conflicting_keys(r.raw()),
    "dedup_lines": lambda r: r.clean(),
    "table_checksum": lambda r: lines.table_checksum(r.clean()),
    "ordered_checksum": lambda r: lines.ordered_checksum(r.clean()),
    "table_counts": table_counts,
    "line_type_counts": lambda r: lines.line_type_counts(r.clean()),
    "line_type_filter": line_type_filter,
    "void_bills": lambda r: lines.void_bills(r.clean()),
    "void_profile": lambda r: lines.void_profile(r.clean()),
    "void_anti": void_anti,
    "unmatched_sales": lambda r: products.unmatched_sales(r.clean(), r.products()),
    "unmatched_codes": lambda r: products.unmatched_codes(r.clean(), r.products()),
    "scd2_join": scd2_join,
    "revenue_rule": revenue_rule,
    "return_sign_fix": return_sign_fix,
    "fact_sales": lambda r: r.fact(),
    "fact_sales_script": lambda r: r.fact("fact_script"),
    "fact_cardinality": lambda r: revenue.fact_cardinality(r.fact()),
    "revenue_by_line_type": lambda r: revenue.revenue_by_line_type(r.daily()),
    "revenue_by_line_type_script": lambda r: revenue.revenue_by_line_type(
        revenue.store_category_day(r.fact("fact_script"))
    ),
    "revenue_by_store": lambda r: revenue.revenue_by(r.daily(), "store_id"),
    "revenue_by_category": lambda r: revenue.revenue_by(r.daily(), "category_id"),
    "revenue_by_weekday": lambda r: revenue.revenue_by_calendar(
        r.daily(), r.dates(), "day_of_week_num", "day_of_week"
    ),
    "revenue_by_month": lambda r: revenue.revenue_by_calendar(r.daily(), r.dates(), "year", "month", "month_name"),
    "revenue_by_month_key": lambda r: revenue.revenue_by_month_key(r.daily()),
    "revenue_cube": lambda r: revenue.revenue_cube(r.daily()),
    "star_scorecard": star_scorecard,
    "price_list": price_list,
    "price_change_count": lambda r: products.price_change_count(r.products(), r.revisions()),
    "price_as_of": price_as_of,
    "line_list_price": line_list_price,
    "price_variance": price_variance,
    "store_category_revenue": lambda r: revenue.store_category_revenue(
        r.clean(), r.stores(), r.products(), r.categories()
    ),
    "reconcile": lambda r: reconcile.reconcile(r.monthly(), r.finance()),
    "reconcile_july": lambda r: reconcile.reconcile_month(r.monthly(), r.finance(), "1998-07"),
    "reconcile_causes": reconcile_causes,
    "july_by_store": july_by_store,
    "store_daily_gap": lambda r: revenue.store_daily(r.daily(), r.clean(), "S07", "1998-07-01", "1998-07-31"),
    "missing_days": lambda r: r.missing(),
    "gap_sizes": lambda r: r.gaps(),
    "interval_quality": lambda r: quality.interval_quality(r.products(), r.revisions(), r.categories()),
}
