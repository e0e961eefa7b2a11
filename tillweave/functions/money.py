"""Revenue rules over normalised sales lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SALE, RETURN, DISCOUNT, VOID = "SALE", "RETURN", "DISCOUNT", "VOID"
TAX, TENDER = "TAX", "TENDER"

# Line types that enter each rule. TAX and TENDER enter none: a TENDER row repeats its bill's total.
RULE_TYPES = {
    "canonical": (SALE, RETURN, DISCOUNT, VOID),
    "fact_script": (SALE, RETURN, DISCOUNT),
    "cross_system": (SALE, RETURN, DISCOUNT),
}

REVENUE_TYPE = "decimal(18,5)"


def amount() -> Column:
    return F.col("qty") * F.col("unit_price")


def revenue_expr(rule: str = "canonical") -> Column:
    """Revenue of one line; null for line types outside the rule.

    canonical     signs are already in the data, so qty * unit_price for every counted type
    fact_script   DISCOUNT negated (it therefore adds), RETURN forced negative
    cross_system  RETURN and DISCOUNT both forced negative
    """
    kind = F.col("line_type")
    if rule == "canonical":
        value = F.when(kind.isin(*RULE_TYPES[rule]), amount())
    elif rule == "fact_script":
        value = F.when(kind == SALE, amount()).when(kind.isin(RETURN, DISCOUNT), -amount())
        value = fix_return_sign(value)
    elif rule == "cross_system":
        value = F.when(kind == SALE, amount()).when(kind.isin(RETURN, DISCOUNT), -F.abs(amount()))
    else:
        raise ValueError(f"unknown revenue rule {rule!r}")
    return value.cast(REVENUE_TYPE)


def fix_return_sign(revenue: Column) -> Column:
    """Returns always subtract, whatever sign they came with."""
    return F.when(F.col("line_type") == RETURN, -F.abs(revenue)).otherwise(revenue)


def money_sum(column: str = "revenue") -> Column:
    return F.round(F.sum(column), 2).cast("decimal(18,2)")
