"""Rule-based product buckets (B1, B2): the ten cash columns of the pipeline-type table.

Specified in the dashboard formula sheets but not built in the warehouse models; here the
rules are data (an ordered list), compiled into one ``CASE`` - first match wins - so a
deal lands in at most one bucket and the ten columns add up to the bucketed total.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BucketRule:
    bucket: str
    products: tuple = ()        # renewal_product IN (...); empty = any
    year_counts: tuple = ()     # renewal_year_count IN (...); empty = any
    categories: tuple = ()      # original product category IN (...); empty = any
    pipeline_types: tuple = ()  # renewal_pipeline_type IN (...); empty = any


# --- fixed values: the ten pipeline-type columns and their filters ------------------
_MM = ("MM Gold", "MM Platinum", "MM Bronze")
DEFAULT_RULES = (
    BucketRule("REFERRAL", pipeline_types=("Referral",)),
    BucketRule("MM_T1", products=_MM, year_counts=("1st Year",)),
    BucketRule("MM_T2", products=_MM, year_counts=("2nd Year",)),
    BucketRule("MM_T3", products=_MM, year_counts=("3rd Year+",)),
    BucketRule("MM_RESTART", products=("Restart",), categories=("Mastermind",)),
    BucketRule("ACC_T1", products=("Accelerator",), year_counts=("1st Year",)),
    BucketRule("ACC_T2", products=("Accelerator",), year_counts=("2nd Year", "3rd Year+")),
    BucketRule("ACC_UPGRADE", products=("Accelerator Upgrade",)),
    BucketRule("ACC_RESTART", products=("Restart",), categories=("Accelerator",)),
    BucketRule("MM_UPGRADE", products=("MM Upgrade — Bronze to Gold", "MM Upgrade — Gold to Platinum")),
)
BUCKETS = tuple(r.bucket for r in DEFAULT_RULES)
# --- end of fixed values ------------------------------------------------------------


def _rule_pred(r: BucketRule, product: str, year: str, category: str, ptype: str) -> Column:
    conds = []
    for vals, col in ((r.products, product), (r.year_counts, year), (r.categories, category),
                      (r.pipeline_types, ptype)):
        if vals:
            conds.append(F.col(col).isin(*vals))
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return F.coalesce(out, F.lit(False))


def classify(df: DataFrame, rules=DEFAULT_RULES, product: str = "renewal_product",
             year: str = "renewal_year_count", category: str = "orig_product_category",
             ptype: str = "renewal_pipeline_type", out: str = "product_bucket") -> DataFrame:
    """B1: ordered rule list -> bucket (NULL when no rule matches)."""
    expr = None
    for r in rules:
        p = _rule_pred(r, product, year, category, ptype)
        expr = F.when(p, F.lit(r.bucket)) if expr is None else expr.when(p, F.lit(r.bucket))
    return df.withColumn(out, expr)


def bucket_pivot(cash: DataFrame, by=("closer_owner_id",), buckets=BUCKETS, bucket_col: str = "product_bucket",
                 amount: str = "cash_amount") -> DataFrame:
    """B2: one cash column per bucket (fixed list) + their sum + the independent total of
    all cash (kept separately: unbucketed cash is in the total, not in the columns)."""
    cols = [F.sum(F.when(F.col(bucket_col) == b, F.col(amount)).otherwise(F.lit(0.0))).alias(b.lower())
            for b in buckets]
    bucketed = F.sum(F.when(F.col(bucket_col).isNotNull(), F.col(amount)).otherwise(F.lit(0.0)))
    return cash.groupBy(*by).agg(*cols, bucketed.alias("bucketed_cash"), F.sum(amount).alias("total_cash"))
