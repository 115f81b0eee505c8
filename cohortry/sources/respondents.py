"""A respondent table derived from ``orders`` and ``customer``.

It has what a survey extract has: codes, nulls, a plausibility cap, a partly unknown
target that depends on the predictors, and exact duplicate profiles under new ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.sources.tables import read_table

SOURCE_TABLES = ("orders", "customer")
KEY = "id"
TARGET = "target"
PREDICTORS = [
    "age", "bmi", "sex", "high_bp", "phys_activity", "gen_hlth", "income",
    "ment_hlth", "stroke", "heart_disease", "diff_walk",
]

COPY_OFFSET = 1_000_000_000

_COLUMNS = {
    "age": "CAST(CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE 1 + (o_custkey * 7 + o_orderkey) % 13 END AS INT)",
    "bmi": "CAST(CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE floor((14 + o_totalprice / 10000) * 10) / 10 END AS DOUBLE)",
    "sex": "CAST(o_custkey % 2 AS INT)",
    "high_bp": "CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS INT)",
    "phys_activity": "CAST(CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS INT)",
    "gen_hlth": "CAST(substr(o_orderpriority, 1, 1) AS INT)",
    "income": "CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 + c_nationkey % 11 END AS INT)",
    "ment_hlth": "CAST(CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 31 END AS INT)",
    "stroke": "CAST(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END AS INT)",
    "heart_disease": "CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INT)",
    "diff_walk": "CAST(CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS INT)",
}

_TARGET = """
    CAST(CASE WHEN o_orderkey % 37 = 0 THEN NULL
              WHEN 0.25 * coalesce(age, 7) + 0.08 * (14 + o_totalprice / 10000)
                   + 1.5 * high_bp + 0.4 * (o_custkey % 10) > 8.5 THEN 1
              ELSE 0 END AS INT)
"""


def respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of orders and one of customer; the copies are exploded, not scanned again."""
    orders = read_table(spark, f"{sf_dir}/orders.parquet")
    customer = read_table(spark, f"{sf_dir}/customer.parquet")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    answers = joined.select(
        F.col("o_orderkey").alias(KEY),
        *[F.expr(sql).alias(name) for name, sql in _COLUMNS.items()],
        "o_orderkey", "o_custkey", "o_totalprice",
    )
    offsets = F.when(F.col("o_orderkey") % 50 == 1, F.array(F.lit(0), F.lit(COPY_OFFSET))).otherwise(
        F.array(F.lit(0))
    )
    return answers.select(
        "*", F.expr(_TARGET).alias(TARGET), F.explode(offsets).alias("offset")
    ).select((F.col(KEY) + F.col("offset")).alias(KEY), *PREDICTORS, TARGET)
