"""The declarative loan chain as Spark Declarative Pipelines definitions.

``define_loan_pipeline`` registers four materialized views -- bronze, silver,
gold and the silver expectation counts -- built from the same operators as
:mod:`ledgerline.plans.chains`.  The pipelines runtime of ``pyspark``
(``spark-pipelines run`` over Spark Connect) resolves the order from the
``spark.read.table`` references.  It has no expectation decorators, so the
warn-mode expectations become their own view, counted on the typed rows
before the silver filters.  ``examples/pipeline`` holds a spec that uses this.
"""

from __future__ import annotations

from pyspark import pipelines as dp
from pyspark.sql import SparkSession

from ledgerline import presets
from ledgerline.operators.filters import ordered_subset
from ledgerline.operators.quality import expectation_report
from ledgerline.plans.chains import declarative_gold, declarative_silver, declarative_typed
from ledgerline.sources.files import read_raw_csv

BRONZE = "bronze_loans"
SILVER = "silver_loans"
GOLD = "gold_loan_risk"
EXPECTATIONS = "silver_loan_expectations"


def define_loan_pipeline(spark: SparkSession, raw_path: str, partitions: int | None = None,
                         dev_rows: int | None = None) -> None:
    """Register the pipeline's datasets with the active pipeline graph.

    ``dev_rows`` keeps a repeatable development subset (the first rows by
    ``id``) instead of an unordered ``limit``.
    """

    @dp.materialized_view(name=BRONZE, comment="Raw loan rows as text, read from the landing folder")
    def bronze():
        raw = read_raw_csv(spark, raw_path, partitions)
        return ordered_subset(raw, ["id"], dev_rows) if dev_rows else raw

    @dp.materialized_view(name=SILVER, comment="Typed loan rows with a kept status and an amount")
    def silver():
        return declarative_silver(spark.read.table(BRONZE))

    @dp.materialized_view(name=EXPECTATIONS,
                          comment="Warn-mode expectation counts of the silver step, before its filters")
    def expectations():
        return expectation_report(declarative_typed(spark.read.table(BRONZE)), presets.LOAN_EXPECTATIONS)

    @dp.materialized_view(name=GOLD, comment="Loan risk summary by grade and status")
    def gold():
        return declarative_gold(spark.read.table(SILVER))
