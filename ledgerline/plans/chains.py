"""Bronze -> silver -> gold chains built from the operators.

Pure plan builders (``loan_silver``, ``loan_gold``, ...) take and return
DataFrames; ``run_loan_chain`` / ``run_mortgage_chain`` execute the chain
through stored layers, one action per layer with row counts observed during
each write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import presets
from ledgerline.functions.casts import month_date, safe_double, safe_int, strip_cast
from ledgerline.functions.codes import decode, tier
from ledgerline.functions.rounded import rounded_avg
from ledgerline.operators.aggregate import share, summarise, top_k
from ledgerline.operators.filters import keep_in, require
from ledgerline.sources.files import read_layer, read_raw_csv, write_layer

# --- consumer loans -----------------------------------------------------------


def loan_typed(raw: DataFrame, columns: Sequence[str] = presets.LOAN_SILVER_COLUMNS,
               date_pattern: str = presets.ISSUE_DATE_PATTERN) -> DataFrame:
    """Projection and safe casts of the loan silver step, before any filter.

    Amount, income and ratio text become doubles, the rate loses its ``%``;
    ``term_months`` and ``issue_date`` are added when their text columns are
    kept.  One projection, so Catalyst sees every cast at once.
    """
    df = raw.select(*columns)
    casts = {c: safe_double(c) for c in ("loan_amnt", "funded_amnt", "annual_inc", "dti") if c in df.columns}
    if "int_rate" in df.columns:
        casts["int_rate"] = strip_cast("int_rate", "%", "double")
    if "term" in df.columns:
        casts["term_months"] = strip_cast("term", " months", "int")
    if "issue_d" in df.columns:
        casts["issue_date"] = month_date("issue_d", date_pattern)
    return df.withColumns(casts)


def loan_silver(raw: DataFrame, statuses: Sequence[str] = presets.LOAN_STATUSES,
                columns: Sequence[str] = presets.LOAN_SILVER_COLUMNS) -> DataFrame:
    """Typed loans with a kept status, an amount and an income."""
    df = keep_in(loan_typed(raw, columns), "loan_status", statuses)
    return require(df, ["loan_amnt", "annual_inc"])


def loan_kept(statuses: Sequence[str] = presets.LOAN_STATUSES) -> F.Column:
    """The condition of the silver filter on typed loans."""
    return F.col("loan_status").isin(list(statuses)) & F.col("loan_amnt").isNotNull() & F.col("annual_inc").isNotNull()


LOAN_GOLD_MEASURES = [
    ("loan_count", "count", "id"),
    ("avg_loan_amt", "avg", "loan_amnt"),
    ("avg_interest_rate", "avg", "int_rate"),
    ("avg_annual_income", "avg", "annual_inc"),
    ("avg_dti", "avg", "dti"),
    ("total_loan_volume", "sum", "loan_amnt"),
]


def loan_gold(silver: DataFrame, tiers=presets.RISK_TIERS, order: bool = True,
              measures=LOAN_GOLD_MEASURES) -> DataFrame:
    """Risk summary by grade and status with a risk tier."""
    g = summarise(silver, ["grade", "loan_status"], measures)
    g = g.withColumn("risk_tier", tier("grade", tiers, presets.RISK_TIER_DEFAULT))
    return g.orderBy("grade", "loan_status") if order else g


def gold_readback(gold: DataFrame, statuses: Sequence[str] = presets.NARRATIVE_STATUSES) -> DataFrame:
    """The stored gold of the finished loans, by tier, grade and status."""
    return (gold.where(F.col("loan_status").isin(list(statuses)))
            .select("risk_tier", "grade", "loan_status", "loan_count", "avg_loan_amt", "avg_interest_rate", "avg_dti",
                    "total_loan_volume").orderBy("risk_tier", "grade", "loan_status"))


def loan_chain(raw: DataFrame) -> DataFrame:
    return loan_gold(loan_silver(raw))


def declarative_silver(raw: DataFrame) -> DataFrame:
    """The reduced silver of the declarative variant: four casts, status and
    amount filters (rows without income are kept)."""
    return require(keep_in(declarative_typed(raw), "loan_status", presets.LOAN_STATUSES), ["loan_amnt"])


def declarative_gold(silver: DataFrame) -> DataFrame:
    measures = [m for m in LOAN_GOLD_MEASURES if m[0] != "avg_annual_income"]
    return loan_gold(silver, order=False, measures=measures)


def declarative_typed(raw: DataFrame) -> DataFrame:
    """Declarative silver before its filters, where expectations are checked."""
    return raw.select(*presets.DECLARATIVE_SILVER_COLUMNS).withColumns({
        "loan_amnt": safe_double("loan_amnt"),
        "annual_inc": safe_double("annual_inc"),
        "dti": safe_double("dti"),
        "int_rate": strip_cast("int_rate", "%", "double"),
    })


def bronze_profile(raw: DataFrame) -> DataFrame:
    """Rows and average amount per raw status, most frequent first."""
    return (raw.groupBy("loan_status")
            .agg(F.count(F.lit(1)).alias("loan_count"),
                 rounded_avg(safe_double("loan_amnt"), 2).alias("avg_loan_amount"))
            .orderBy(F.col("loan_count").desc(), F.col("loan_status")))


def silver_profile(silver: DataFrame) -> DataFrame:
    return summarise(silver, ["grade"], [
        ("loan_count", "count", "*"),
        ("avg_loan_amt", "avg", "loan_amnt"),
        ("avg_interest_rate", "avg", "int_rate"),
        ("avg_dti", "avg", "dti"),
    ], order=True)


def default_rate(silver: DataFrame, keys: Sequence[str] = ("grade",)) -> DataFrame:
    """Charged-off share among finished loans (charged off or fully paid)."""
    return share(silver, list(keys), "loan_status = 'Charged Off'",
                 "loan_status IN ('Charged Off', 'Fully Paid')", name="charged_off_pct")


# --- mortgages ----------------------------------------------------------------


def mortgage_projection(raw: DataFrame) -> DataFrame:
    """Silver projection with the dashed race column renamed."""
    return raw.selectExpr(*presets.MORTGAGE_SILVER_COLUMNS)


def mortgage_silver(raw: DataFrame, kept_actions: Sequence[str] = presets.KEPT_ACTIONS) -> DataFrame:
    """Decoded labels, safe casts, kept actions and a parsed amount."""
    df = mortgage_projection(raw).withColumns({
        "action_label": decode("action_taken", presets.ACTION_LABELS, presets.CODE_DEFAULT),
        "loan_purpose_label": decode("loan_purpose", presets.PURPOSE_LABELS, presets.CODE_DEFAULT),
        "loan_type_label": decode("loan_type", presets.LOAN_TYPE_LABELS, presets.CODE_DEFAULT),
        "loan_amount": safe_double("loan_amount"),
        "interest_rate": safe_double("interest_rate"),
        "loan_term": safe_int("loan_term"),
        "property_value": safe_double("property_value"),
        "income": safe_double("income"),
    })
    return require(keep_in(df, "action_taken", kept_actions), ["loan_amount"])


def mortgage_gold(silver: DataFrame, order: bool = True) -> DataFrame:
    """Summary by purpose, action and type with an approval tier."""
    g = summarise(silver.withColumn("dti_clean", strip_cast("debt_to_income_ratio", "%", "double")),
                  ["loan_purpose_label", "action_label", "loan_type_label"], [
                      ("application_count", "count", "*"),
                      ("avg_loan_amount", "avg", "loan_amount"),
                      ("avg_interest_rate", "avg", "interest_rate"),
                      ("avg_income", "avg", "income"),
                      ("avg_dti", "avg", "dti_clean"),
                      ("total_loan_volume", "sum", "loan_amount"),
                  ])
    g = g.withColumn("approval_tier", decode("action_label", presets.APPROVAL_TIERS, presets.CODE_DEFAULT))
    return g.orderBy("loan_purpose_label", "action_label") if order else g


def mortgage_chain(raw: DataFrame) -> DataFrame:
    return mortgage_gold(mortgage_silver(raw))


def label_profile(silver: DataFrame) -> DataFrame:
    return summarise(silver, ["loan_purpose_label", "action_label"], [
        ("application_count", "count", "*"),
        ("avg_loan_amount", "avg", "loan_amount"),
    ], order=True)


def code_combinations(raw: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent (action, purpose, type) code combinations."""
    return top_k(raw, ["action_taken", "loan_purpose", "loan_type"], k, "application_count")


def income_band(income: str = "income") -> F.Column:
    c = F.col(income)
    return (F.when(c.isNull(), F.lit("unknown")).when(c < 50, F.lit("under 50"))
            .when(c < 100, F.lit("50 to 100")).otherwise(F.lit("100 and over")))


def denial_rate(silver: DataFrame, keys: Sequence[str] = ("loan_purpose_label",)) -> DataFrame:
    """Denied share of all kept applications per group."""
    return share(silver, list(keys), "action_label = 'Denied'", None, name="denial_pct")


# --- executed chains ----------------------------------------------------------


@dataclass
class ChainRun:
    paths: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


def run_loan_chain(spark: SparkSession, raw_path: str, root: str, partitions: int | None = None) -> ChainRun:
    """CSV -> bronze -> silver -> gold as stored Parquet layers under ``root``."""
    run = ChainRun({k: f"{root.rstrip('/')}/{k}" for k in ("bronze", "silver", "gold")})
    run.rows["bronze"] = write_layer(read_raw_csv(spark, raw_path, partitions), run.paths["bronze"])
    run.rows["silver"] = write_layer(loan_silver(read_layer(spark, run.paths["bronze"])), run.paths["silver"])
    run.rows["gold"] = write_layer(loan_gold(read_layer(spark, run.paths["silver"]), order=False),
                                   run.paths["gold"])
    return run


def run_mortgage_chain(spark: SparkSession, raw_path: str, root: str, partitions: int | None = None) -> ChainRun:
    run = ChainRun({k: f"{root.rstrip('/')}/{k}" for k in ("bronze", "silver", "gold")})
    run.rows["bronze"] = write_layer(read_raw_csv(spark, raw_path, partitions), run.paths["bronze"])
    run.rows["silver"] = write_layer(mortgage_silver(read_layer(spark, run.paths["bronze"])), run.paths["silver"])
    run.rows["gold"] = write_layer(mortgage_gold(read_layer(spark, run.paths["silver"]), order=False),
                                   run.paths["gold"])
    return run
