"""Raw inputs derived from the driver's tables.

The loan and mortgage chains read all-string raw files.  Here those raw frames
are derived row by row from ``lineitem`` (so their size grows with it), with
deterministic dirty values that exercise every cleaning path: unparseable
amounts, empty income, statuses outside the kept list, bad dates, exempt
codes, ratio ranges.  Every column is one SQL expression written in the
subset both Spark SQL and DuckDB accept, so the oracle derives the very same
input; only month formatting and identifier quoting differ by dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MONTH = {"spark": "date_format(l_shipdate, 'MMM-yyyy')", "duckdb": "strftime(l_shipdate, '%b-%Y')"}
_QUOTE = {"spark": "`{}`", "duckdb": '"{}"'}

_GRADE = "SUBSTR('ABCDEFG', CAST(l_partkey % 7 AS INT) + 1, 1)"

LOANS_RAW = [
    ("id", "CAST(l_orderkey * 10 + l_linenumber AS STRING)"),
    ("loan_amnt", "CASE WHEN l_quantity = 1 THEN 'n/a' ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END"),
    ("funded_amnt", "CAST(l_extendedprice * (1 - l_discount) AS STRING)"),
    ("term", "CASE WHEN l_linenumber % 2 = 0 THEN ' 60 months' ELSE ' 36 months' END"),
    ("int_rate", "CONCAT(CAST(l_discount * 100 + 5 AS STRING), '%')"),
    ("grade", _GRADE),
    ("sub_grade", f"CONCAT({_GRADE}, CAST(l_suppkey % 5 + 1 AS STRING))"),
    ("emp_length", "CONCAT(CAST(l_linenumber AS STRING), ' years')"),
    ("home_ownership", "CASE l_suppkey % 3 WHEN 0 THEN 'MORTGAGE' WHEN 1 THEN 'OWN' ELSE 'RENT' END"),
    ("annual_inc", "CASE WHEN l_tax = 0 THEN '' ELSE CAST(l_quantity * 1500 + 20000 AS STRING) END"),
    ("loan_status",
     "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Fully Paid'"
     " WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Charged Off'"
     " WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Current'"
     " WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Late (31-120 days)'"
     " WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'In Grace Period'"
     " WHEN l_linenumber <= 2 THEN 'Late (16-30 days)'"
     " WHEN l_linenumber <= 4 THEN 'Default'"
     " ELSE 'Does not meet the credit policy. Status:Charged Off' END"),
    ("purpose",
     "CASE l_partkey % 5 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card'"
     " WHEN 2 THEN 'home_improvement' WHEN 3 THEN 'major_purchase' ELSE 'other' END"),
    ("addr_state",
     "CASE l_suppkey % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX'"
     " WHEN 3 THEN 'FL' WHEN 4 THEN 'IL' ELSE 'WA' END"),
    ("dti", "CAST(l_tax * 300 AS STRING)"),
    ("issue_d", "CASE WHEN l_discount = 0.1 THEN 'n/a' ELSE {month} END"),
]

MORTGAGE_RAW = [
    ("activity_year", "CAST(year(l_shipdate) AS STRING)"),
    ("lei", "CONCAT('LEI', CAST(l_suppkey AS STRING))"),
    ("loan_type", "CASE l_suppkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '4' ELSE '9' END"),
    ("loan_purpose",
     "CASE l_partkey % 6 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '4'"
     " WHEN 3 THEN '31' WHEN 4 THEN '32' ELSE '5' END"),
    ("action_taken", "CAST(l_linenumber AS STRING)"),
    ("loan_amount", "CASE WHEN l_quantity = 2 THEN 'NA' ELSE CAST(CAST(floor(l_extendedprice * 10) AS BIGINT) AS STRING) END"),
    ("interest_rate",
     "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Exempt'"
     " ELSE CAST(l_discount * 50 + 3 AS STRING) END"),
    ("loan_term", "CASE WHEN l_tax = 0.08 THEN 'Exempt' WHEN l_linenumber % 2 = 0 THEN '360' ELSE '180' END"),
    ("property_value", "CAST(l_extendedprice * 14 AS STRING)"),
    ("income", "CASE WHEN l_quantity = 3 THEN 'Exempt' ELSE CAST(l_quantity * 4 + 30 AS STRING) END"),
    ("debt_to_income_ratio",
     "CASE l_orderkey % 6 WHEN 0 THEN '36' WHEN 1 THEN '45%' WHEN 2 THEN '20%-<30%'"
     " WHEN 3 THEN '>60%' WHEN 4 THEN 'NA' ELSE CAST(l_linenumber + 38 AS STRING) END"),
    ("applicant_race-1", "CAST(l_partkey % 5 + 1 AS STRING)"),
    ("applicant_sex", "CAST(l_suppkey % 4 + 1 AS STRING)"),
    ("applicant_age",
     "CASE l_orderkey % 4 WHEN 0 THEN '25-34' WHEN 1 THEN '35-44' WHEN 2 THEN '45-54' ELSE '<25' END"),
    ("county_code", "CONCAT('06', CAST(l_partkey % 58 * 2 + 1 AS STRING))"),
]


def select_list(columns: list[tuple[str, str]], dialect: str) -> list[str]:
    """``expr AS name`` items for ``dialect`` (``spark`` or ``duckdb``)."""
    quote = _QUOTE[dialect]
    return [f"{expr.format(month=_MONTH[dialect])} AS {quote.format(name)}" for name, expr in columns]


def loans_raw(lineitem: DataFrame) -> DataFrame:
    """All-string raw loan rows, one per line item."""
    return lineitem.selectExpr(*select_list(LOANS_RAW, "spark"))


def mortgage_raw(lineitem: DataFrame) -> DataFrame:
    """All-string raw mortgage application rows, one per line item."""
    return lineitem.selectExpr(*select_list(MORTGAGE_RAW, "spark"))


def loans_raw_sql(source: str = "lineitem") -> str:
    return f"SELECT {', '.join(select_list(LOANS_RAW, 'duckdb'))} FROM {source}"


def mortgage_raw_sql(source: str = "lineitem") -> str:
    return f"SELECT {', '.join(select_list(MORTGAGE_RAW, 'duckdb'))} FROM {source}"


# --- arrivals ---------------------------------------------------------------------

def assign_batches(df: DataFrame, key: str, n_batches: int, name: str = "batch") -> DataFrame:
    """Batch number 1..n by equal ranges of the integer ``key`` (two scalars,
    min and max, are read first)."""
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    if lo is None:
        return df.withColumn(name, F.lit(None).cast("int"))
    span = int(hi) - int(lo) + 1
    return df.withColumn(name, F.expr(f"CAST((({key} - {int(lo)}) * {n_batches}) DIV {span} + 1 AS INT)"))


def land_batch(df: DataFrame, batch_col: str, batch: int, landing_dir: str) -> None:
    """Append the rows of one arrival batch to ``landing_dir``."""
    df.filter(F.col(batch_col) == batch).write.mode("append").parquet(landing_dir)


# --- text model -------------------------------------------------------------------

def counting_client():
    """A repeatable stand-in for a text model: tells the length of each prompt."""
    def client(prompts, max_tokens):
        texts = [f"Segment text of {len(p)} characters."[:4 * max_tokens] for p in prompts]
        return [(t, -(-len(p) // 4), -(-len(t) // 4)) for p, t in zip(prompts, texts)]
    return client
