import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from ledgerline import presets  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerline-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerline-t-")


LOAN_RAW_COLS = list(presets.LOAN_SILVER_COLUMNS)


def _loan(id, amnt, term, rate, grade, inc, status, dti, issue):
    return (id, amnt, amnt, term, rate, grade, None, "5 years", "RENT", inc, status, "other", "CA", dti, issue)


LOAN_RAW_ROWS = [
    _loan("1", "10000", " 36 months", "7.5%", "A", "50000", "Fully Paid", "10.5", "Dec-2015"),
    _loan("2", "20000.5", " 60 months", "13.0", "G", "40000", "Charged Off", "30", "Jan-2016"),
    _loan("3", "abc", " 36 months", "9%", "B", "60000", "Current", "5", "Feb-2016"),
    _loan("4", "5000", None, None, "C", None, "Default", None, None),
    _loan("5", "7000", "36", "x%", "Z", "30000", "In Grace Period", "n/a", "2015-12"),
    _loan(None, "8000", " 36 months", "8%", None, "30000", "Fully Paid", "1", "Mar-2016"),
    _loan("7", "9000", " 36 months", "8%", "D", "30000", "Other status", "1", "Mar-2016"),
    ("footer text",) + (None,) * 14,
]


@pytest.fixture()
def loans_raw(spark):
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in LOAN_RAW_COLS])
    return spark.createDataFrame(LOAN_RAW_ROWS, schema)


# the raw file's names: the part before the rename
MORTGAGE_RAW_COLS = [c.split(" AS ")[0].strip("`") for c in presets.MORTGAGE_SILVER_COLUMNS]


def _mort(type_, purpose, action, amount, rate, term, income, ratio):
    return ("2023", "LEI1", type_, purpose, action, amount, rate, term, "500000", income, ratio, "5", "1",
            "35-44", "06037")


MORTGAGE_RAW_ROWS = [
    _mort("1", "1", "1", "300000", "6.5", "360", "120", "36"),
    _mort("2", "2", "2", "50000", "Exempt", "Exempt", "Exempt", "45%"),
    _mort("3", "4", "3", "200000", "7.0", "360", "80", "20%-<30%"),
    _mort("4", "31", "3", "250000", "7.25", "180", "90", ">60%"),
    _mort("9", "32", "1", "150000", "6.0", "360", "70", "NA"),
    _mort("1", "5", "1", "100000", "6.75", "360", "60", "40"),
    _mort("1", "1", "4", "100000", "6.75", "360", "60", "40"),
    _mort("1", "1", "5", "100000", "6.75", "360", "60", "40"),
    _mort("1", "1", "6", "100000", "6.75", "360", "60", "40"),
    _mort("1", "1", None, "100000", "6.75", "360", "60", "40"),
    _mort("1", "1", "1", None, "6.75", "360", "60", "40"),
]


@pytest.fixture()
def mortgage_raw(spark):
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in MORTGAGE_RAW_COLS])
    return spark.createDataFrame(MORTGAGE_RAW_ROWS, schema)
