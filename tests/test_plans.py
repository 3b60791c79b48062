import contextlib
import io
import os

import pytest

import __spark_entry__ as se
from ledgerline.plans import chains, standins
from ledgerline.plans.queries import QUERIES
from ledgerline.sources.files import read_layer, write_layer
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "FlatMapCoGroups",
                "PythonUDF")


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_registered_plans(spark, name):
    text = plan_text(se.queries()[name](spark, SF_SMALL))
    assert not any(n in text for n in PYTHON_NODES), name


def test_status_filter_reaches_parquet_scan(spark, tmp_dir):
    raw = standins.loans_raw(spark.read.parquet(os.path.join(SF_SMALL, "lineitem.parquet")))
    write_layer(raw, f"{tmp_dir}/bronze")
    text = plan_text(chains.loan_silver(read_layer(spark, f"{tmp_dir}/bronze")))
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")][0]
    assert "In(loan_status, [" in pushed


def test_gold_scan_reads_only_needed_columns(spark):
    text = plan_text(se.queries()["loan_gold"](spark, SF_SMALL))
    read_schema = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert "l_suppkey" not in read_schema and "l_shipdate" not in read_schema
    assert "HashAggregate" in text and "partial_avg" in text


def test_reconciliation_is_one_scan(spark):
    assert plan_text(QUERIES["layer_reconcile"](spark, SF_SMALL), "simple").count("FileScan") == 1


def test_small_change_set_is_broadcast(spark):
    text = plan_text(se.queries()["merge_update"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["grade", "loan_status", "loan_count", "avg_loan_amt", "avg_interest_rate",
                          "avg_annual_income", "avg_dti", "total_loan_volume", "risk_tier"]
