import os

from examples.lakehouse_run import run
from ledgerline.plans import standins
from ledgerline.sources.files import write_csv
from tests.conftest import SF_SMALL


def test_lakehouse_run_from_csv(spark, tmp_dir):
    li = spark.read.parquet(os.path.join(SF_SMALL, "lineitem.parquet"))
    write_csv(standins.loans_raw(li), f"{tmp_dir}/loans_csv")
    write_csv(standins.mortgage_raw(li), f"{tmp_dir}/mortgages_csv")
    out = run(spark, f"{tmp_dir}/loans_csv", f"{tmp_dir}/mortgages_csv", f"{tmp_dir}/out", partitions=4)
    n = li.count()
    assert out["loans"]["bronze"] == n == out["mortgages"]["bronze"]
    checks = out["loan_checks"]
    assert checks["silver_rows"] == out["loans"]["silver"] and checks["dropped_rows"] == n - checks["silver_rows"]
    assert checks["gold_matches_silver"] == 1 and out["export_verified"]
    assert out["exported"] == {"loan_risk": out["loans"]["gold"], "mortgage_risk": out["mortgages"]["gold"]}
