"""Run both loan chains from raw CSV files to stored layers, reconcile them,
and export the gold tables -- the whole nightly job as library calls.

usage: python examples/lakehouse_run.py LOANS_CSV MORTGAGES_CSV OUTPUT_ROOT [PARTITIONS]

CSV inputs may be gzip; ``OUTPUT_ROOT`` should be shared storage on a
cluster.  Prints one JSON line of row counts.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline import (build_session, export_tables, read_layer, reconcile,  # noqa: E402
                        run_loan_chain, run_mortgage_chain, verify_export)


def run(spark, loans_csv: str, mortgages_csv: str, root: str, partitions: int | None = None) -> dict:
    root = root.rstrip("/")
    loans = run_loan_chain(spark, loans_csv, f"{root}/loans", partitions)
    mortgages = run_mortgage_chain(spark, mortgages_csv, f"{root}/mortgages", partitions)
    checks = reconcile(read_layer(spark, loans.paths["bronze"]), read_layer(spark, loans.paths["silver"]),
                       read_layer(spark, loans.paths["gold"]), gold_count_col="loan_count")
    exported = export_tables({"loan_risk": read_layer(spark, loans.paths["gold"]),
                              "mortgage_risk": read_layer(spark, mortgages.paths["gold"])}, f"{root}/export", files=1)
    verified = all(r.matches and r.digest_matches for r in verify_export(spark, f"{root}/export", exported).collect())
    return {
        "loans": loans.rows,
        "mortgages": mortgages.rows,
        "loan_checks": {r.measure: r.value for r in checks.collect()},
        "exported": {name: d.rows for name, d in exported.items()},
        "export_verified": verified,
    }


def main() -> None:
    if len(sys.argv) < 4:
        raise SystemExit(__doc__)
    parts = int(sys.argv[4]) if len(sys.argv) > 4 else None
    spark = build_session()
    print(json.dumps(run(spark, sys.argv[1], sys.argv[2], sys.argv[3], parts)))


if __name__ == "__main__":
    main()
