"""The declarative definitions, registered into an in-process graph and run
flow by flow against the test session."""

import os

from pyspark.pipelines.graph_element_registry import GraphElementRegistry, graph_element_registration_context

from ledgerline import presets
from ledgerline.plans import chains, declarative, standins
from ledgerline.sources.files import write_csv
from tests.conftest import SF_SMALL


class Recorder(GraphElementRegistry):
    def __init__(self):
        self.outputs, self.flows = [], []

    def register_output(self, output):
        self.outputs.append(output)

    def register_flow(self, flow):
        self.flows.append(flow)

    def register_sql(self, sql_text, file_path):
        raise AssertionError("no SQL definitions expected")


def test_pipeline_definitions_run_in_order(spark, tmp_dir):
    li = spark.read.parquet(os.path.join(SF_SMALL, "lineitem.parquet"))
    raw = standins.loans_raw(li)
    write_csv(raw, f"{tmp_dir}/landing")
    rec = Recorder()
    with graph_element_registration_context(rec):
        declarative.define_loan_pipeline(spark, f"{tmp_dir}/landing", partitions=4)
    assert [o.name for o in rec.outputs] == [declarative.BRONZE, declarative.SILVER,
                                             declarative.EXPECTATIONS, declarative.GOLD]
    results = {}
    for flow in rec.flows:                          # definition order is a valid dependency order here
        df = flow.func()
        df.createOrReplaceTempView(flow.target)
        results[flow.target] = df
    expected_gold = chains.declarative_gold(chains.declarative_silver(results[declarative.BRONZE]))
    assert sorted(results[declarative.GOLD].collect()) == sorted(expected_gold.collect())
    rep = {r.expectation: r.total_rows for r in results[declarative.EXPECTATIONS].collect()}
    assert set(rep) == set(presets.LOAN_EXPECTATIONS) and set(rep.values()) == {li.count()}
