import os

from pyspark.sql import functions as F

from ledgerline import presets
from ledgerline.operators.policy import (create_reader_view, drop_reader_view, masked_view, read_as, region_policy,
                                         row_policy)
from ledgerline.operators.quality import (expectation_report, layer_counts, observe_expectations, reconcile,
                                          reconcile_rows, source_shape)
from ledgerline.plans import chains
from ledgerline.sources import files
from tests.conftest import SF_SMALL


def test_expectations_before_filter(loans_raw):
    typed = chains.declarative_typed(loans_raw)
    rep = {r.expectation: r for r in expectation_report(typed, presets.LOAN_EXPECTATIONS).collect()}
    # 'abc' amount and the footer row have no amount; 'Other status' and the footer fail the list
    assert rep["valid_loan_amount"].failed_rows == 2 and rep["valid_loan_amount"].total_rows == 8
    assert rep["valid_loan_status"].failed_rows == 2
    observed, obs = observe_expectations(typed, presets.LOAN_EXPECTATIONS)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["valid_loan_amount"] == 2 and obs.get["total_rows"] == 8


def test_reconcile_layers(loans_raw):
    silver = chains.loan_silver(loans_raw)
    gold = chains.loan_gold(silver, order=False)
    rec = {r.measure: r.value for r in reconcile(loans_raw, silver, gold, "loan_count").collect()}
    assert rec == {"bronze_rows": 8, "silver_rows": 4, "gold_rows": 4, "gold_count_sum": 3,
                   "dropped_rows": 4, "gold_matches_silver": 0}
    one = chains.loan_typed(loans_raw)
    one = reconcile_rows(one, chains.loan_kept(), ["grade", "loan_status"], "id")
    assert {r.measure: r.value for r in one.collect()} == rec
    assert {r.value for r in reconcile_rows(chains.loan_typed(loans_raw.limit(0)), chains.loan_kept(), ["grade"], "id")
            .where("measure <> 'gold_matches_silver'").collect()} == {0}
    lc = {r.layer: r.row_count for r in layer_counts({"bronze": loans_raw, "silver": silver}).collect()}
    assert lc == {"bronze": 8, "silver": 4}


def test_masking_and_row_policy(spark):
    cust = spark.read.parquet(os.path.join(SF_SMALL, "customer.parquet"))
    m = masked_view(cust, {"c_name": "mask", "c_mktsegment": "last4"}).first()
    assert m.c_name == "Xxxxxxxx#nnnnnnnnn" and m.c_mktsegment.endswith(cust.first().c_mktsegment[-4:])
    nation = spark.read.parquet(os.path.join(SF_SMALL, "nation.parquet"))
    region = spark.read.parquet(os.path.join(SF_SMALL, "region.parquet"))
    eu = region_policy(cust, nation, region, "EUROPE")
    allowed = {r.n_nationkey for r in nation.join(region, nation.n_regionkey == region.r_regionkey)
               .filter("r_name = 'EUROPE'").collect()}
    assert eu.count() == cust.filter(F.col("c_nationkey").isin(list(allowed))).count() > 0
    assert row_policy(cust, cust.limit(0), "c_custkey").count() == 0
    import hashlib
    first = cust.orderBy("c_custkey").first()
    hashed = masked_view(cust, {"c_name": "sha256", "c_mktsegment": "redact"}).orderBy("c_custkey").first()
    assert hashed.c_name == hashlib.sha256(first.c_name.encode()).hexdigest() and hashed.c_mktsegment == "****"
    assert hashed.c_acctbal == first.c_acctbal


def test_csv_roundtrip_and_export(spark, tmp_dir, loans_raw):
    files.write_csv(loans_raw.coalesce(1), f"{tmp_dir}/raw")
    assert [n for n in os.listdir(f"{tmp_dir}/raw") if n.endswith(".csv.gz")]
    # one unsplittable gzip file: spread over 4 tasks right after the scan
    back = files.read_raw_csv(spark, f"{tmp_dir}/raw", partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert set(back.columns) == set(loans_raw.columns) and dict(back.dtypes)["loan_amnt"] == "string"
    assert back.count() == loans_raw.count()
    assert back.filter("id = '1'").first().term == " 36 months"      # raw text kept verbatim
    gold = chains.loan_chain(loans_raw)
    rows = files.export_tables({"loan_risk": gold}, f"{tmp_dir}/export", files=1)
    assert {n: d.rows for n, d in rows.items()} == {"loan_risk": 4}
    man = files.export_manifest(spark, f"{tmp_dir}/export", ["loan_risk"]).collect()
    assert len(man) == 1 and man[0].rows == 4 and man[0].file_size > 0
    ver = files.verify_export(spark, f"{tmp_dir}/export", rows).first()
    assert ver.matches and ver.digest_matches


def test_stored_loan_chain(spark, tmp_dir, loans_raw):
    files.write_csv(loans_raw, f"{tmp_dir}/raw")
    run = chains.run_loan_chain(spark, f"{tmp_dir}/raw", f"{tmp_dir}/layers", partitions=2)
    assert run.rows == {"bronze": 8, "silver": 4, "gold": 4}
    assert files.read_layer(spark, run.paths["gold"]).count() == 4


def test_source_shape(loans_raw):
    r = source_shape(loans_raw, "raw").first()
    assert (r.source, r.row_count, r.column_count) == ("raw", 8, 15)


def test_namespace_and_typed_table(spark, loans_raw):
    files.ensure_namespace(spark, "bronze")
    files.create_table_if_missing(spark, "bronze.loan_applications_stream",
                                  "application_id STRING, applicant_name STRING, loan_amount DOUBLE, "
                                  "loan_purpose STRING, credit_score INT, annual_income DOUBLE, dti DOUBLE, "
                                  "application_ts TIMESTAMP")
    files.create_table_if_missing(spark, "bronze.loan_applications_stream", "x INT")
    t = spark.table("bronze.loan_applications_stream")
    assert t.count() == 0 and dict(t.dtypes)["credit_score"] == "int"
    n = files.write_layer(loans_raw, "bronze.loans_raw")
    assert n == 8 and files.read_layer(spark, "bronze.loans_raw").count() == 8
    files.write_layer(loans_raw, "bronze.loans_raw", mode="append")
    assert spark.table("bronze.loans_raw").count() == 16


def test_export_writes_the_files_the_caller_asks_for(spark, tmp_dir):
    df = spark.range(0, 1000).repartition(4)
    assert files.export_parquet(df, f"{tmp_dir}/big").rows == 1000
    parts = [n for n in os.listdir(f"{tmp_dir}/big") if n.endswith(".parquet")]
    assert len(parts) == 4
    assert files.export_parquet(df, f"{tmp_dir}/small", files=1) == files.export_parquet(df, f"{tmp_dir}/more", files=3)
    assert len([n for n in os.listdir(f"{tmp_dir}/small") if n.endswith(".parquet")]) == 1


def test_one_changed_cell_breaks_the_digest(spark, tmp_dir):
    rows = [(1, "a", None, {"k": 1}), (2, None, 2.5, None), (2, None, 2.5, None), (3, "", 0.0, {})]
    df = spark.createDataFrame(rows, "id int, name string, v double, m map<string,int>")
    digest = files.export_tables({"t": df.repartition(3)}, tmp_dir)
    assert files.verify_export(spark, tmp_dir, digest).first().digest_matches

    def verified(changed):
        changed.write.mode("overwrite").parquet(f"{tmp_dir}/t")
        return files.verify_export(spark, tmp_dir, digest).first()

    assert verified(df.coalesce(1).orderBy("v")).digest_matches                    # order and files do not count
    for column, value in (("name", F.lit("x")), ("v", F.lit(None).cast("double")), ("m", F.create_map(F.lit("k"), F.lit(2)))):
        changed = spark.createDataFrame(rows, df.schema).withColumn(
            column, F.when(F.col("id") == 1, value).otherwise(F.col(column)))
        if column != "v":
            row = verified(changed)
            assert row.matches and not row.digest_matches, column
    swapped = spark.createDataFrame([(1, None, None, {"k": 1}), *rows[1:3], (3, "", 0.0, {})], df.schema)
    assert not verified(swapped).digest_matches
    other = spark.createDataFrame([rows[0], rows[3], rows[3], rows[3]], df.schema)  # equal pairs cancel in the xor only
    assert not verified(other).digest_matches
    empty = files.export_tables({"e": df.limit(0)}, tmp_dir)
    assert files.verify_export(spark, tmp_dir, empty).first().digest_matches


def test_lines_that_do_not_fit_are_kept_aside(spark, tmp_dir):
    with open(f"{tmp_dir}/in.csv", "w") as f:
        f.write('id,name,amount\n1,a,10\n2,b\n3,"c, with comma",30\n4,d,40,surplus\n5,,\n\n6\n')
    n = files.land_csv(spark, f"{tmp_dir}/in.csv", ["id", "name", "amount"], f"{tmp_dir}/bronze")
    good = files.landed_rows(spark, f"{tmp_dir}/bronze").orderBy("id").collect()
    assert [tuple(r) for r in good] == [("1", "a", "10"), ("3", "c, with comma", "30"), ("5", None, None)]
    bad = sorted(r.line for r in files.landed_rejects(spark, f"{tmp_dir}/bronze").collect())
    assert bad == ["2,b", "4,d,40,surplus", "6"] and n == 6


def test_one_view_answers_two_groups(spark):
    rows = spark.createDataFrame([(1, "ann", 10), (2, "bob", 20), (3, "cyd", None)], "id int, name string, nation int")
    allowed = spark.createDataFrame([(10, "x"), (20, "y"), (20, "x"), (20, "x")], "nation int, team string")
    create_reader_view(spark, "seen", rows, allowed, "nation", "team", "team_of_reader", {"name": "redact"})
    x, y = read_as(spark, "seen", "team_of_reader", "x"), read_as(spark, "seen", "team_of_reader", "y")
    nobody, quoted = read_as(spark, "seen", "team_of_reader", None), read_as(spark, "seen", "team_of_reader", "x' OR '1'='1")
    both = x.withColumn("t", F.lit("x")).unionByName(y.withColumn("t", F.lit("y")))
    drop_reader_view(spark, "seen", "team_of_reader")
    assert sorted((r.id, r.name, r.t) for r in both.collect()) == [(1, "****", "x"), (2, "****", "x"), (2, "****", "y")]
    assert nobody.count() == quoted.count() == 0
    assert not spark.catalog.tableExists("seen")


def test_amounts_in_cents(spark):
    """Averages and sums of amounts with cents, against exact arithmetic at a
    tolerance of half a cent."""
    from decimal import Decimal
    import random
    rnd = random.Random(3)
    cents = [rnd.randint(1, 10 ** 9) for _ in range(5000)]
    rows = [(str(i), rnd.choice("AB"), f"{c / 100:.2f}") for i, c in enumerate(cents)]
    df = spark.createDataFrame(rows, "id string, grade string, loan_amnt string").withColumn(
        "loan_amnt", F.col("loan_amnt").cast("double")).repartition(7)
    from ledgerline.operators.aggregate import summarise
    got = {r.grade: r for r in summarise(df, ["grade"], [("a", "avg", "loan_amnt"), ("s", "sum", "loan_amnt")]).collect()}
    for grade in "AB":
        own = [Decimal(t) for _, g, t in rows if g == grade]
        assert abs(Decimal(got[grade].s) - sum(own)) <= Decimal("0.005")
        assert abs(Decimal(got[grade].a) - sum(own) / len(own)) <= Decimal("0.0051")
