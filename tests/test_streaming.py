import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import scratch_path
from ledgerline.plans.standins import assign_batches, land_batch
from ledgerline.streaming.running import prefix_aggregate, run_available_now, run_keyed

SCHEMA = T.StructType([
    T.StructField("application_id", T.StringType(), True), T.StructField("applicant_name", T.StringType(), True),
    T.StructField("loan_amount", T.DoubleType(), True), T.StructField("loan_purpose", T.StringType(), True),
    T.StructField("credit_score", T.IntegerType(), True), T.StructField("annual_income", T.DoubleType(), True),
    T.StructField("dti", T.DoubleType(), True), T.StructField("application_ts", T.TimestampType(), True)])

PURPOSES = ["boat", "school fees", "roof", "garden"]
MEASURES = [("count", "count", "application_id"), ("avg_amount", "avg", "loan_amount"),
            ("avg_score", "avg", "credit_score")]
DIGITS = {"avg_amount": 2, "avg_score": 0}


def _apps(spark):
    rows = []
    base = dt.datetime(2026, 1, 1)
    for i in range(50):
        b = i // 10 + 1
        if b == 1:
            purpose = "car" if i % 2 else "boat"            # 'car' only in batch 1
        else:
            purpose = PURPOSES[i % 4]                        # 'roof' absent in batch 1
        rows.append((f"a{i:03d}", "N", float(5000 + 100 * i), purpose, 600 + i, 50000.0, 20.0,
                     base + dt.timedelta(minutes=i)))
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("seq", F.expr("CAST(substr(application_id, 2) AS BIGINT)"))


def _brute(df, b):
    pre = df.filter(F.col("batch") <= b)
    return {r.loan_purpose: (r["count"], r.avg_amount, r.avg_score) for r in pre.groupBy("loan_purpose").agg(
        F.count("application_id").alias("count"), F.round(F.avg("loan_amount"), 2).alias("avg_amount"),
        F.round(F.avg("credit_score"), 0).alias("avg_score")).collect()}


def test_prefix_aggregate_matches_brute_force(spark):
    df = assign_batches(_apps(spark), "seq", 5, "batch")
    assert [r[0] for r in df.groupBy("batch").count().orderBy("batch").select("count").collect()] == [10] * 5
    out = prefix_aggregate(df, "batch", ["loan_purpose"], MEASURES, 5, DIGITS, out_batch="upto")
    for b in range(1, 6):
        got = {r.loan_purpose: (r["count"], r.avg_amount, r.avg_score)
               for r in out.filter(F.col("upto") == b).collect()}
        assert got == _brute(df, b)
    # a purpose seen only in batch 1 stays in every later prefix
    assert out.filter("loan_purpose = 'car'").count() == 5


def test_available_now_stream_equals_batch_form(spark):
    df = assign_batches(_apps(spark), "seq", 5, "batch")
    root = scratch_path(spark, "test-stream")
    for batch in range(1, 6):      # 10 rows a batch, in more files than rows
        land_batch(df.repartition(16), "batch", batch, f"{root}/landing")
        out = run_available_now(spark, f"{root}/landing", df.schema, ["loan_purpose"], MEASURES,
                                f"{root}/sink", f"{root}/ckpt", digits=DIGITS)
    assert sorted(r[0] for r in out.select("batch_id").distinct().collect()) == [0, 1, 2, 3, 4]
    for b in range(1, 6):
        got = {r.loan_purpose: (r["count"], r.avg_amount, r.avg_score)
               for r in out.filter(F.col("batch_id") == b - 1).collect()}
        assert got == _brute(df, b)


def test_keyed_stream_holds_one_row_per_key(spark):
    df = assign_batches(_apps(spark), "seq", 5, "batch")
    df = df.withColumn("loan_purpose", F.when(F.col("loan_purpose") != "roof", F.col("loan_purpose")))  # a NULL key
    root = scratch_path(spark, "test-keyed")

    def run():
        return run_keyed(spark, f"{root}/landing", df.schema, ["loan_purpose"], MEASURES, f"{root}/sink", f"{root}/ckpt",
                         buckets=3, digits=DIGITS)

    for batch in range(1, 6):
        land_batch(df, "batch", batch, f"{root}/landing")
        out = run()
        rows = out.collect()
        assert {r.loan_purpose: (r["count"], r.avg_amount, r.avg_score) for r in rows} == _brute(df, batch)
        assert len(rows) == len({r.loan_purpose for r in rows})
    # without new files the table stays; the same batch put in again changes nothing
    assert sorted(map(str, run().collect())) == sorted(map(str, rows))
    updates = spark.read.parquet(f"{root}/sink/updates/batch_id=1")
    assert "car" not in {r.loan_purpose for r in updates.collect()}      # only changed keys come


def test_prefix_aggregate_for_many_batches_and_null_keys(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.randint(1, 80), rnd.choice(["a", "b", "c", None]), round(rnd.uniform(0, 1000), 2))
            for _ in range(600)]
    rows.append((80, "late", 5.0))          # a key that appears only in the last batch
    df = spark.createDataFrame(rows, "b int, k string, v double")
    m = [("n", "count", "*"), ("avg_v", "avg", "v"), ("sum_v", "sum", "v")]
    got = {(r.batch, r.k): r for r in prefix_aggregate(df, "b", ["k"], m, 80).collect()}
    want = {}
    for b in range(1, 81):
        for k in {r[1] for r in rows if r[0] <= b}:
            want[(b, k)] = [r[2] for r in rows if r[0] <= b and r[1] == k]
    assert got.keys() == want.keys()
    for key, vals in want.items():
        r = got[key]
        assert r.n == len(vals) and abs(r.sum_v - sum(vals)) < 1e-6 and abs(r.avg_v - sum(vals) / len(vals)) < 1e-6
