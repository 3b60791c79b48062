import datetime as dt

from pyspark.sql import functions as F

from ledgerline import presets
from ledgerline.functions import decode, month_date, safe_double, safe_int, strip_cast, tier
from ledgerline.operators.aggregate import regroup, share, summarise, top_k
from ledgerline.plans import chains


def test_safe_casts(spark):
    df = spark.createDataFrame([(" 36", "13.5%", "Dec-2015", "abc", "36.0")], "a string, b string, c string, d string, e string")
    r = df.select(safe_int("a").alias("a"), strip_cast("b", "%", "double").alias("b"),
                  month_date("c").alias("c"), safe_double("d").alias("d"), safe_int("e").alias("e")).first()
    assert r.a == 36 and r.b == 13.5 and r.c == dt.date(2015, 12, 1) and r.d is None and r.e is None


def test_loan_silver_edge_rows(loans_raw):
    silver = chains.loan_silver(loans_raw)
    rows = {r.id: r for r in silver.collect()}
    assert set(rows) == {"1", "2", "5", None}
    assert rows["1"].int_rate == 7.5 and rows["1"].term_months == 36 and rows["1"].issue_date == dt.date(2015, 12, 1)
    assert rows["2"].int_rate == 13.0 and rows["2"].term_months == 60 and rows["2"].loan_amnt == 20000.5
    assert rows["5"].int_rate is None and rows["5"].dti is None and rows["5"].issue_date is None
    assert rows["5"].term_months == 36
    assert len(silver.columns) == 17


def test_loan_gold_counts_and_tiers(loans_raw):
    gold = chains.loan_gold(chains.loan_silver(loans_raw))
    got = [(r.grade, r.loan_status, r.loan_count, r.risk_tier) for r in gold.collect()]
    # NULL id is not counted; NULL and unknown grades are tier Unknown; sorted by grade, status
    assert got == [
        (None, "Fully Paid", 0, "Unknown"),
        ("A", "Fully Paid", 1, "Low Risk"),
        ("G", "Charged Off", 1, "High Risk"),
        ("Z", "In Grace Period", 1, "Unknown"),
    ]
    a = gold.filter("grade = 'A'").first()
    assert a.avg_loan_amt == 10000.0 and a.total_loan_volume == 10000.0 and a.avg_dti == 10.5


def test_declarative_silver_keeps_rows_without_income(loans_raw):
    ids = {r.id for r in chains.declarative_silver(loans_raw).collect()}
    assert ids == {"1", "2", "4", "5", None}
    assert "avg_annual_income" not in chains.declarative_gold(chains.declarative_silver(loans_raw)).columns


def test_bronze_profile_uses_safe_cast(loans_raw):
    rows = {r.loan_status: r for r in chains.bronze_profile(loans_raw).collect()}
    assert rows["Current"].avg_loan_amount is None and rows["Fully Paid"].loan_count == 2


def test_decode_and_tier_defaults(spark):
    df = spark.createDataFrame([("1",), ("6",), ("9",), (None,)], "c string")
    out = [r[0] for r in df.select(decode("c", presets.ACTION_LABELS, "Other")).collect()]
    assert out == ["Originated", "Incomplete", "Other", "Other"]
    big = {str(i): f"L{i}" for i in range(200)}
    out = [r[0] for r in df.select(decode("c", big, "Other")).collect()]
    assert out == ["L1", "L6", "L9", "Other"]
    t = [r[0] for r in spark.createDataFrame([("A",), ("E",), (None,)], "g string")
         .select(tier("g", presets.RISK_TIERS, "Unknown")).collect()]
    assert t == ["Low Risk", "High Risk", "Unknown"]


def test_mortgage_silver_and_gold(mortgage_raw):
    silver = chains.mortgage_silver(mortgage_raw)
    assert silver.count() == 6
    assert "applicant_race" in silver.columns and len(silver.columns) == 18
    r = silver.filter("loan_purpose = '2'").first()
    assert r.interest_rate is None and r.loan_term is None and r.income is None
    assert r.loan_purpose_label == "Home Improvement" and r.action_label == "Approved Not Accepted"
    assert {x.loan_type_label for x in silver.collect()} == {"Conventional", "FHA", "VA", "USDA", "Other"}
    gold = chains.mortgage_gold(silver)
    tiers = {(x.action_label, x.approval_tier) for x in gold.collect()}
    assert ("Originated", "Approved & Funded") in tiers and ("Denied", "Denied") in tiers
    # ratio text: only '36' and '45%' and '40' parse
    dti = {x.loan_purpose_label: x.avg_dti for x in gold.filter("action_label != 'Originated'").collect()}
    assert dti["Refinancing"] is None and dti["Home Improvement"] == 45.0


def test_rates_topk_regroup(spark):
    df = spark.createDataFrame(
        [("G", "Charged Off"), ("G", "Charged Off"), ("G", "Fully Paid"), ("G", "Current"), ("A", "Current")],
        "grade string, loan_status string")
    r = {x.grade: x for x in share(df, ["grade"], "loan_status = 'Charged Off'",
                                  "loan_status IN ('Charged Off', 'Fully Paid')", name="pct").collect()}
    assert r["G"].pct == 66.7 and r["A"].pct is None and r["G"].denominator_rows == 3
    top = top_k(df, ["loan_status"], 2, "n").collect()
    assert [(x.loan_status, x.n) for x in top] == [("Charged Off", 2), ("Current", 2)]
    s = summarise(df, ["grade"], [("n", "count", "*")])
    g = regroup(s.withColumn("tier", F.lit("t")), ["tier"], [("total", "n")], long_sums=["total"]).first()
    assert g.total == 5


def test_ordered_subset_of_any_size_and_key_type(spark):
    from ledgerline.operators.filters import ordered_subset
    df = spark.range(0, 250000).selectExpr("lpad(cast((id * 7919) % 250000 as string), 6, '0') AS k").repartition(7)
    assert ordered_subset(df, ["k"], 220000).agg(F.max("k"), F.count("*")).first()[:] == ("219999", 220000)
    nulls = spark.range(0, 3000).selectExpr("CASE WHEN id % 100 = 0 THEN NULL ELSE (id * 7919) % 3000 END AS k")
    got = [r.k for r in ordered_subset(nulls, ["k"], 500).collect()]
    assert got[:30] == [None] * 30 and got[30:] == sorted(got[30:])


def test_decode_keeps_its_answers_for_long_maps(spark):
    from ledgerline.functions.codes import decode
    long = {str(i): (None if i == 3 else f"L{i}") for i in range(70)}
    df = spark.createDataFrame([("3",), ("69",), ("x",), (None,)], "c string")
    assert [r[0] for r in df.select(decode("c", long)).collect()] == [None, "L69", "Other", "Other"]


def test_rounded_aggregates_drop_no_value(spark):
    from ledgerline.functions.rounded import rounded_avg, rounded_sum
    small = spark.range(1_000_000).select(F.lit(4e-7).alias("x"))
    assert small.agg(rounded_sum("x", 2)).first()[0] == 0.4
    for big in (1e27, 1e33):
        got = spark.createDataFrame([(1.0,), (big,)], "x double").agg(rounded_avg("x", 2)).first()[0]
        assert got == (1.0 + big) / 2
