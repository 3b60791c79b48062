import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import presets
from ledgerline.functions.text import fill_template, money
from ledgerline.operators import prompts as pr

TEST_VARIABLES = {
    "grade": "D", "risk_tier": "Medium Risk", "loan_status": "Fully Paid", "loan_count": 12,
    "avg_loan_amt": 9876.25, "avg_interest_rate": 17.5, "avg_dti": 21.04, "total_loan_volume": 118515.0,
}

SEG_SCHEMA = T.StructType([
    T.StructField("grade", T.StringType()), T.StructField("risk_tier", T.StringType()),
    T.StructField("loan_status", T.StringType()), T.StructField("loan_count", T.LongType()),
    T.StructField("avg_loan_amt", T.DoubleType()), T.StructField("avg_interest_rate", T.DoubleType()),
    T.StructField("avg_dti", T.DoubleType()), T.StructField("total_loan_volume", T.DoubleType())])


def _segments(spark):
    return spark.createDataFrame([tuple(TEST_VARIABLES[f.name] for f in SEG_SCHEMA.fields)], SEG_SCHEMA)


def test_render_equals_python_format(spark):
    out = pr.render_prompts(_segments(spark), list(presets.PROMPT_REGISTRY)).collect()
    assert len(out) == 2
    for r in out:
        expected = presets.PROMPT_REGISTRY[r.prompt_version]["template"].format(**TEST_VARIABLES)
        assert r.prompt == expected
        assert r.model == presets.DEFAULT_MODEL


def test_render_null_fields_and_unknown_version(spark):
    seg = _segments(spark).withColumn("avg_loan_amt", F.lit(None).cast("double"))
    text = seg.select(fill_template("Amt: ${avg_loan_amt:,.2f} / {grade}").alias("t")).first().t
    assert text == "Amt: $n/a / D"
    with pytest.raises(KeyError):
        pr.render_prompts(seg, ["nope"])
    with pytest.raises(ValueError):
        fill_template("{x:>10}")
    assert seg.select(money(F.lit(1234.5))).first()[0] == "$1,234.50"


def test_token_cost_worked_example(spark):
    calls = spark.createDataFrame([("risk_narrative_v1.0", presets.DEFAULT_MODEL, 123, 77)],
                                  "prompt_version string, model string, input_tokens int, output_tokens int")
    r = pr.token_cost(calls).first()
    assert r.total_tokens == 200 and r.cost_usd == 0.001524


def test_token_cost_unknown_model_fails(spark):
    calls = spark.createDataFrame([("v", "other-model", 1, 1)],
                                  "prompt_version string, model string, input_tokens int, output_tokens int")
    with pytest.raises(Exception, match="no price for model"):
        pr.token_cost(calls).collect()


def test_version_compare_and_cost_by_version(spark):
    calls = spark.createDataFrame([
        ("a", presets.DEFAULT_MODEL, 100, 100), ("a", presets.DEFAULT_MODEL, 200, 0),
        ("b", presets.DEFAULT_MODEL, 1000, 1000)],
        "prompt_version string, model string, input_tokens int, output_tokens int")
    costs = pr.token_cost(calls)
    by = {r.prompt_version: r for r in pr.cost_by_version(costs).collect()}
    assert by["a"].calls == 2 and by["a"].total_tokens == 400 and by["a"].total_cost_usd == 0.0024
    cmp = pr.version_compare(costs, "a", "b").first()
    assert cmp.calls_a == 2 and cmp.calls_b == 1 and cmp.cost_difference == round(0.018 - 0.0024, 6)


def test_estimate_tokens(spark):
    df = spark.createDataFrame([("abcd",), ("abcde",), ("",)], "text string")
    assert [r[0] for r in df.select(pr.estimate_tokens("text")).collect()] == [1, 2, 0]


def test_generate_runs_per_partition(spark):
    def _stub_factory():  # nested so it is shipped to the workers by value
        def client(prompts, max_tokens):
            return [(f"narrative for {p.splitlines()[2]}", len(p) // 4, 10) for p in prompts]
        return client

    seg = _segments(spark).union(_segments(spark).withColumn("grade", F.lit("B"))).repartition(2)
    prompts = pr.render_prompts(seg, ["risk_narrative_v1.0"], keep=["grade", "loan_status", "risk_tier"])
    out = pr.generate(prompts, _stub_factory, batch_size=1).collect()
    assert sorted(r.narrative for r in out) == ["narrative for Grade: B", "narrative for Grade: D"]
    assert all(r.output_tokens == 10 and r.duration_ms >= 0 and r.started_at is not None for r in out)
    assert dict(pr.generate(prompts, _stub_factory).dtypes)["input_tokens"] == "int"


def test_calls_spread_over_tasks_and_get_the_output_limit(spark):
    def factory():
        from pyspark import TaskContext

        def client(prompts, max_tokens):
            return [(f"{TaskContext.get().partitionId()}", 1, max_tokens) for _ in prompts]
        return client

    seg = spark.range(16).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt")).coalesce(1)
    out = pr.generate(seg, factory, partitions=4).collect()
    assert len(out) == 16 and len({r.narrative for r in out}) > 1
    assert {r.output_tokens for r in out} == {presets.NARRATIVE_MAX_TOKENS}


def test_version_compare_of_durations(spark):
    calls = spark.createDataFrame([("a", presets.DEFAULT_MODEL, 1, 1, 10.5), ("b", presets.DEFAULT_MODEL, 1, 1, 30.0)],
                                  "prompt_version string, model string, input_tokens int, output_tokens int, duration_ms double")
    row = pr.version_compare(pr.token_cost(calls), "a", "b").first()
    assert (row.duration_ms_a, row.duration_ms_b, row.duration_difference_ms) == (10.5, 30.0, 19.5)


def test_registry_frame_renders_as_the_mapping_does(spark):
    seg = _segments(spark).union(_segments(spark).withColumn("grade", F.lit("{loan_count} \\ $1"))).withColumn(
        "avg_loan_amt", F.when(F.col("grade") == "D", F.col("avg_loan_amt")))
    versions, keep = list(presets.PROMPT_REGISTRY), ["grade", "loan_status"]
    want = {tuple(r) for r in pr.render_prompts(seg, versions, keep=keep).collect()}
    got = {tuple(r) for r in pr.render_prompts(seg, versions, pr.registry_frame(spark), keep=keep).collect()}
    assert got == want and len(got) == 4
    with pytest.raises(Exception, match="prompt version not in registry: nope"):
        pr.render_prompts(seg, ["nope"], pr.registry_frame(spark)).collect()
    other = spark.createDataFrame([("x", "1", "m", "", "", "a {unknown}")], pr.REGISTRY_SCHEMA)
    with pytest.raises(Exception, match="no value for placeholder"):
        pr.render_prompts(seg, ["x"], other).collect()


def test_price_of_the_day_counts(spark):
    prices = spark.createDataFrame([("m", 1.0, 2.0, None), ("m", 10.0, 20.0, "2026-03-01"), ("n", 5.0, 5.0, "2026-01-01")],
                                   "model string, input_cost_per_1k double, output_cost_per_1k double, valid_from string")
    prices = prices.withColumn("valid_from", F.to_timestamp("valid_from"))
    calls = spark.createDataFrame([("m", 1000, 0, "2026-02-28"), ("m", 1000, 0, "2026-03-01"), ("m", 0, 1000, "2027-01-01"),
                                   ("n", 1000, 1000, "2026-01-01")],
                                  "model string, input_tokens int, output_tokens int, at string")
    calls = calls.withColumn("at", F.to_timestamp("at"))
    got = [r.cost_usd for r in pr.token_cost(calls, prices, at_col="at").collect()]
    assert sorted(got) == [1.0, 10.0, 10.0, 20.0]
    assert {r.cost_usd for r in pr.token_cost(calls.where("model = 'm' and input_tokens > 0"), prices).collect()} == {10.0}
    early = calls.where("model = 'n'").withColumn("at", F.to_timestamp(F.lit("2025-12-31")))
    with pytest.raises(Exception, match="no price for model: n"):
        pr.token_cost(early, prices, at_col="at").collect()
    with pytest.raises(Exception, match="two prices of one time"):
        pr.token_cost(calls, prices.union(prices.where("model = 'n'")), at_col="at").collect()
    assert pr.token_cost(calls, prices, at_col="at").columns == [*calls.columns, "total_tokens", "cost_usd"]


def test_a_second_run_makes_no_call(spark, tmp_dir):
    def factory():
        def client(prompts, max_tokens):
            return [(p.upper(), 1, 2) for p in prompts]
        return client

    def dead():
        def client(prompts, max_tokens):
            raise AssertionError("called again")
        return client

    prompts = spark.createDataFrame([("v", "m", "a"), ("v", "m", "a"), ("v", "m", "b"), (None, "m", "a")],
                                    "prompt_version string, model string, prompt string")
    store = f"{tmp_dir}/calls"
    first = pr.generate_missing(prompts.where("prompt = 'b'"), factory, store, run="1").collect()
    assert [(r.narrative, r.run) for r in first] == [("B", "1")]
    assert spark.read.parquet(store).count() == 1
    both = pr.generate_missing(prompts, factory, store, run="2").collect()
    assert sorted((r.prompt, r.narrative, r.run) for r in both) == [("a", "A", "2")] * 3 + [("b", "B", "1")]
    assert spark.read.parquet(store).count() == 3          # equal calls are made once
    again = pr.generate_missing(prompts, dead, store, run="3", max_retries=0).collect()
    assert sorted((r.prompt, r.narrative, r.run) for r in again) == sorted((r.prompt, r.narrative, r.run) for r in both)
    with pytest.raises(Exception, match="called again"):   # another output limit is another call
        pr.generate_missing(prompts, dead, store, max_tokens=5, max_retries=0).collect()
    assert pr.generate_missing(prompts.limit(0), dead, store).count() == 0


def test_registry_and_price_frames(spark):
    reg = pr.registry_frame(spark)
    assert reg.count() == 2 and set(reg.columns) >= {"prompt_version", "template", "model"}
    assert pr.price_frame(spark).first().output_cost_per_1k == 0.015


def test_narrative_table_and_cost_log(spark, tmp_dir):
    def factory():
        def client(prompts, max_tokens):
            return [("Segment narrative.", 100, 20) for _ in prompts]
        return client

    gold = _segments(spark).union(_segments(spark).withColumn("loan_status", F.lit("Current")))
    narr = pr.narrate_segments(gold, factory)
    rows = narr.collect()
    assert len(rows) == 1 and rows[0].ai_risk_narrative == "Segment narrative."
    assert rows[0].cost_usd == round(0.1 * 0.003 + 0.02 * 0.015, 6)
    pr.write_cost_log(narr, f"{tmp_dir}/cost_log")
    pr.write_cost_log(narr, f"{tmp_dir}/cost_log")
    log = spark.read.parquet(f"{tmp_dir}/cost_log")
    assert log.count() == 2 and "narrative" in log.columns


def test_segment_prompt_keeps_its_indented_blank_line(spark):
    text = _segments(spark).select(fill_template(presets.SEGMENT_NARRATIVE_TEMPLATE).alias("t")).first().t
    assert text == presets.SEGMENT_NARRATIVE_TEMPLATE.format(**TEST_VARIABLES)
    assert text.splitlines()[1] == "    "


def test_generate_retries_transient_failures(spark):
    def factory():
        state = {"calls": 0}

        def client(prompts, max_tokens):
            state["calls"] += 1
            if state["calls"] % 2 == 1:
                raise ConnectionError("transient")
            return [("ok", 1, 1) for _ in prompts]
        return client

    prompts = pr.render_prompts(_segments(spark), ["risk_narrative_v1.0"], keep=["grade"])
    out = pr.generate(prompts, factory, backoff_s=0.01).collect()
    assert [r.narrative for r in out] == ["ok"]
