"""Registered queries over the driver's tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables (or data Spark derives from them).  Queries that exercise sinks
(CSV, layers, exports, snapshots, streams) write under the session's shared
checkpoint folder first and return a read of what they wrote.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import presets
from ledgerline.functions.codes import tier
from ledgerline.operators import changes as ch
from ledgerline.operators import prompts as pr
from ledgerline.operators.aggregate import regroup, summarise
from ledgerline.operators.filters import ordered_subset
from ledgerline.operators.policy import create_reader_view, drop_reader_view, masked_view, read_as, region_policy
from ledgerline.operators.quality import expectation_report, reconcile_rows, source_shape
from ledgerline.plans import chains, standins
from ledgerline.session import default_parallelism, scratch_path, table_path
from ledgerline.sources.files import (create_table_if_missing, ensure_namespace, export_manifest, export_tables,
                                      land_csv, landed_rejects, landed_rows, read_layer, read_raw_csv, verify_export,
                                      write_csv, write_layer)
from ledgerline.streaming.running import prefix_aggregate, run_available_now, run_keyed

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf, name))


# --- stand-in parameters (not reference values) --------------------------------

# Order priorities as risk grades for the order-based gold summary.
ORDER_PRIORITY_TIERS = [
    (["1-URGENT", "2-HIGH"], "High Risk"),
    (["3-MEDIUM"], "Medium Risk"),
    (["4-NOT SPECIFIED", "5-LOW"], "Low Risk"),
]
STREAM_BATCHES = 5
CHANGE_AT = _dt.datetime(2026, 6, 20, 12, 0, 0)
POLICY_REGION = "EUROPE"
DEV_SUBSET_ROWS = 1000


def loans_raw(spark, sf):
    return standins.loans_raw(_t(spark, sf, "lineitem"))


def mortgage_raw(spark, sf):
    return standins.mortgage_raw(_t(spark, sf, "lineitem"))


# --- loan chain -----------------------------------------------------------------

def q_gold_summary(spark, sf):
    orders = _t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("grade"),
        F.col("o_orderstatus").alias("loan_status"), F.col("o_totalprice").alias("loan_amnt"))
    g = summarise(orders, ["grade", "loan_status"], [
        ("loan_count", "count", "id"),
        ("avg_loan_amt", "avg", "loan_amnt"),
        ("total_loan_volume", "sum", "loan_amnt"),
    ])
    return g.withColumn("risk_tier", tier("grade", ORDER_PRIORITY_TIERS)).orderBy("grade", "loan_status")


def q_silver_clean(spark, sf):
    return chains.loan_silver(loans_raw(spark, sf))


def q_silver_profile(spark, sf):
    return chains.silver_profile(chains.loan_silver(loans_raw(spark, sf)))


def q_bronze_profile(spark, sf):
    return chains.bronze_profile(loans_raw(spark, sf))


def q_loan_gold(spark, sf):
    return chains.loan_chain(loans_raw(spark, sf))


def land_raw(spark, source: DataFrame, derive: Callable[[DataFrame], DataFrame], path: str) -> None:
    """Land raw text the way an upstream export does: gzip CSV, one file per
    writer task.  The (numeric, narrow) source rows are spread first so the
    text derivation and compression run in parallel."""
    write_csv(derive(source.repartition(default_parallelism(spark))), path)


def q_loan_chain_e2e(spark, sf):
    """Raw text lands as gzip CSV, then bronze, silver and gold are written
    as layers and gold is read back."""
    root = scratch_path(spark, "loan-chain")
    land_raw(spark, _t(spark, sf, "lineitem"), standins.loans_raw, f"{root}/raw")
    run = chains.run_loan_chain(spark, f"{root}/raw", root,
                                partitions=default_parallelism(spark))
    return read_layer(spark, run.paths["gold"])


def q_declarative_gold(spark, sf):
    return chains.declarative_gold(chains.declarative_silver(loans_raw(spark, sf)))


def q_expectation_report(spark, sf):
    return expectation_report(chains.declarative_typed(loans_raw(spark, sf)), presets.LOAN_EXPECTATIONS)


def q_bronze_validation(spark, sf):
    """Expectations on the raw text itself, before any cast or filter."""
    return expectation_report(loans_raw(spark, sf), presets.BRONZE_LOAN_EXPECTATIONS)


def q_layer_reconcile(spark, sf):
    return reconcile_rows(chains.loan_typed(loans_raw(spark, sf)), chains.loan_kept(), ["grade", "loan_status"], "id")


def q_gold_readback(spark, sf):
    """The validation read of the stored gold: finished loans by tier."""
    path = scratch_path(spark, "gold")
    write_layer(chains.loan_gold(chains.loan_silver(loans_raw(spark, sf)), order=False), path)
    return chains.gold_readback(read_layer(spark, path))


def q_default_rate(spark, sf):
    return chains.default_rate(chains.loan_silver(loans_raw(spark, sf)))


def q_gold_regroup(spark, sf):
    gold = chains.loan_gold(chains.loan_silver(loans_raw(spark, sf)), order=False)
    out = regroup(gold, ["grade", "risk_tier"],
                  [("total_loans", "loan_count"), ("total_volume", "total_loan_volume")],
                  long_sums=["total_loans"], digits=2)
    return out.orderBy("grade")


# --- mortgage chain -------------------------------------------------------------

def q_rename_dashed(spark, sf):
    return chains.mortgage_projection(mortgage_raw(spark, sf))


def q_label_decode(spark, sf):
    return chains.mortgage_silver(mortgage_raw(spark, sf))


def q_label_profile(spark, sf):
    return chains.label_profile(chains.mortgage_silver(mortgage_raw(spark, sf)))


def q_gold_three_key(spark, sf):
    return chains.mortgage_chain(mortgage_raw(spark, sf))


def q_combo_topk(spark, sf):
    return chains.code_combinations(mortgage_raw(spark, sf), 10)


def q_denial_rate(spark, sf):
    return chains.denial_rate(chains.mortgage_silver(mortgage_raw(spark, sf)))


def q_denial_rate_by_group(spark, sf):
    silver = chains.mortgage_silver(mortgage_raw(spark, sf)).withColumn("income_band", chains.income_band())
    return chains.denial_rate(silver, ["applicant_race", "income_band"])


def q_mortgage_quality(spark, sf):
    """Share of kept applications whose fields are usable: unparseable ratio
    text (ranges such as 20%-<30%) silently drops out of avg_dti, so report it."""
    return expectation_report(chains.mortgage_silver(mortgage_raw(spark, sf)), presets.MORTGAGE_EXPECTATIONS)


def q_mortgage_chain_e2e(spark, sf):
    root = scratch_path(spark, "mortgage-chain")
    land_raw(spark, _t(spark, sf, "lineitem"), standins.mortgage_raw, f"{root}/raw")
    run = chains.run_mortgage_chain(spark, f"{root}/raw", root,
                                    partitions=default_parallelism(spark))
    return read_layer(spark, run.paths["gold"])


# --- sources and sinks ------------------------------------------------------------

def q_ordered_subset(spark, sf):
    return ordered_subset(_t(spark, sf, "orders"), ["o_orderkey"], DEV_SUBSET_ROWS)


def q_bronze_csv_roundtrip(spark, sf):
    """Customer table through a gzip CSV file: all columns come back as
    text and are re-typed with safe casts."""
    cust = _t(spark, sf, "customer")
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(cust, path)
    raw = read_raw_csv(spark, path, partitions=default_parallelism(spark))
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in cust.schema.fields])


def _exported(spark, sf, *names):
    root = scratch_path(spark, "export")
    loan = f"{root}/gold/loan"
    if {"loan_risk", "narratives"} & set(names):
        write_layer(chains.loan_gold(chains.loan_silver(loans_raw(spark, sf)), order=False), loan)
    golds = {"loan_risk": lambda: read_layer(spark, loan),
             "mortgage_risk": lambda: chains.mortgage_gold(chains.mortgage_silver(mortgage_raw(spark, sf)), order=False),
             "narratives": lambda: pr.store_narratives(
                 pr.narrate_segments(read_layer(spark, loan), standins.counting_client,
                                     partitions=default_parallelism(spark)), f"{root}/gold/narratives")}
    return root, export_tables({n: golds[n]() for n in names}, root, files=1)


EXPORTS = ("loan_risk", "mortgage_risk", "narratives")


def q_catalog_layers(spark, sf):
    """A layer kept by catalog name: namespace, typed empty table, full-refresh
    write, append, read.  The namespace goes once its rows are read back."""
    orders = _t(spark, sf, "orders")
    space, out = f"ledger_{uuid.uuid4().hex[:12]}", scratch_path(spark, "catalog-read")
    ensure_namespace(spark, space, scratch_path(spark, "catalog"))
    try:
        name = f"{space}.orders"
        create_table_if_missing(spark, name, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema))
        pending = F.coalesce(F.col("o_orderstatus") == "P", F.lit(False))
        write_layer(orders.filter(~pending), name, "overwrite")
        write_layer(orders.filter(pending), name, "append")
        write_layer(read_layer(spark, name), out)
    finally:
        spark.sql(f"DROP NAMESPACE IF EXISTS {space} CASCADE")
    return read_layer(spark, out)


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _landed_customers(spark, sf):
    """Customer lines as text, some of them broken: every seventh key lacks its
    last two fields, every eleventh has one too many."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CUSTOMER_COLUMNS]
    key = F.col("c_custkey")
    line = (F.when(key % 7 == 0, F.concat_ws(",", *fields[:3]))
            .when(key % 11 == 0, F.concat_ws(",", *fields, F.lit("surplus"))).otherwise(F.concat_ws(",", *fields)))
    root = scratch_path(spark, "rejects")
    _t(spark, sf, "customer").select(line.alias("value")).write.text(f"{root}/raw")
    land_csv(spark, f"{root}/raw", CUSTOMER_COLUMNS, f"{root}/bronze", header=False)
    return f"{root}/bronze"


def q_bronze_rejects(spark, sf):
    """Lines that do not fit the stated columns, kept aside as they came."""
    return landed_rejects(spark, _landed_customers(spark, sf)).withColumn("n_fields", F.size(F.split("line", ",", -1)))


def q_bronze_fitting(spark, sf):
    """The other lines, typed."""
    types = {f.name: f.dataType for f in _t(spark, sf, "customer").schema}
    rows = landed_rows(spark, _landed_customers(spark, sf))
    return rows.select(*[F.col(c).try_cast(types[c]).alias(c) for c in CUSTOMER_COLUMNS])


def q_export_verify(spark, sf):
    """Re-read every export and compare rows and content with what was written."""
    root, digests = _exported(spark, sf, *EXPORTS)
    return verify_export(spark, root, digests)


def q_source_shape(spark, sf):
    return source_shape(loans_raw(spark, sf), "loans_raw")


def q_export_roundtrip(spark, sf):
    root, _ = _exported(spark, sf, "loan_risk")
    return read_layer(spark, f"{root}/loan_risk")


def q_export_manifest(spark, sf):
    root, _ = _exported(spark, sf, *EXPORTS)
    files = export_manifest(spark, root, EXPORTS)
    # names and sizes differ from run to run, so the query tells whether they are sound
    sound = F.col("file_name").endswith(".parquet") & (F.col("file_size") > 0)
    return files.groupBy("table").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"),
                                      F.every(sound).alias("sound"))


# --- change feed ------------------------------------------------------------------

def order_changes(orders: DataFrame) -> DataFrame:
    """Servicing feed derived from the orders: every pending order is settled
    ('F') with a 5% surcharge on its amount."""
    return orders.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("old_status"),
        F.lit("F").alias("new_status"), (F.col("o_totalprice") * F.lit(1.05)).alias("loan_amnt"))


ORDER_SET = {"o_orderstatus": "new_status", "o_totalprice": "loan_amnt"}


def q_merge_update(spark, sf):
    orders = _t(spark, sf, "orders")
    return ch.merge_update(orders, order_changes(orders).withColumnRenamed("id", "o_orderkey"),
                           "o_orderkey", ORDER_SET)


def q_merge_bucketed(spark, sf):
    """The same change feed against a table stored bucketed on the key: the
    target stays in place and only the change set is shuffled.  The catalog
    entry goes once the merged rows are stored."""
    orders = _t(spark, sf, "orders")
    root, name = scratch_path(spark, "orders-bucketed"), f"ll_orders_{uuid.uuid4().hex[:10]}"
    buckets = default_parallelism(spark)
    (orders.repartition(buckets, "o_orderkey").write.bucketBy(buckets, "o_orderkey").option("path", f"{root}/target")
     .saveAsTable(name))
    try:
        changes = order_changes(orders).withColumnRenamed("id", "o_orderkey")
        write_layer(ch.merge_update(spark.table(name), changes, "o_orderkey", ORDER_SET), f"{root}/merged")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return read_layer(spark, f"{root}/merged")


#: Key ranges that an order layer is kept in.
ORDER_RANGES = 16


def order_part(orders: DataFrame) -> str:
    """Partition expression: equal ranges of the order key (one scalar is read)."""
    top = orders.agg(F.max("o_orderkey")).first()[0] or 0
    return f"o_orderkey div {top // ORDER_RANGES + 1}"


def _fed(spark, sf):
    """Orders as a layer in key ranges with one change set applied."""
    orders = _t(spark, sf, "orders")
    root, part = scratch_path(spark, "orders-feed"), order_part(orders)
    layer, feed = f"{root}/orders", f"{root}/feed"
    ch.start_feed(spark, orders, layer, part, feed, at=CHANGE_AT)
    changes = order_changes(orders).withColumnRenamed("id", "o_orderkey")
    ch.apply_change_set(spark, layer, feed, "settled", changes, "o_orderkey", ORDER_SET, part, at=CHANGE_AT)
    return layer, feed, changes, part


def q_merge_ranged(spark, sf):
    """A change set that lies in two of the key ranges, merged in place."""
    orders = _t(spark, sf, "orders")
    root, part = scratch_path(spark, "orders-ranged"), order_part(orders)
    ch.write_ranged(orders, root, part)
    changes = order_changes(orders.where(F.expr(part).isin(3, 4))).withColumnRenamed("id", "o_orderkey")
    ch.merge_ranged(spark, root, changes, "o_orderkey", ORDER_SET, part)
    return ch.read_ranged(spark, root)


def q_key_lookup(spark, sf):
    layer, _, changes, part = _fed(spark, sf)
    hits = ch.lookup_ranged(spark, layer, changes, "o_orderkey", part)
    return (hits.select("o_orderkey", "o_orderstatus", "o_totalprice",
                        F.length(F.col("o_orderkey").cast("string")).alias("id_length"))
            .orderBy(F.col("o_orderkey").desc()))


def q_change_log(spark, sf):
    _, feed, _, _ = _fed(spark, sf)
    return ch.visible_log(spark, feed).drop("change_set", "seq")


def q_replay_changes(spark, sf):
    """Rebuild the table from its source and replay the audit log onto it."""
    _, feed, _, _ = _fed(spark, sf)
    return ch.replay_changes(_t(spark, sf, "orders"), ch.visible_log(spark, feed), "o_orderkey", ORDER_SET)


def q_version_history(spark, sf):
    """The applied change sets, newest first."""
    _, feed, _, _ = _fed(spark, sf)
    return ch.feed_history(spark, feed).limit(5).select(F.col("seq").alias("version"), "operation",
                                                       F.col("num_rows").alias("num_output_rows"),
                                                       F.col("num_updated").alias("num_updated_rows"))


def q_as_of_before_after(spark, sf):
    _, feed, changes, _ = _fed(spark, sf)
    images = ch.visible_images(spark, feed)
    return ch.before_after(images.where("side = 'before'"), images.where("side = 'after'"), changes, "o_orderkey",
                           ["o_orderstatus", "o_totalprice"])


ORDER_GOLD_KEYS = ["o_orderpriority", "o_orderstatus"]
ORDER_GOLD = [("loan_count", "count", "o_orderkey"), ("avg_loan_amt", "avg", "o_totalprice"),
              ("total_loan_volume", "sum", "o_totalprice")]


def q_gold_refresh(spark, sf):
    """Gold after two change sets, from the stored group sums and the images of
    the changed rows: pending orders are settled, then open urgent orders lose
    their priority and 100 of their amount."""
    orders = _t(spark, sf, "orders")
    root, part = scratch_path(spark, "gold-refresh"), order_part(orders)
    layer, feed = f"{root}/orders", f"{root}/feed"
    ch.start_feed(spark, orders, layer, part, feed, at=CHANGE_AT)
    write_layer(ch.group_sums(orders, ORDER_GOLD_KEYS, ORDER_GOLD), f"{root}/sums")
    ch.apply_change_set(spark, layer, feed, "settled", order_changes(orders).withColumnRenamed("id", "o_orderkey"),
                        "o_orderkey", ORDER_SET, part, at=CHANGE_AT)
    urgent = (ch.read_ranged(spark, layer).where("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
              .select("o_orderkey", F.lit("2-HIGH").alias("new_priority"),
                      (F.col("o_totalprice") - 100).alias("new_price")))
    ch.apply_change_set(spark, layer, feed, "lowered", urgent, "o_orderkey",
                        {"o_orderpriority": "new_priority", "o_totalprice": "new_price"}, part, at=CHANGE_AT)
    deltas = ch.image_sums(ch.visible_images(spark, feed), ORDER_GOLD_KEYS, ORDER_GOLD)
    return ch.gold_refresh(read_layer(spark, f"{root}/sums"), deltas, ORDER_GOLD_KEYS, ORDER_GOLD)


# --- stream -----------------------------------------------------------------------

STREAM_MEASURES = [("count", "count", "event_id"), ("avg_amount", "avg", "value"), ("avg_score", "avg", "user_id")]
STREAM_DIGITS = {"avg_amount": 2, "avg_score": 0}


def q_stream_prefix_agg(spark, sf):
    ev = standins.assign_batches(_t(spark, sf, "events"), "event_id", STREAM_BATCHES, "arrival_batch")
    return prefix_aggregate(ev, "arrival_batch", ["event_type"], STREAM_MEASURES, STREAM_BATCHES,
                            STREAM_DIGITS, out_batch="batch")


def q_stream_available_now(spark, sf):
    events = _t(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    ev = standins.assign_batches(events, "event_id", STREAM_BATCHES, "arrival_batch")
    root = scratch_path(spark, "stream")
    for batch in range(1, STREAM_BATCHES + 1):      # a batch arrives, the stream runs, however many files it came in
        standins.land_batch(ev, "arrival_batch", batch, f"{root}/landing")
        out = run_available_now(spark, f"{root}/landing", ev.schema, ["event_type"], STREAM_MEASURES,
                                f"{root}/sink", f"{root}/checkpoint", digits=STREAM_DIGITS)
    return out.select((F.col("batch_id") + 1).cast("int").alias("batch"), "event_type", "count",
                      "avg_amount", "avg_score")


def q_stream_keyed(spark, sf):
    """The same stream in update mode: one row per key, replaced as it changes."""
    events = _t(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    ev = standins.assign_batches(events, "event_id", STREAM_BATCHES, "arrival_batch")
    root = scratch_path(spark, "stream-keyed")
    for batch in range(1, STREAM_BATCHES + 1):
        standins.land_batch(ev, "arrival_batch", batch, f"{root}/landing")
        out = run_keyed(spark, f"{root}/landing", ev.schema, ["event_type"], STREAM_MEASURES, f"{root}/sink",
                        f"{root}/checkpoint", digits=STREAM_DIGITS)
    return out


# --- prompts and cost ---------------------------------------------------------------

PROMPT_VERSIONS = ["risk_narrative_v1.0", "risk_narrative_v1.1"]


def q_prompt_render(spark, sf):
    gold = chains.loan_gold(chains.loan_silver(loans_raw(spark, sf)), order=False)
    segments = gold.filter(F.col("loan_status").isin(presets.NARRATIVE_STATUSES))
    path = scratch_path(spark, "registry")
    pr.registry_frame(spark).write.parquet(path)
    return pr.render_prompts(segments, PROMPT_VERSIONS, registry=read_layer(spark, path),
                             keep=["grade", "loan_status", "risk_tier"])


def conversation_calls(conv: DataFrame) -> DataFrame:
    """One model call per conversation: non-assistant turns are the input,
    assistant turns the output; even conversations used v1.0, odd v1.1."""
    tok = pr.estimate_tokens("text")
    is_out = F.col("role") == "assistant"
    calls = conv.groupBy("conv_id").agg(
        F.coalesce(F.sum(F.when(~is_out, tok)), F.lit(0)).cast("int").alias("input_tokens"),
        F.coalesce(F.sum(F.when(is_out, tok)), F.lit(0)).cast("int").alias("output_tokens"))
    version = F.when(F.col("conv_id") % 2 == 0, F.lit(PROMPT_VERSIONS[0])).otherwise(F.lit(PROMPT_VERSIONS[1]))
    return calls.select("conv_id", version.alias("prompt_version"),
                        F.lit(presets.DEFAULT_MODEL).alias("model"), "input_tokens", "output_tokens")


def q_token_cost(spark, sf):
    path = scratch_path(spark, "prices")
    pr.price_frame(spark).write.parquet(path)
    return pr.token_cost(conversation_calls(_t(spark, sf, "conversations")), read_layer(spark, path))


#: Stand-in price changes of one model: (valid from, input, output price of 1,000 tokens).
PRICE_STEPS = [(None, 0.003, 0.015), (_dt.datetime(2026, 3, 1), 0.002, 0.012), (_dt.datetime(2026, 9, 1), 0.0025, 0.01)]
CALLS_FROM = _dt.date(2026, 1, 1)


def q_dated_cost(spark, sf):
    """Cost of the calls at the price of their day; call days follow the
    conversation id through a year."""
    steps = spark.createDataFrame([(presets.DEFAULT_MODEL, i, o, at) for at, i, o in PRICE_STEPS],
                                  "model string, input_cost_per_1k double, output_cost_per_1k double, valid_from timestamp_ntz")
    path = scratch_path(spark, "price-steps")
    steps.write.parquet(path)
    day = F.date_add(F.lit(CALLS_FROM), (F.col("conv_id") % 365).cast("int")).cast("timestamp_ntz")
    calls = conversation_calls(_t(spark, sf, "conversations")).withColumn("called_at", day)
    return pr.token_cost(calls, read_layer(spark, path), at_col="called_at")


def q_cost_by_version(spark, sf):
    return pr.cost_by_version(q_token_cost(spark, sf))


def q_version_compare(spark, sf):
    # stand-in for a measured duration: 20 ms per output token
    timed = q_token_cost(spark, sf).withColumn("duration_ms", F.col("output_tokens") * F.lit(20.0))
    return pr.version_compare(timed, *PROMPT_VERSIONS)


def q_version_compare_runs(spark, sf):
    """The comparison over runs of both versions, with the durations measured
    at the calls; these differ from run to run, so the query tells whether
    they are sound."""
    gold, path = scratch_path(spark, "gold"), scratch_path(spark, "compared")
    write_layer(chains.loan_gold(chains.loan_silver(loans_raw(spark, sf)), order=False), gold)
    for version in PROMPT_VERSIONS:
        calls = pr.narrate_segments(read_layer(spark, gold), standins.counting_client, version,
                                    partitions=default_parallelism(spark))
        pr.write_cost_log(calls, path)
    out = pr.version_compare(read_layer(spark, path), *PROMPT_VERSIONS)
    measured = [c for c in out.columns if c.startswith("duration")]
    sound = (F.col("duration_ms_a") >= 0) & (F.col("duration_ms_b") >= 0)
    return out.withColumn("timed", sound & (F.col("duration_difference_ms") == F.round(
        F.col("duration_ms_b") - F.col("duration_ms_a"), 2))).drop(*measured)


def q_narratives_resumed(spark, sf):
    """Narratives in two runs over one store: the first for one status, the
    second for all, which calls the model for the others only."""
    gold, store = scratch_path(spark, "gold"), scratch_path(spark, "calls")
    write_layer(chains.loan_gold(chains.loan_silver(loans_raw(spark, sf)), order=False), gold)
    for run, statuses in (("first", presets.NARRATIVE_STATUSES[:1]), ("second", presets.NARRATIVE_STATUSES)):
        out = pr.narrate_segments(read_layer(spark, gold), standins.counting_client, statuses=statuses,
                                  partitions=default_parallelism(spark), store=store, run=run)
    return out.select("grade", "loan_status", "risk_tier", "ai_risk_narrative", "run", "input_tokens", "output_tokens")


def _narrated(spark, sf, version=None):
    gold = chains.loan_gold(chains.loan_silver(loans_raw(spark, sf)), order=False)
    return pr.narrate_segments(gold, standins.counting_client, version, partitions=default_parallelism(spark))


def q_narratives(spark, sf):
    return pr.store_narratives(_narrated(spark, sf), scratch_path(spark, "narratives"))


def q_cost_log(spark, sf):
    """The cost log after one run of each prompt version."""
    path = scratch_path(spark, "cost-log")
    for version in PROMPT_VERSIONS:
        pr.write_cost_log(_narrated(spark, sf, version), path)
    # durations and start times differ from run to run, so the query tells whether they are sound
    timed = (F.col("duration_ms") >= 0) & F.col("started_at").between(F.date_sub(F.current_date(), 2), F.now())
    return read_layer(spark, path).withColumn("timed", timed).drop("duration_ms", "started_at")


# --- governance -----------------------------------------------------------------------

def q_masked_view(spark, sf):
    return masked_view(_t(spark, sf, "customer"), {"c_name": "mask"})


def q_row_policy(spark, sf):
    return region_policy(_t(spark, sf, "customer"), _t(spark, sf, "nation"), _t(spark, sf, "region"),
                         POLICY_REGION)


READER_GROUPS = ["EUROPE", "ASIA"]


def q_row_policy_view(spark, sf):
    """One view of the customers, read by two groups in one query; the names
    are masked in it."""
    nation, region = _t(spark, sf, "nation"), _t(spark, sf, "region")
    allowed = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("c_nationkey"), "r_name")
    tag = uuid.uuid4().hex[:10]
    view, reader = f"customers_{tag}", f"reader_{tag}"
    create_reader_view(spark, view, _t(spark, sf, "customer"), allowed, "c_nationkey", "r_name", reader,
                       {"c_name": "mask"})
    try:
        out = None
        for group in READER_GROUPS:
            rows = read_as(spark, view, reader, group).withColumn("reader", F.lit(group))
            out = rows if out is None else out.unionByName(rows)
    finally:
        drop_reader_view(spark, view, reader)
    return out


QUERIES: dict[str, Query] = {
    "loan_gold": q_loan_gold,
    "gold_summary": q_gold_summary,
    "silver_clean": q_silver_clean,
    "silver_profile": q_silver_profile,
    "bronze_profile": q_bronze_profile,
    "loan_chain_e2e": q_loan_chain_e2e,
    "declarative_gold": q_declarative_gold,
    "expectation_report": q_expectation_report,
    "bronze_validation": q_bronze_validation,
    "layer_reconcile": q_layer_reconcile,
    "gold_readback": q_gold_readback,
    "default_rate": q_default_rate,
    "gold_regroup": q_gold_regroup,
    "rename_dashed": q_rename_dashed,
    "label_decode": q_label_decode,
    "label_profile": q_label_profile,
    "gold_three_key": q_gold_three_key,
    "combo_topk": q_combo_topk,
    "denial_rate": q_denial_rate,
    "denial_rate_by_group": q_denial_rate_by_group,
    "mortgage_chain_e2e": q_mortgage_chain_e2e,
    "mortgage_quality": q_mortgage_quality,
    "ordered_subset": q_ordered_subset,
    "bronze_csv_roundtrip": q_bronze_csv_roundtrip,
    "bronze_rejects": q_bronze_rejects,
    "bronze_fitting": q_bronze_fitting,
    "export_roundtrip": q_export_roundtrip,
    "export_manifest": q_export_manifest,
    "export_verify": q_export_verify,
    "source_shape": q_source_shape,
    "catalog_layers": q_catalog_layers,
    "merge_update": q_merge_update,
    "merge_bucketed": q_merge_bucketed,
    "merge_ranged": q_merge_ranged,
    "key_lookup": q_key_lookup,
    "change_log": q_change_log,
    "version_history": q_version_history,
    "replay_changes": q_replay_changes,
    "as_of_before_after": q_as_of_before_after,
    "gold_refresh": q_gold_refresh,
    "stream_prefix_agg": q_stream_prefix_agg,
    "stream_available_now": q_stream_available_now,
    "stream_keyed": q_stream_keyed,
    "prompt_render": q_prompt_render,
    "token_cost": q_token_cost,
    "dated_cost": q_dated_cost,
    "cost_by_version": q_cost_by_version,
    "version_compare": q_version_compare,
    "version_compare_runs": q_version_compare_runs,
    "narratives": q_narratives,
    "narratives_resumed": q_narratives_resumed,
    "cost_log": q_cost_log,
    "masked_view": q_masked_view,
    "row_policy": q_row_policy,
    "row_policy_view": q_row_policy_view,
}
