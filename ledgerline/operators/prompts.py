"""Versioned prompts, text-model calls and token cost.

* Rendering: a registry given as a mapping is configuration, each chosen
  version becomes one ``concat`` expression; a registry given as a frame is
  joined on the version and its templates are filled per row.
* Prices: a frame, left-joined on the model and, if calls carry a date, the
  time a price is valid; a call without a price fails the job.
* Calls: ``generate`` runs a caller-given client over Arrow batches with
  ``mapInPandas``; the client is built once per partition.  No provider code
  lives here.  ``generate_missing`` keeps results by a hash of the call, so a
  rerun calls the model only for what is not stored yet.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import presets
from ledgerline.functions.rounded import rounded_avg, rounded_sum
from ledgerline.functions.text import fill_from, fill_template, template_values
from ledgerline.sources.files import read_layer, write_layer

REGISTRY_SCHEMA = T.StructType([
    T.StructField("prompt_version", T.StringType(), True),
    T.StructField("version", T.StringType(), True),
    T.StructField("model", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("created_date", T.StringType(), True),
    T.StructField("template", T.StringType(), True),
])

PRICE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), True),
    T.StructField("input_cost_per_1k", T.DoubleType(), True),
    T.StructField("output_cost_per_1k", T.DoubleType(), True),
])


def registry_frame(spark: SparkSession, registry: Mapping[str, Mapping[str, str]] = presets.PROMPT_REGISTRY) -> DataFrame:
    rows = [(k, v["version"], v["model"], v["description"], v["created_date"], v["template"])
            for k, v in registry.items()]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def price_frame(spark: SparkSession, prices: Mapping[str, Mapping[str, float]] = presets.PRICES) -> DataFrame:
    rows = [(m, p["input_cost_per_1k"], p["output_cost_per_1k"]) for m, p in prices.items()]
    return spark.createDataFrame(rows, PRICE_SCHEMA)


def prompt_lookup(rows: DataFrame, registry: DataFrame, version_col: str = "prompt_version") -> DataFrame:
    """``rows`` with the model and template of their prompt version (columns
    ``model`` and ``template``): one left join; a version that the registry
    lacks fails the job."""
    entry = registry.select(F.col("prompt_version").alias("__ll_version"), F.struct("model", "template").alias("__ll_entry"))
    version = F.col(version_col)
    missing = F.raise_error(F.concat(F.lit("prompt version not in registry: "), F.coalesce(version, F.lit("NULL"))))
    joined = rows.join(entry, version == F.col("__ll_version"), "left")
    found = F.when(F.col("__ll_version").isNull(), missing.cast(entry.schema["__ll_entry"].dataType)).otherwise(F.col("__ll_entry"))
    return (joined.withColumn("__ll_entry", found)
            .select(*rows.columns, "__ll_entry.model", "__ll_entry.template"))


def render_prompts(segments: DataFrame, versions: Sequence[str],
                   registry: Mapping[str, Mapping[str, str]] | DataFrame = presets.PROMPT_REGISTRY,
                   columns: Mapping[str, str | Column] | None = None,
                   keep: Sequence[str] | None = None) -> DataFrame:
    """One row per segment and chosen version: ``keep`` columns (default all),
    prompt_version, model, prompt.  With ``registry`` a frame (see
    :func:`registry_frame`) versions are looked up by a join, and unknown ones
    fail the job; ``columns`` belongs to the mapping form."""
    if isinstance(registry, DataFrame):
        keep = list(keep if keep is not None else segments.columns)
        asked = segments.select(*keep, template_values(dict(segments.dtypes)).alias("__ll_values"),
                                F.explode(F.array(*map(F.lit, versions))).alias("prompt_version"))
        return prompt_lookup(asked, registry).select(*keep, "prompt_version", "model",
                                                     fill_from("template", "__ll_values").alias("prompt"))
    unknown = [v for v in versions if v not in registry]
    if unknown:
        raise KeyError(f"prompt versions not in registry: {unknown}")
    entries = [F.struct(F.lit(v).alias("prompt_version"), F.lit(registry[v]["model"]).alias("model"),
                        fill_template(registry[v]["template"], columns, dtypes=dict(segments.dtypes)).alias("prompt"))
               for v in versions]
    keep = list(keep if keep is not None else segments.columns)
    return (segments.select(*keep, F.explode(F.array(*entries)).alias("__ll_p"))
            .select(*keep, "__ll_p.prompt_version", "__ll_p.model", "__ll_p.prompt"))


def estimate_tokens(text: str | Column, chars_per_token: int = 4) -> Column:
    """Token estimate ``ceil(chars / chars_per_token)`` for text without a
    reported usage count."""
    col = F.col(text) if isinstance(text, str) else text
    return F.ceil(F.length(col) / F.lit(chars_per_token)).cast("int")


def price_periods(prices: DataFrame) -> DataFrame:
    """Price list with the time each price is valid: from its ``valid_from``
    (NULL or no such column: from the beginning) to the next one of the model
    (``valid_to``, exclusive).  Two prices of one model from the same time fail
    the job."""
    if "valid_from" not in prices.columns:
        prices = prices.withColumn("valid_from", F.lit(None).cast("timestamp"))
    w = Window.partitionBy("model").orderBy(F.asc_nulls_first("valid_from"))
    again = F.lead(F.struct("valid_from")).over(w)
    twice = again.isNotNull() & again["valid_from"].eqNullSafe(F.col("valid_from"))
    refused = F.raise_error(F.concat(F.lit("two prices of one time for model: "), F.col("model"))).cast("boolean")
    return (prices.withColumns({"valid_to": again["valid_from"], "__ll_twice": F.when(twice, refused).otherwise(F.lit(False))})
            .where(~F.col("__ll_twice")).drop("__ll_twice"))


def token_cost(calls: DataFrame, prices: DataFrame | Mapping[str, Mapping[str, float]] = presets.PRICES,
               model_col: str = "model", input_col: str = "input_tokens",
               output_col: str = "output_tokens", digits: int = 6, at_col: str | None = None) -> DataFrame:
    """Add total_tokens and cost_usd = round(in/1000*p_in + out/1000*p_out, 6).

    ``prices`` (a frame like :func:`price_frame`, or a mapping) is left-joined
    on the model; with ``at_col`` the price valid at that time counts, without
    it the latest.  A call without a price fails the job.
    """
    if not isinstance(prices, DataFrame):
        prices = price_frame(calls.sparkSession, prices)
    price = price_periods(prices).select(
        F.col("model").alias("__ll_model"), F.col("valid_from").alias("__ll_from"), F.col("valid_to").alias("__ll_to"),
        F.struct("input_cost_per_1k", "output_cost_per_1k").alias("__ll_price"))
    model = F.col(model_col)
    if at_col is None:
        price = price.where(F.col("__ll_to").isNull())
        on = model == F.col("__ll_model")
    else:
        at = F.col(at_col)
        on = ((model == F.col("__ll_model")) & (F.col("__ll_from").isNull() | (at >= F.col("__ll_from")))
              & (F.col("__ll_to").isNull() | (at < F.col("__ll_to"))))
    missing = F.raise_error(F.concat(F.lit("no price for model: "), F.coalesce(model, F.lit("NULL"))))
    found = F.when(F.col("__ll_price").isNull(), missing.cast(price.schema["__ll_price"].dataType)).otherwise(F.col("__ll_price"))
    cost = (F.col(input_col) / F.lit(1000) * F.col("__ll_price.input_cost_per_1k")
            + F.col(output_col) / F.lit(1000) * F.col("__ll_price.output_cost_per_1k"))
    return (calls.join(price, on, "left").withColumn("__ll_price", found)
            .withColumns({"total_tokens": (F.col(input_col) + F.col(output_col)).cast("int"),
                          "cost_usd": F.round(cost, digits)})
            .drop("__ll_model", "__ll_from", "__ll_to", "__ll_price"))


def cost_by_version(costs: DataFrame, version_col: str = "prompt_version", digits: int = 6) -> DataFrame:
    """Calls, tokens and cost per prompt version."""
    return costs.groupBy(version_col).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("input_tokens").cast("bigint").alias("input_tokens"),
        F.sum("output_tokens").cast("bigint").alias("output_tokens"),
        F.sum("total_tokens").cast("bigint").alias("total_tokens"),
        rounded_sum("cost_usd", digits).alias("total_cost_usd"),
        rounded_avg("cost_usd", digits).alias("avg_cost_usd"),
    )


def version_compare(costs: DataFrame, version_a: str, version_b: str,
                    version_col: str = "prompt_version", digits: int = 6) -> DataFrame:
    """One row comparing two versions: calls, tokens, cost of each and the
    cost difference b - a, by conditional aggregation (one pass).  Calls with
    a ``duration_ms`` are compared by that too."""
    v = F.col(version_col)
    timed = "duration_ms" in costs.columns

    def part(tag: str, name: str):
        is_v = v == F.lit(name)
        return [
            F.count_if(is_v).alias(f"calls_{tag}"),
            F.sum(F.when(is_v, F.col("total_tokens"))).cast("bigint").alias(f"total_tokens_{tag}"),
            rounded_sum(F.when(is_v, F.col("cost_usd")), digits).alias(f"cost_usd_{tag}"),
            *([rounded_sum(F.when(is_v, F.col("duration_ms")), 2).alias(f"duration_ms_{tag}")] if timed else []),
        ]

    agg = costs.filter(v.isin(version_a, version_b)).agg(*part("a", version_a), *part("b", version_b))
    return agg.select(F.lit(version_a).alias("version_a"), F.lit(version_b).alias("version_b"), "*",
                      F.round(F.col("cost_usd_b") - F.col("cost_usd_a"), digits).alias("cost_difference"),
                      *([F.round(F.col("duration_ms_b") - F.col("duration_ms_a"), 2).alias("duration_difference_ms")]
                        if timed else []))


GENERATED_FIELDS = [
    T.StructField("narrative", T.StringType(), True),
    T.StructField("input_tokens", T.IntegerType(), True),
    T.StructField("output_tokens", T.IntegerType(), True),
    T.StructField("duration_ms", T.DoubleType(), True),
    T.StructField("started_at", T.TimestampType(), True),
]

# A client takes prompts and the output limit and returns, per prompt, (text, input_tokens, output_tokens).
Client = Callable[[list[str], int], list[tuple[str, int, int]]]


def generate(df: DataFrame, client_factory: Callable[[], Client], prompt_col: str = "prompt",
             batch_size: int = 8, max_retries: int = 3, backoff_s: float = 1.0,
             max_tokens: int = presets.NARRATIVE_MAX_TOKENS, partitions: int | None = None) -> DataFrame:
    """Call a text model for every row's prompt, in parallel across partitions.

    ``client_factory`` is pickled to the executors and called once per
    partition; the client receives up to ``batch_size`` prompts per call and the
    output limit ``max_tokens``.  ``partitions`` spreads the rows over that many
    tasks first: the few rows of an aggregate otherwise sit in one.
    A failing call is retried ``max_retries`` times with exponential backoff
    before the task fails (a failed task is retried by Spark, which calls
    the model again for that partition only).  Adds narrative, input_tokens,
    output_tokens, duration_ms (per prompt, the successful call's time
    divided evenly over the batch) and started_at.
    """
    schema = T.StructType(list(df.schema.fields) + GENERATED_FIELDS)

    def call(client, chunk):
        for attempt in range(max_retries + 1):
            try:
                started = datetime.now(timezone.utc)
                t0 = time.perf_counter()
                return client(chunk, max_tokens), started, (time.perf_counter() - t0) * 1000.0
            except Exception:  # noqa: BLE001 - provider errors are opaque here
                if attempt == max_retries:
                    raise
                time.sleep(backoff_s * (2 ** attempt))

    def run(batches):
        client = client_factory()
        for pdf in batches:
            texts, ins, outs, durs, starts = [], [], [], [], []
            prompts = pdf[prompt_col].tolist()
            for i in range(0, len(prompts), batch_size):
                chunk = prompts[i:i + batch_size]
                results, started, elapsed = call(client, chunk)
                if len(results) != len(chunk):
                    raise ValueError("client returned a different number of results than prompts")
                for text, n_in, n_out in results:
                    texts.append(text)
                    ins.append(n_in)
                    outs.append(n_out)
                    durs.append(round(elapsed / len(chunk), 2))
                    starts.append(started)
            yield pdf.assign(narrative=texts, input_tokens=pd.array(ins, dtype="Int32"),
                             output_tokens=pd.array(outs, dtype="Int32"), duration_ms=durs,
                             started_at=pd.to_datetime(starts))

    return (df.repartition(partitions) if partitions else df).mapInPandas(run, schema)


CALL_SCHEMA = T.StructType([T.StructField("call_key", T.StringType(), True), T.StructField("run", T.StringType(), True),
                            *GENERATED_FIELDS])


def call_key(columns: Sequence[str], max_tokens: int) -> Column:
    """Names a call by all that its answer depends on."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts, F.lit(f"{max_tokens}")), 256)


def generate_missing(prompts: DataFrame, client_factory: Callable[[], Client], store: str, run: str | None = None,
                     key_columns: Sequence[str] = ("prompt_version", "model", "prompt"),
                     max_tokens: int = presets.NARRATIVE_MAX_TOKENS, **options) -> DataFrame:
    """:func:`generate` for prompts without a stored result, and the results of
    all: the columns of ``prompts``, ``run`` (of the run that made the call) and
    the fields of a call.

    ``store`` is a Parquet folder of results by call key.  Keys already there
    are left out by an anti join, equal calls are made once, and what a run
    adds is appended in one commit, so a rerun after a failure makes the
    missing calls only.  ``options`` go to :func:`generate`.
    """
    spark = prompts.sparkSession
    keyed = prompts.withColumn("__ll_key", call_key(key_columns, max_tokens))
    spark.createDataFrame([], CALL_SCHEMA).write.mode("ignore").parquet(store)
    known = spark.read.schema(CALL_SCHEMA).parquet(store)
    todo = (keyed.select(F.col("__ll_key").alias("call_key"), "prompt").dropDuplicates(["call_key"])
            .join(known.select("call_key"), "call_key", "left_anti"))
    made = generate(todo, client_factory, "prompt", max_tokens=max_tokens, **options)
    (made.withColumn("run", F.lit(run).cast("string")).select(*CALL_SCHEMA.fieldNames())
     .write.mode("append").parquet(store))
    results = spark.read.schema(CALL_SCHEMA).parquet(store).dropDuplicates(["call_key"])
    return (keyed.join(results.withColumnRenamed("call_key", "__ll_key"), "__ll_key", "left").drop("__ll_key")
            .select(*prompts.columns, "run", *[f.name for f in GENERATED_FIELDS]))


NARRATIVE_COLUMNS = ["grade", "loan_status", "risk_tier"]


def narrate_segments(gold: DataFrame, client_factory: Callable[[], Client],
                     version: str | None = None,
                     statuses: Sequence[str] = presets.NARRATIVE_STATUSES,
                     registry: Mapping[str, Mapping[str, str]] = presets.PROMPT_REGISTRY,
                     keys: Sequence[str] = NARRATIVE_COLUMNS, batch_size: int = 8,
                     max_tokens: int = presets.NARRATIVE_MAX_TOKENS, partitions: int | None = None,
                     store: str | None = None, run: str | None = None) -> DataFrame:
    """One generated text per gold segment of the given statuses -- grade,
    loan_status, risk_tier, ai_risk_narrative, plus the prompt version, model,
    tokens and cost of the call.  Without ``store`` every action on it calls the
    model again, so write it first; with one, the calls are made here, only
    those that the store lacks (:func:`generate_missing`), tagged with ``run``.

    Without ``version`` the per-segment narrative prompt is used
    (``presets.SEGMENT_NARRATIVE_TEMPLATE``, default model); with one, that
    registry version.
    """
    segments = gold.filter(F.col("loan_status").isin(list(statuses)))
    if version is None:
        prompts = segments.select(*keys, F.lit("segment_narrative").alias("prompt_version"),
                                  F.lit(presets.DEFAULT_MODEL).alias("model"),
                                  fill_template(presets.SEGMENT_NARRATIVE_TEMPLATE,
                                                dtypes=dict(segments.dtypes)).alias("prompt"))
    else:
        prompts = render_prompts(segments, [version], registry, keep=list(keys))
    if store:
        calls = generate_missing(prompts, client_factory, store, run, max_tokens=max_tokens, batch_size=batch_size,
                                 partitions=partitions)
    else:
        calls = generate(prompts, client_factory, "prompt", batch_size, max_tokens=max_tokens, partitions=partitions)
    return token_cost(calls.withColumnRenamed("narrative", "ai_risk_narrative").drop("prompt"))


def store_narratives(calls: DataFrame, name_or_path: str, keys: Sequence[str] = NARRATIVE_COLUMNS) -> DataFrame:
    """Write the narrative table (the keys and the text) and read it back,
    sorted by tier, grade and status."""
    write_layer(calls.select(*keys, "ai_risk_narrative"), name_or_path)
    return read_layer(calls.sparkSession, name_or_path).orderBy("risk_tier", "grade", "loan_status")


COST_LOG_COLUMNS = ["prompt_version", "model", "ai_risk_narrative", "input_tokens", "output_tokens",
                    "total_tokens", "cost_usd", "duration_ms", "started_at"]


def write_cost_log(calls: DataFrame, path: str, mode: str = "append") -> None:
    """Append (by default) the per-call cost rows to a log table at ``path``."""
    (calls.select(*[c for c in COST_LOG_COLUMNS if c in calls.columns])
     .withColumnRenamed("ai_risk_narrative", "narrative")
     .write.mode(mode).parquet(path))
