"""Running (prefix) aggregates over micro-batches.

``prefix_aggregate`` computes, for every batch b, the aggregate over all rows
that arrived in batches 1..b (keys absent from batch b but seen earlier are
kept), from per-batch partial aggregates, so the input is scanned and shuffled
once and a running window per key sums the partials.

``run_available_now`` is the same computation as a Structured Streaming query:
it takes what has landed since the last run on its checkpoint, the aggregate
runs in complete mode and every micro-batch result is written to its own
``batch_id=<id>`` folder (overwrite, so a retried batch is idempotent).

``run_keyed`` is the stream in update mode: a micro-batch holds the keys it
changed, and they replace their rows in a table with one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.rounded import rounded, rounded_avg, rounded_sum

# measure = (output name, function, input column); function in count, avg, sum
Measure = tuple[str, str, str]


def _partials(df: DataFrame, group: Sequence[str], measures: Sequence[Measure]) -> tuple[DataFrame, list]:
    """Per-group partial aggregates that later combine: counts and sums."""
    aggs, finals = [], []
    for i, (name, fn, col) in enumerate(measures):
        if fn == "count":
            aggs.append((F.count(F.lit(1)) if col == "*" else F.count(col)).alias(f"_n{i}"))
            finals.append((name, fn, i))
        elif fn in ("sum", "avg"):
            aggs += [F.sum(F.col(col).cast("double")).alias(f"_s{i}"), F.count(col).alias(f"_c{i}")]
            finals.append((name, fn, i))
        else:
            raise ValueError(f"unsupported running aggregate {fn!r}")
    return df.groupBy(*group).agg(*aggs), finals


def _combine(name: str, fn: str, i: int, digits: int | None, over=None) -> Column:
    """Final value of measure ``i`` from summed partials (optionally over a
    window)."""
    def total(c: str) -> Column:
        return F.sum(c) if over is None else F.sum(c).over(over)

    if fn == "count":
        out = total(f"_n{i}")
        return (out if over is None else F.coalesce(out, F.lit(0))).cast("bigint").alias(name)
    value = total(f"_s{i}") if fn == "sum" else total(f"_s{i}") / F.nullif(total(f"_c{i}"), F.lit(0))
    return rounded(value, digits).alias(name)


def prefix_aggregate(df: DataFrame, batch_col: str, keys: Sequence[str], measures: Sequence[Measure],
                     n_batches: int, digits: dict[str, int] | None = None,
                     out_batch: str = "batch") -> DataFrame:
    """Aggregate of batches 1..b for every b in 1..n, per key (a NULL key is a
    key like any other).

    The data is scanned and shuffled once, into per-(batch, key) partial
    aggregates.  A key's empty batches are added as empty partials by a
    union, so nothing is joined on the keys, and a running window per key sums
    them up: linear in keys x batches.
    """
    digits = digits or {}
    partial, finals = _partials(df, [batch_col, *keys], measures)
    parts = partial.withColumnRenamed(batch_col, out_batch).withColumn(out_batch, F.col(out_batch).cast("int"))
    parts = parts.filter(F.col(out_batch) <= n_batches)
    empty = (parts.groupBy(*keys).agg(F.min(out_batch).alias("__ll_first"))
             .select(*keys, F.explode(F.sequence(F.col("__ll_first"), F.lit(n_batches))).alias(out_batch)))
    both = parts.unionByName(empty, allowMissingColumns=True)
    sums = [c for c in parts.columns if c not in (*keys, out_batch)]
    filled = both.groupBy(*keys, out_batch).agg(*[F.sum(c).alias(c) for c in sums])
    w = Window.partitionBy(*keys).orderBy(out_batch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return filled.select(out_batch, *keys, *[_combine(name, fn, i, digits.get(name), over=w)
                                            for name, fn, i in finals])


def run_available_now(spark: SparkSession, source_dir: str, schema: T.StructType, keys: Sequence[str],
                      measures: Sequence[Measure], sink_dir: str, checkpoint_dir: str,
                      files_per_trigger: int | None = None, digits: dict[str, int] | None = None) -> DataFrame:
    """Process everything landed since the last run on ``checkpoint_dir``, as one
    micro-batch or (``files_per_trigger``) several, and return all micro-batch
    results so far with their ``batch_id`` (0-based)."""
    running = _running(spark, source_dir, schema, keys, measures, files_per_trigger, digits)

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")

    _run(running, "complete", write_batch, checkpoint_dir)
    return spark.read.parquet(sink_dir)


def run_keyed(spark: SparkSession, source_dir: str, schema: T.StructType, keys: Sequence[str],
              measures: Sequence[Measure], sink_dir: str, checkpoint_dir: str, buckets: int = 16,
              files_per_trigger: int | None = None, digits: dict[str, int] | None = None) -> DataFrame:
    """Process everything landed since the last run on ``checkpoint_dir`` and
    return the running aggregate, one row per key (a NULL key is a key).

    A micro-batch's rows are first stored, then replace the rows of their keys:
    only the ``buckets`` (by a hash of the keys) that hold a changed key are
    rewritten, by dynamic partition overwrite.  Doing a batch twice gives the
    same table, so a restart from the checkpoint is safe.
    """
    running = _running(spark, source_dir, schema, keys, measures, files_per_trigger, digits)
    table, bucket = f"{sink_dir}/table", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("__ll_bucket")
    stored = T.StructType([*running.schema.fields, T.StructField("__ll_bucket", T.IntegerType(), True)])

    def upsert(batch_df: DataFrame, batch_id: int) -> None:
        path = f"{sink_dir}/updates/batch_id={batch_id}"
        batch_df.write.mode("overwrite").parquet(path)     # the stateful plan runs once
        session = batch_df.sparkSession
        rows = session.read.schema(running.schema).parquet(path).select("*", bucket)
        session.createDataFrame([], stored).write.mode("ignore").partitionBy("__ll_bucket").parquet(table)
        touched = [r[0] for r in rows.select("__ll_bucket").distinct().collect()]      # `buckets` values at most
        now = session.read.schema(stored).parquet(table).where(F.col("__ll_bucket").isin(touched))
        new = rows.select(*[F.col(k).alias(f"__ll_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"__ll_{k}")) for k in keys]
        (now.join(new, same, "left_anti").unionByName(rows).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("__ll_bucket").parquet(table))

    _run(running, "update", upsert, checkpoint_dir)
    return spark.read.schema(stored).parquet(table).drop("__ll_bucket")


def _running(spark: SparkSession, source_dir: str, schema: T.StructType, keys: Sequence[str],
             measures: Sequence[Measure], files_per_trigger: int | None, digits: dict[str, int] | None) -> DataFrame:
    """The streaming aggregate over the files that land in ``source_dir``."""
    digits = digits or {}
    aggs = []
    for name, fn, col in measures:
        if fn == "count":
            aggs.append((F.count(F.lit(1)) if col == "*" else F.count(col)).alias(name))
            continue
        if fn == "sum":
            aggs.append(rounded_sum(col, digits.get(name)).alias(name))
        elif fn == "avg":
            aggs.append(rounded_avg(col, digits.get(name)).alias(name))
        else:
            raise ValueError(f"unsupported running aggregate {fn!r}")
    source = spark.readStream.schema(schema)
    if files_per_trigger:
        source = source.option("maxFilesPerTrigger", files_per_trigger)
    return source.parquet(source_dir).groupBy(*keys).agg(*aggs)


def _run(running: DataFrame, mode: str, write_batch, checkpoint_dir: str) -> None:
    query = (running.writeStream.outputMode(mode).foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
