"""Change capture on a layer of Parquet partitions: matched-update merge, audit
log, images of the changed rows, replay, before/after and gold refresh.

* ``merge_update`` is a left join of the target to the change set followed by
  a ``CASE`` per updated column.  No join carries a hint: the optimizer
  broadcasts the change set when its bytes are below the session's threshold,
  else both sides shuffle on the key and AQE splits skewed target partitions.
* A change set with several rows for a key that exists in the target is
  refused, as a table-format MERGE refuses it; a join would silently multiply
  target rows.  The check is part of the plan: the job fails, no count runs
  before the caller acts.
* A layer is partitioned by a range of its key (``write_ranged``), so a change
  set reads and rewrites only the partitions that hold its keys
  (``merge_ranged``, dynamic partition overwrite); all other files stay.
* ``apply_change_set`` ties the log to the merge: the log and the images of the
  changed rows carry the change set's id and a bigint sequence, and count only
  once the id is marked as applied, which happens after the merge.  Readers
  join on the applied ids, so a run that ended before shows nothing, and a
  retry of the same id logs its rows once.
* ``gold_refresh`` folds the images (old row out, new row in) into stored group
  sums, so a gold table follows the changes without reading the silver layer.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.rounded import rounded

MATCH_MARKER = "__ll_matched"
#: Partition column of a ranged layer.
PART = "key_part"


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def merge_update(target: DataFrame, changes: DataFrame, on: str | Sequence[str],
                 set_columns: Mapping[str, str], check_duplicates: bool = True,
                 keep_marker: bool = False) -> DataFrame:
    """``MERGE INTO target USING changes ON key WHEN MATCHED THEN UPDATE SET``.

    ``set_columns`` maps a target column to the change column that replaces
    it.  Unmatched change rows are ignored, unmatched target rows and other
    columns are untouched, a change may set NULL (the match marker, not the
    value, decides).  With ``keep_marker`` the boolean column
    ``__ll_matched`` is kept for metrics.

    The change set is folded to one row per key before the join, so a target
    row meets one row at most; when a folded key had several rows and a target
    row matches it, the job fails.  ``check_duplicates=False`` is for keys known
    to be unique (the latest change per key) and saves that aggregate.
    """
    keys = _keys(on)
    tschema = {f.name: f.dataType for f in target.schema.fields}
    src = changes.select(*keys, *[F.col(s).alias(f"__ll_src_{t}") for t, s in set_columns.items()])
    if check_duplicates:
        new_values = [c for c in src.columns if c not in keys]
        # grouped on one struct, so that the join still shuffles both sides itself and AQE may split a hot key
        src = (src.groupBy(F.struct(*keys).alias("__ll_key"))
               .agg(*[F.first(c).alias(c) for c in new_values], F.count(F.lit(1)).alias("__ll_n"))
               .select("__ll_key.*", *new_values, "__ll_n"))
        refused = F.raise_error("merge refused: several change rows match the same target row").cast("boolean")
        matched = F.when(F.col("__ll_n") > 1, refused).otherwise(F.col("__ll_n").isNotNull())
    else:
        src = src.withColumn(MATCH_MARKER, F.lit(True))
        matched = F.coalesce(F.col(MATCH_MARKER), F.lit(False))
    joined = target.join(src, keys, "left")
    cols = []
    for c in target.columns:
        if c in set_columns:
            new = F.col(f"__ll_src_{c}").cast(tschema[c])
            cols.append(F.when(matched, new).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    if keep_marker:
        cols.append(matched.alias(MATCH_MARKER))
    return joined.select(*cols)


def change_log(changes: DataFrame, columns: Sequence[str], at: _dt.datetime | None = None,
               operation: str = "UPDATE", source_system: str = "loan_servicing_feed") -> DataFrame:
    """Audit rows for a change set: the change columns plus operation,
    source system and change timestamp (pass ``at`` to make runs repeat)."""
    # a Python datetime literal keeps its wall-clock value whatever the session time zone
    ts = F.current_timestamp() if at is None else F.lit(at)
    return changes.select(*columns, F.lit(operation).alias("operation"),
                          F.lit(source_system).alias("source_system"),
                          ts.alias("change_timestamp"))


def latest_changes(log: DataFrame, on: str | Sequence[str], order_col: str = "change_timestamp") -> DataFrame:
    """The last logged change per key, as one aggregate over the log: by
    the ``seq`` of its change set if the log has that column (see
    :func:`apply_change_set`), then by ``order_col``, then by the other
    columns, so the choice is repeatable."""
    keys = _keys(on)
    order = ["seq"] * ("seq" in log.columns and order_col != "seq") + [order_col]
    rest = [c for c in log.columns if c not in keys and c not in order]
    latest = log.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__ll_last"))
    kept = [c for c in log.columns if c not in keys]
    return latest.select(*keys, *[F.col(f"__ll_last.{c}").alias(c) for c in kept])


def replay_changes(base: DataFrame, log: DataFrame, on: str | Sequence[str], set_columns: Mapping[str, str],
                   order_col: str = "change_timestamp") -> DataFrame:
    """Re-apply a change log to a rebuilt table (a rerun of the silver step
    would otherwise lose merged changes): the latest change per key, merged
    with :func:`merge_update`."""
    return merge_update(base, latest_changes(log, on, order_col), on, set_columns, check_duplicates=False)


def before_after(before: DataFrame, after: DataFrame, keys_df: DataFrame, on: str,
                 columns: Sequence[str], layout: str = "wide") -> DataFrame:
    """Values of the keys in ``keys_df`` in two snapshots.

    ``layout="wide"``: one row per key, ``<key>, <col>_before, <col>_after``
    (one aggregate over the union of both snapshots; the key must be unique in
    each, as a primary key is -- a repeated key fails the job).
    ``layout="long"``: the rows of both snapshots tagged
    ``snapshot = 'before' | 'after'`` (a union, any keys).
    """
    if layout not in ("wide", "long"):
        raise ValueError(f"unknown layout {layout!r}")
    both = (before.select(F.lit("before").alias("snapshot"), on, *columns)
            .unionByName(after.select(F.lit("after").alias("snapshot"), on, *columns))
            .join(keys_df.select(on), on, "left_semi")
            .select("snapshot", on, *columns))
    if layout == "long":
        return both
    sides = {s: F.col("snapshot") == s for s in ("before", "after")}
    row = F.struct(*columns)
    folded = both.groupBy(on).agg(*[F.first(F.when(is_side, row), ignorenulls=True).alias(f"__ll_{s}") for s, is_side in sides.items()],
                                  *[F.count_if(is_side).alias(f"__ll_n_{s}") for s, is_side in sides.items()])
    refused = F.raise_error(f"{on} repeats within a snapshot; use layout='long'").cast("boolean")
    repeated = F.greatest("__ll_n_before", "__ll_n_after") > 1
    return (folded.filter(F.when(repeated, refused).otherwise(F.lit(True)))
            .select(on, *[F.col(f"__ll_{s}.{c}").alias(f"{c}_{s}") for c in columns for s in sides]))


# --- a layer in key ranges ---------------------------------------------------------

def write_ranged(df: DataFrame, path: str, part: str) -> int:
    """Write ``df`` partitioned by the SQL expression ``part`` over its key
    (``id div 1000000``); returns the rows written.  Rows of one range meet in
    one or, when they are many, several tasks."""
    obs = Observation(f"write_ranged_{uuid.uuid4().hex[:12]}")
    rows = df.observe(obs, F.count(F.lit(1)).alias("rows")).withColumn(PART, F.expr(part))
    rows.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(path)
    return int(obs.get.get("rows", 0))


def read_ranged(spark: SparkSession, path: str) -> DataFrame:
    """The layer's rows, without the partition column."""
    return spark.read.parquet(path).drop(PART)


def _touched(spark: SparkSession, path: str, keys: DataFrame, part: str) -> DataFrame:
    """The partitions of the layer that can hold ``keys``, read with static
    pruning.  At most one value per folder of the layer reaches the driver,
    which lists these folders anyway."""
    parts = [r[0] for r in keys.select(F.expr(part).alias(PART)).where(F.col(PART).isNotNull()).distinct().collect()]
    return spark.read.parquet(path).where(F.col(PART).isin(parts))


def lookup_ranged(spark: SparkSession, path: str, keys: DataFrame, on: str, part: str) -> DataFrame:
    """Rows of the layer whose key is in ``keys``, from their partitions only."""
    return _touched(spark, path, keys, part).drop(PART).join(keys.select(on), on, "left_semi")


def merge_ranged(spark: SparkSession, path: str, changes: DataFrame, on: str, set_columns: Mapping[str, str],
                 part: str) -> None:
    """:func:`merge_update` in place: only partitions with a changed key are
    read and replaced, the files of all others stay.  Setting the same values
    again changes nothing, so a failed run is simply repeated."""
    target = _touched(spark, path, changes, part)
    columns = target.columns
    merged = merge_update(target, changes, on, set_columns).select(*columns)
    (merged.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PART).parquet(path))


# --- change sets ---------------------------------------------------------------------

STEP_SCHEMA = T.StructType([
    T.StructField("change_set", T.StringType(), True),
    T.StructField("seq", T.LongType(), True),
    T.StructField("step", T.StringType(), True),
    T.StructField("operation", T.StringType(), True),
    T.StructField("at", T.TimestampType(), True),
    T.StructField("num_rows", T.LongType(), True),
    T.StructField("num_updated", T.LongType(), True),
])


def _mark(spark: SparkSession, feed: str, *row) -> None:
    spark.createDataFrame([row], STEP_SCHEMA).coalesce(1).write.mode("append").parquet(f"{feed}/steps")


def start_feed(spark: SparkSession, df: DataFrame, path: str, part: str, feed: str,
               at: _dt.datetime | None = None) -> int:
    """Write the layer at ``path`` and open its change feed at ``feed`` as
    sequence 0; returns the rows written."""
    rows = write_ranged(df, path, part)
    _mark(spark, feed, None, 0, "applied", "WRITE", at or _dt.datetime.now(_dt.timezone.utc), rows, None)
    return rows


def feed_history(spark: SparkSession, feed: str) -> DataFrame:
    """Applied change sets, newest first."""
    steps = spark.read.schema(STEP_SCHEMA).parquet(f"{feed}/steps")
    return steps.where("step = 'applied'").drop("step").orderBy(F.col("seq").desc())


def _visible(spark: SparkSession, feed: str, kind: str) -> DataFrame:
    applied = spark.read.schema(STEP_SCHEMA).parquet(f"{feed}/steps").where("step = 'applied'").select("change_set")
    return spark.read.parquet(f"{feed}/{kind}").drop("set").join(applied, "change_set", "left_semi")


def visible_log(spark: SparkSession, feed: str) -> DataFrame:
    """Audit rows of applied change sets, with change_set and seq."""
    return _visible(spark, feed, "log")


def visible_images(spark: SparkSession, feed: str) -> DataFrame:
    """Changed rows of applied change sets before and after (column ``side``)."""
    return _visible(spark, feed, "images")


def row_images(target: DataFrame, changes: DataFrame, on: str | Sequence[str],
               set_columns: Mapping[str, str]) -> DataFrame:
    """Matched target rows as they are (``side = 'before'``) and as the change
    set leaves them (``'after'``), from one join."""
    cols = target.columns
    merged = merge_update(target.withColumn("__ll_old", F.struct(*cols)), changes, on, set_columns, keep_marker=True)
    sides = F.array(F.struct(F.lit("before").alias("side"), F.col("__ll_old").alias("row")),
                    F.struct(F.lit("after").alias("side"), F.struct(*cols).alias("row")))
    return merged.where(MATCH_MARKER).select(F.explode(sides).alias("__ll_i")).select("__ll_i.side", "__ll_i.row.*")


def apply_change_set(spark: SparkSession, path: str, feed: str, change_set: str, changes: DataFrame, on: str,
                     set_columns: Mapping[str, str], part: str, at: _dt.datetime | None = None,
                     log_columns: Sequence[str] | None = None, operation: str = "UPDATE",
                     source_system: str = "loan_servicing_feed") -> int:
    """Merge ``changes`` into the layer at ``path`` under the id ``change_set``
    and return its sequence number.  One writer at a time.

    In order: the audit rows and the images of the changed rows are written
    (overwriting an earlier try), the set is marked prepared, the touched
    partitions are merged from the stored audit rows, and the set is marked
    applied.  A set already applied is left alone; one that was prepared goes
    on from its stored images, as the layer may be half merged.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", change_set):
        raise ValueError("a change set id is letters, digits, _ and -")
    feed = feed.rstrip("/")
    done = {r.step: r for r in spark.read.schema(STEP_SCHEMA).parquet(f"{feed}/steps")
            .where(F.col("change_set") == change_set).collect()}
    if "applied" in done:
        return done["applied"].seq
    when = at or _dt.datetime.now(_dt.timezone.utc)
    columns = list(log_columns or changes.columns)
    log_path, image_path = f"{feed}/log/set={change_set}", f"{feed}/images/set={change_set}"
    last = feed_history(spark, feed).first()
    if "prepared" in done:
        seq, updated = done["prepared"].seq, done["prepared"].num_updated
    else:
        seq = last.seq + 1
        tag = {"change_set": F.lit(change_set), "seq": F.lit(seq).cast("bigint")}
        (change_log(changes, columns, at, operation, source_system).withColumns(tag)
         .write.mode("overwrite").parquet(log_path))
        stored = spark.read.parquet(log_path)
        images = row_images(_touched(spark, path, stored, part).drop(PART), stored, on, set_columns)
        obs = Observation(f"images_{uuid.uuid4().hex[:12]}")
        (images.withColumns(tag).observe(obs, F.count_if(F.col("side") == "after").alias("updated"))
         .write.mode("overwrite").parquet(image_path))
        updated = int(obs.get.get("updated", 0))
        _mark(spark, feed, change_set, seq, "prepared", "MERGE", when, last.num_rows, updated)
    merge_ranged(spark, path, spark.read.parquet(log_path), on, set_columns, part)
    _mark(spark, feed, change_set, seq, "applied", "MERGE", when, last.num_rows, updated)
    return seq


# --- gold kept up to date ---------------------------------------------------------------

# measure = (output name, function, input column); function in count, avg, sum
Measure = tuple[str, str, str]
#: Exact sums, so that what was added can be taken away again.
_EXACT = "decimal(38,10)"


def group_sums(rows: DataFrame, keys: Sequence[str], measures: Sequence[Measure],
               sign: Column | None = None) -> DataFrame:
    """Per group the number of rows and, per measured column, its count and
    exact sum; with ``sign`` (1 or -1 per row) what a change adds or takes."""
    one = F.lit(1) if sign is None else sign
    aggs = [F.sum(one.cast("bigint")).alias("n_rows")]
    for col in dict.fromkeys(c for _, _, c in measures if c != "*"):
        aggs.append(F.sum(F.when(F.col(col).isNotNull(), one.cast("bigint")).otherwise(F.lit(0))).alias(f"n__{col}"))
    for col in dict.fromkeys(c for _, fn, c in measures if fn != "count"):
        value = F.col(col).try_cast(_EXACT)
        aggs.append(F.coalesce(F.sum(F.when(one > 0, value).otherwise(-value)), F.lit(0)).cast(_EXACT).alias(f"s__{col}"))
    return rows.groupBy(*keys).agg(*aggs)


def image_sums(images: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Group sums of the changes: old rows out, new rows in."""
    return group_sums(images, keys, measures, F.when(F.col("side") == "after", F.lit(1)).otherwise(F.lit(-1)))


def gold_refresh(base: DataFrame, deltas: DataFrame, keys: Sequence[str], measures: Sequence[Measure],
                 digits: int | None = 2) -> DataFrame:
    """The gold table after the changes: stored group sums plus those of the
    changes.  Groups that lost their last row go; work grows with the groups
    and the changed rows, not with the table."""
    both = base.unionByName(deltas)
    sums = [c for c in both.columns if c not in keys]
    folded = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).where("n_rows > 0")
    out = []
    for name, fn, col in measures:
        n, s = F.col("n_rows") if col == "*" else F.col(f"n__{col}"), F.col(f"s__{col}") if fn != "count" else None
        if fn == "count":
            out.append(n.cast("bigint").alias(name))
        elif fn == "sum":
            out.append(rounded(F.when(n > 0, s.cast("double")), digits).alias(name))
        elif fn == "avg":
            out.append(rounded(s.cast("double") / F.nullif(n, F.lit(0)), digits).alias(name))
        else:
            raise ValueError(f"{fn!r} cannot be kept up to date from sums")
    return folded.select(*keys, *out)
