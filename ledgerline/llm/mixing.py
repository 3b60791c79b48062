"""Mixing sources to target weights by weighted sampling without replacement.

Targets: every source has a weight; the words of all sources together are
shared out by weight, no source above ``max_epochs`` times its own words, and
what is left over is shared again among the others until none is above.

Within a source, whole passes over all its documents come first.  The rest of
the target is filled in the order of exponential keys ``-ln(u) / w`` (w: the
document's quality weight, u: a hash of the document as a uniform number), the
Efraimidis-Spirakis order: documents are taken while the running word count
stays below the budget, the last one if at least half of it fits.

The running count never sorts a whole source.  Keys fall into ``BUCKETS``
ordered buckets; bucket totals are prefix-summed per source, all buckets before
the one that crosses the budget are taken whole, and only the documents of the
crossing bucket are sorted.

Defined cases: null text has size 0; a null source is a source of its own, last
in the order; sources and tables without words get target 0; repeated rows
(equal id, text and source) are taken one by one, so a source of equal rows
meets its target too (which of the equal rows does not matter); a very long
text counts whole, so a source may miss its target by half of its largest
document; reruns agree; extra columns, whatever their names, stay untouched; an
empty table stays empty.

The sources' own table (a row per source) is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, small_side, split_words, text_key, unit_hash

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
BUCKETS = 4096
#: Tasks that number the equal rows of a document of which some are taken.
_SALTS = 64


def word_count(text: Column) -> Column:
    return F.size(split_words(text)).cast("long")


def default_quality(text: Column) -> Column:
    """Quality weight from 0.25 to 1: the share of different words."""
    words = split_words(text)
    return F.lit(0.25) + 0.75 * F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per
    source.  Weights go to the sources in code-point order, null last."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("w", F.get(F.array(*[F.lit(float(x)) for x in weights]),
                                    (F.row_number().over(by_name) - 1) % len(weights)))
    w = w.withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    # sources reach their caps in the order of cap / weight; `level` is words per weight once those before are capped
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    zero = F.lit(0.0)
    w = (w.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), zero))
                      / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), zero)))
         .withColumn("capped", F.col("cap") / F.col("w") <= F.col("level")).withColumn("at", F.row_number().over(order)))
    last = F.min(F.when(~F.col("capped"), F.struct("at", "level"))).over(everything)
    return w.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(
        F.col("w") * last["level"]).alias("target"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, quality: Column, size: Column,
           seed: int) -> DataFrame:
    """__row (the row as it is), __id, __tk, __src, __size, __key, __bucket
    and __at, which tells equal rows apart."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).alias("__id"),
                     text_key(F.col(text_col)).alias("__tk"), F.col(source_col).alias("__src"), size.alias("__size"),
                     quality.alias("__quality"), F.monotonically_increasing_id().alias("__at"))
    u = unit_hash(F.lit(seed), F.coalesce(F.col("__id").cast("string"), F.lit("")), F.col("__tk"), F.col("__src"))
    df = df.withColumn("__key", -F.log(u) / F.greatest("__quality", F.lit(1e-6))).drop("__quality")
    return df.withColumn("__bucket", F.least(F.floor((1 - F.exp(-F.col("__key") * 0.75)) * BUCKETS),
                                             F.lit(BUCKETS - 1)).cast("int"))


def _picked(rows: DataFrame) -> DataFrame:
    """Of each unit's equal rows (__src, __id, __tk, __at, __take) the first
    ``__take``: (__src, __id, __tk, __at).  A unit's rows are numbered in salts,
    so a unit of any size spreads over tasks."""
    unit = ["__src", "__id", "__tk"]
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64("__at"), F.lit(_SALTS)))
    counts = rows.groupBy(*unit, "__salt").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*unit).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"{c}_o") for c in (*unit, "__salt")],
                            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    own = F.row_number().over(Window.partitionBy(*unit, "__salt").orderBy("__at"))
    same = F.col("__salt") == F.col("__salt_o")
    for c in unit:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_o"))
    return (rows.withColumn("__place", own).join(offsets, same)
            .where(F.col("__offset") + F.col("__place") <= F.col("__take")).select(*unit, "__at"))


def _plan(slim: DataFrame, weights: tuple[float, ...], max_epochs: float) -> tuple[DataFrame, DataFrame]:
    """Per source: __s, source_size, target, __epochs, __cross (bucket that
    crosses the budget).  And what is taken of the crossing buckets: units
    (__es, __eid, __etk) with __eat null, or single rows of a unit."""
    buckets = materialise(slim.groupBy("__src", "__bucket").agg(F.sum("__size").alias("words")), "mix-buckets")
    sizes = buckets.groupBy(F.col("__src").alias("source")).agg(F.sum("words").cast("double").alias("source_size"))
    per_source = targets(sizes, weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    per_source = per_source.withColumn("__epochs", epochs.cast("long")).withColumn(
        "__budget", F.col("target") - F.col("__epochs") * F.col("source_size"))
    per_source = materialise(per_source.select(F.col("source").alias("__s"), F.col("source_size").cast("long")
                                               .alias("source_size"), "target", "__epochs", "__budget"), "mix-targets")
    upto = Window.partitionBy("__src").orderBy("__bucket")
    ends = buckets.withColumn("end", F.sum("words").over(upto))
    crossing = (ends.join(per_source, F.col("__src").eqNullSafe(F.col("__s")))
                .filter(F.col("end") > F.col("__budget")).groupBy("__s")
                .agg(F.min(F.struct("__bucket", (F.col("end") - F.col("words")).alias("before"))).alias("x"))
                .select(F.col("__s").alias("__cs"), F.col("x.__bucket").alias("__cross"), F.col("x.before").alias("__before")))
    per_source = materialise(per_source.join(crossing, F.col("__s").eqNullSafe(F.col("__cs")), "left").drop("__cs"),
                             "mix-plan")
    edge = (slim.join(small_side(per_source), F.col("__src").eqNullSafe(F.col("__s")))
            .filter(F.col("__bucket") == F.col("__cross")))
    edge = materialise(edge.select("__src", "__id", "__tk", "__key", "__size", "__at", "__before", "__budget"), "mix-crossing")
    unit = ["__src", "__id", "__tk"]
    # equal rows enter the running count as one unit, of which some rows may be taken
    units = edge.groupBy(*unit, "__key", "__size", "__before", "__budget").agg(F.count("*").alias("__n"))
    running = Window.partitionBy("__src").orderBy("__key", "__id", "__tk").rowsBetween(Window.unboundedPreceding, -1)
    left = (F.col("__budget") - F.col("__before")
            - F.coalesce(F.sum(F.col("__size") * F.col("__n")).over(running), F.lit(0)))
    fitting = F.when(F.col("__size") > 0, F.floor(left / F.col("__size") + 0.5)).otherwise(F.when(left > 0, F.col("__n")).otherwise(0))
    units = materialise(units.withColumn("__take", F.least(F.greatest(fitting, F.lit(0)), F.col("__n"))).where("__take > 0"),
                        "mix-units")
    some = units.where("__take < __n").select(*[F.col(c).alias(f"{c}_u") for c in unit], "__take")
    same = F.lit(True)
    for c in unit:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_u"))
    picked = _picked(edge.select(*unit, "__at").join(some, same).select(*unit, "__at", "__take"))
    taken = (units.where("__take = __n").select(*unit, F.lit(None).cast("long").alias("__at")).unionByName(picked))
    return per_source, materialise(taken.select(F.col("__src").alias("__es"), F.col("__id").alias("__eid"),
                                                F.col("__tk").alias("__etk"), F.col("__at").alias("__eat")), "mix-edge")


def _copies(df: DataFrame, per_source: DataFrame, edge: DataFrame) -> DataFrame:
    """Adds the source's plan and __copies, how often the mix takes the row."""
    df = df.join(small_side(per_source), F.col("__src").eqNullSafe(F.col("__s")))
    on = (F.col("__src").eqNullSafe(F.col("__es")) & F.col("__id").eqNullSafe(F.col("__eid"))
          & (F.col("__tk") == F.col("__etk")) & (F.col("__eat").isNull() | (F.col("__eat") == F.col("__at"))))
    df = df.join(small_side(edge), on, "left")
    part = (F.col("__cross").isNull() & (F.col("__budget") > 0) | (F.col("__bucket") < F.col("__cross"))
            | F.col("__etk").isNotNull())
    return df.withColumn("__copies", F.col("__epochs") + F.coalesce(part, F.lit(False)).cast("long"))


_SLIM = ["__id", "__tk", "__src", "__size", "__key", "__bucket", "__at"]


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS,
             quality: Column | None = None, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, copies, taken."""
    quality = default_quality(F.col(text_col)) if quality is None else quality
    keyed = _keyed(docs, id_col, text_col, source_col, quality, word_count(F.col(text_col)), seed)
    slim = materialise(keyed.select(*_SLIM), "mix-keys")
    out = _copies(slim, *_plan(slim, weights, max_epochs))
    return out.select(F.col("__id").alias("doc_id"), F.col("__src").alias("source"), F.col("__size").alias("size"),
                      "source_size", "target", F.col("__copies").alias("copies"),
                      (F.col("__copies") * F.col("__size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS,
        quality: Column | None = None, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the plan takes it.
    ``docs`` must be a stored frame: it is read twice and its rows' places must
    agree."""
    quality = default_quality(F.col(text_col)) if quality is None else quality
    keyed = _keyed(docs, id_col, text_col, source_col, quality, word_count(F.col(text_col)), seed)
    slim = materialise(keyed.select(*_SLIM), "mix-keys")
    out = _copies(keyed, *_plan(slim, weights, max_epochs)).filter(F.col("__copies") > 0)
    out = out.withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return out.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
