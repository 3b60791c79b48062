"""Corpus pipeline: rules, near duplicates, decontamination, mix, shards.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns the columns of ``documents``; the last adds the shard.  Each
result is written below the shared checkpoint folder and read again, so a lost
executor repeats tasks of one stage only.  Very long texts stay whole in every
stage, extra columns pass through, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, mixing, quality_rules, sharding, simhash
from ledgerline.llm.common import materialise, small_side, text_key
from ledgerline.session import table_path

SHARDS = [f"shard-{i:02d}" for i in range(64)]


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents they reject go, null and empty texts among
    them; repeated rows share a verdict."""
    return quality_rules.keep_good(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near duplicates: one document of each group stays, the one with
    the smallest id (then text hash); null ids come last.  Of repeated rows
    (equal id and text) one stays; only these rows are shuffled.  Null and
    empty texts are one group."""
    found = materialise(simhash.near_duplicates(docs, shingle=3, max_bits=2), "pipeline-groups")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    keepers = found.groupBy("group_fp").agg(F.min(rank).alias("k")).select("group_fp", "k.doc_id", "k.text_key")
    same = [found["group_fp"] == keepers["group_fp"], found["doc_id"].eqNullSafe(keepers["doc_id"]),
            found["text_key"] == keepers["text_key"]]

    def rows_of(keys: DataFrame, how: str, name: str, rows: DataFrame) -> DataFrame:
        k = small_side(materialise(keys.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__tk")).distinct(), name))
        return rows.join(k, rows["doc_id"].eqNullSafe(k["__id"]) & (text_key(rows["text"]) == k["__tk"]), how)

    left = rows_of(found.join(keepers, same, "left_anti"), "left_anti", "pipeline-gone", docs)
    repeated = found.join(keepers, same, "left_semi").groupBy("doc_id", "text_key").count().filter("count > 1")
    once = rows_of(repeated, "left_anti", "pipeline-repeated", left)
    again = rows_of(repeated, "left_semi", "pipeline-repeated", left)
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark phrase go;
    null and wordless texts hold none."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as the mix takes it; null and empty
    texts, of size 0, come with whole passes."""
    return mixing.mix(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding: the documents with the shard each goes to; a null id is
    placed by its text."""
    return sharding.assign_shards(docs, SHARDS)


STAGES = [
    ("quality_rules", rules_stage),
    ("simhash_dedup", dedup_stage),
    ("decontamination", decontaminate_stage),
    ("mixing", mix_stage),
    ("sharding", shard_stage),
]

#: Fingerprints, references and the sampling order are not expressible in SQL; the tests hold brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stored and read again."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
