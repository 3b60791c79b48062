"""Registered queries of the training-data operators.

Each applies its operator with production parameters to the whole table and
derives the digest columns of its result from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (bpe, chat_windows, decontaminate, lexical_search, license_scan, lm_scoring, merkle, mixing, quality_classifier,
                            quality_rules, sharding, simhash, toxicity)
from ledgerline.llm.common import crc_mod
from ledgerline.session import table_path


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf, name))


def _predicted(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op1_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    scored = quality_classifier.train_and_score(_t(spark, sf, "documents"), _t(spark, sf, "labels"))
    return _predicted(scored).select("doc_id", "held_out", "score", "predicted", "raw")


def op2_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scoring.score_texts(_t(spark, sf, "documents"))


SHARDS = [f"shard-{i:02d}" for i in range(64)]


def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.assign_shards(_t(spark, sf, "documents"), SHARDS, slot_col="slot")
    return placed.select("doc_id", "slot", "shard")


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.quality_report(_t(spark, sf, "documents"))


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_t(spark, sf, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op6_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.document_licenses(_t(spark, sf, "documents"))


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    plan = mixing.mix_plan(_t(spark, sf, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op8_chat_windows(spark: SparkSession, sf: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id bigint, turn bigint, role string, text string")
    turns = _t(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_windows.read_back(chat_windows.format_windows(turns))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    scored = toxicity.train_and_score(_t(spark, sf, "documents"), _t(spark, sf, "labels"))
    return _predicted(scored).select("doc_id", "held_out", "score", "predicted", "vote", "neighbours", "cosines",
                                     "neighbour_labels")


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(_t(spark, sf, "documents"), _t(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"), "n_near_items")


#: Tokenizer file of the query; the operator takes any path.
TOKENIZER = "byte_bpe_50k.json"


def op11_bpe_coding(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    model = bpe.load_model(public_tokenizers.path(TOKENIZER))
    coded = bpe.encode_texts(_t(spark, sf, "documents"), model, decoded=True)
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    cut = F.replace("text", F.lit("\n"), F.lit(""))
    tampered = merkle.leaf_hash(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), cut)
    proofs = merkle.multiproofs(_t(spark, sf, "documents"), claimed=F.when(crc_mod(F.col("doc_id"), 2) == 0, tampered))
    folded = merkle.fold(F.coalesce("claimed", "leaf"), F.col("steps"))
    proofs = proofs.withColumn("folded_root", folded)
    return proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("steps")), 256)
                         .alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_search.search(_t(spark, sf, "documents"), _t(spark, sf, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_sharding": op3_sharding,
    "op4_quality_rules": op4_quality_rules,
    "op5_simhash": op5_simhash,
    "op6_license_scan": op6_license_scan,
    "op7_mixing": op7_mixing,
    "op8_chat_windows": op8_chat_windows,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_bpe_coding": op11_bpe_coding,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_lexical_search": op13_lexical_search,
}

_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"



def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


# The lookup table is a fixed value of the shard names; the placement of every row is recomputed in SQL.
ORACLE: dict[str, str] = {
    "op3_sharding": f"""
        WITH t AS (SELECT string_split('{",".join(map(str, sharding.lookup_table(SHARDS)))}', ',') AS owner),
        d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15))::BIGINT
                             % {sharding.TABLE_SIZE} AS slot FROM documents)
        SELECT doc_id, slot, 'shard-' || lpad(owner[slot + 1], 2, '0') AS shard FROM d, t""",
    "op12_merkle_manifest": """
        WITH RECURSIVE bytes AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b:
                        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
            FROM range(256) r(i)),
        docs AS (
            SELECT doc_id, source, concat({fields}) AS head, text,
                   list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
                               lambda ch: ascii(ch)::BIGINT)), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])) % 2
                   = 1 AS even  -- the last step of crc32 flips every bit
            FROM documents, bytes),
        leaves AS (
            SELECT doc_id, source, sha256(head || {text}) AS leaf,
                   CASE WHEN even THEN sha256(head || {cut}) ELSE sha256(head || {text}) END AS claimed,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx
            FROM docs),
        nodes AS (
            SELECT source AS tree, 0 AS level, idx, count(*) OVER (PARTITION BY source) AS n, leaf AS digest FROM leaves
            UNION ALL
            SELECT tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
            FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 3, n),
        roots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx FROM nodes WHERE n = 1),
        top AS (
            SELECT 0 AS level, idx, count(*) OVER () AS n, digest FROM roots
            UNION ALL
            SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
            FROM top WHERE n > 1 GROUP BY level, idx // 3, n),
        steps AS (
            SELECT l.doc_id, s.level,
                   coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < l.idx // (3 ** s.level)::BIGINT), '') AS b,
                   coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > l.idx // (3 ** s.level)::BIGINT), '') AS a
            FROM leaves l JOIN nodes s ON s.tree IS NOT DISTINCT FROM l.source AND s.n > 1
                 AND s.idx // 3 = l.idx // (3 ** (s.level + 1))::BIGINT
            GROUP BY l.doc_id, s.level
            UNION ALL
            SELECT l.doc_id, 1000 + s.level,
                   coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < r.idx // (3 ** s.level)::BIGINT), ''),
                   coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > r.idx // (3 ** s.level)::BIGINT), '')
            FROM leaves l JOIN roots r ON r.tree IS NOT DISTINCT FROM l.source
                 JOIN top s ON s.n > 1 AND s.idx // 3 = r.idx // (3 ** (s.level + 1))::BIGINT
            GROUP BY l.doc_id, s.level),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS k FROM steps),
        folded AS (
            SELECT doc_id, 0::BIGINT AS k, claimed AS digest FROM leaves
            UNION ALL
            SELECT f.doc_id, s.k, sha256(s.b || f.digest || s.a)
            FROM folded f JOIN numbered s ON s.doc_id = f.doc_id AND s.k = f.k + 1),
        proof AS (SELECT doc_id, sha256(string_agg(b || a, '' ORDER BY level)) AS digest, count(*) AS n FROM steps GROUP BY doc_id)
        SELECT l.doc_id, l.leaf, r.digest AS subroot, t.digest AS root, p.digest AS proof_sha256,
               f.digest AS folded_root, f.digest = t.digest AS verified
        FROM leaves l JOIN roots r ON r.tree IS NOT DISTINCT FROM l.source JOIN proof p ON p.doc_id = l.doc_id
             JOIN folded f ON f.doc_id = l.doc_id AND f.k = p.n JOIN (SELECT digest FROM top WHERE n = 1) t ON true"""
    .replace("{fields}", ", ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars")))
    .replace("{text}", _field("text")).replace("{cut}", _field("replace(text, chr(10), '')")),
    "op13_lexical_search": r"""
        WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}')) AS term
                       FROM documents),
        docs AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
        total AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM docs),
        items AS (SELECT DISTINCT item_id,
                         unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}')) AS term
                  FROM benchmark),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM items) GROUP BY ALL),
        weight AS (SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
                   FROM tf, total GROUP BY term, all_docs),
        scored AS (SELECT item_id, doc_id,
                          sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))))::BIGINT
                          AS score
                   FROM tf JOIN items USING (term) JOIN weight USING (term) JOIN docs USING (doc_id), total
                   GROUP BY item_id, doc_id)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
              FROM scored WHERE score > 0) WHERE rank <= 10""".replace("{term}", _TERM).replace("{upper}", _AZ)
    .replace("{lower}", _AZ.lower()),
}
