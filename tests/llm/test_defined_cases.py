"""Every operator and stage on nulls, empty and very long texts, repeated rows,
extra columns with names that the code uses itself, and empty tables; and the
learned operators against brute force."""

import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
import ledgerline.llm
from ledgerline.llm import (bpe, chat_windows, decontaminate, lexical_search, license_scan, lm_scoring, merkle, mixing,
                            quality_classifier, quality_rules, sharding, simhash, toxicity)
from ledgerline.llm.calibration import isotonic_apply, isotonic_fit

BASE = ["doc_id", "text", "lang", "source", "n_chars"]
LONG = "long word " * 30_000
ROWS = [(1, "the cat sat on the mat and went to the house of the dog. " * 3, "en", "a", 5), (2, None, "en", "a", None),
        (3, "", None, None, 0), (None, "some text of no id here", "en", "b", 1), (None, None, None, None, None),
        (4, LONG, "en", "a", 9), (5, "same row", "en", "b", 8), (5, "same row", "en", "b", 8), (5, "same id", "xx", "b", 7),
        (6, "one two three four five six seven eight nine ten eleven", "de", "c", 1)]
ITEMS = [(1, "one two three four five six seven eight nine ten"), (2, None), (None, "cat dog")]


def internal_names() -> list[str]:
    """Every name that an operator gives a column of its own."""
    found = set()
    for path in Path(ledgerline.llm.__file__).parent.glob("*.py"):
        code = path.read_text()
        found |= set(re.findall(r'(?:alias|withColumn|withColumnRenamed)\(\s*"(\w+)"', code))
        found |= set(re.findall(r'"(__\w+)"', code))
        found |= {n for part in re.findall(r'"((?:\w+ (?:bigint|int|string|double|binary|boolean)(?:, )?)+)"', code)
                  for n in re.findall(r"(\w+) ", part)}
    return sorted(n for n in found if n.lower() not in {*BASE, "shard"})


def crowded(spark, rows, names=BASE, types=("bigint", "string", "string", "string", "bigint")):
    """The rows with an extra column for every internal name."""
    schema = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in zip(names, types)])
    df = spark.createDataFrame(rows, schema)
    taken = {n.lower() for n in names}
    extra = [n for n in internal_names() if n.lower() not in taken]
    return df.select("*", *[F.lit("extra").alias(n) for n in extra])


@pytest.fixture(scope="module")
def docs(spark):
    assert len(internal_names()) > 100
    df = crowded(spark, ROWS)
    from ledgerline.llm.common import materialise
    return materialise(df, "test-crowded")


def labelled(spark):
    return crowded(spark, [(1, 1, 0), (4, 0, 1), (5, 1, 0), (6, 0, 1), (None, 1, 1), (2, None, None), (5, 1, 0)],
                   ["doc_id", "quality", "toxic"], ["bigint", "int", "int"])


def benchmark(spark):
    return crowded(spark, ITEMS, ["item_id", "text"], ["bigint", "string"])


OPERATORS = {
    "quality_classifier": lambda s, d: quality_classifier.train_and_score(d, labelled(s)),
    "lm_scoring": lambda s, d: lm_scoring.score_texts(d),
    "quality_rules": lambda s, d: quality_rules.quality_report(d),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "license_scan": lambda s, d: license_scan.document_licenses(d),
    "mixing": lambda s, d: mixing.mix_plan(d),
    "toxicity": lambda s, d: toxicity.train_and_score(d, labelled(s)),
    "decontaminate": lambda s, d: decontaminate.contamination(d, benchmark(s)),
    "bpe": lambda s, d: bpe.encode_texts(d, bpe.load_model(__import__("public_tokenizers").path("byte_bpe_50k.json")), decoded=True),
    "merkle": lambda s, d: merkle.multiproofs(d),
    "sharding": lambda s, d: sharding.assign_shards(d, ["x", "y"], 251),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator_on_defined_cases(spark, docs, name):
    got = OPERATORS[name](spark, docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)
    plain = OPERATORS[name](spark, docs.select(*BASE)).collect()
    shown = [c for c in plain[0].asDict() if c not in ("slot",)]
    if name not in ("mixing", "sharding"):      # learned on the same rows, so the same result
        def keyed(rows):
            return sorted(str([round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in shown)]) for r in rows)
        assert keyed(got) == keyed(plain)
    assert OPERATORS[name](spark, docs.limit(0)).count() == 0


def test_search_and_chat_on_defined_cases(spark, docs):
    found = lexical_search.search(docs, benchmark(spark)).collect()
    assert {(r.item_id, r.doc_id) for r in found if r["rank"] == 1} == {(1, 6), (None, 1)}
    turns = crowded(spark, [(1, 0, "user", LONG), (1, 1, "assistant", None), (None, None, None, ""), (1, 1, "assistant", None)],
                    ["conv_id", "turn", "role", "text"], ["bigint", "int", "string", "string"])
    got = {r.conv_id: r.n_turns for r in chat_windows.read_back(chat_windows.format_windows(turns)).collect()}
    assert got == {1: 3, None: 1}


def sf_dir(spark, tmp_dir):
    benchmark(spark).write.parquet(f"{tmp_dir}/benchmark.parquet")
    return tmp_dir


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stage_on_defined_cases(spark, docs, tmp_dir, stage):
    name, work = corpus_pipeline.STAGES[stage]
    out = work(spark, docs, sf_dir(spark, tmp_dir))
    assert out.columns == docs.columns + (["shard"] if name == "sharding" else [])
    rows = out.collect()
    assert {r["bucket"] if "bucket" in out.columns else "extra" for r in rows} <= {"extra"}
    assert {(r.doc_id, r.text) for r in rows} <= {(r[0], r[1]) for r in ROWS}
    if name == "simhash_dedup":
        assert sorted(str((r.doc_id, (r.text or "")[:9])) for r in rows) == sorted(map(str, [
            (1, "the cat s"), (2, ""), (None, "some text"), (4, "long word"), (5, "same row"), (5, "same id"),
            (6, "one two t")]))
    if name == "decontamination":
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS if r[0] != 6)
    if name == "sharding":
        assert len(rows) == len(ROWS)
    assert work(spark, docs.limit(0), tmp_dir).count() == 0


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_dir):
    """The corpus of the smallest tables: what each stage keeps, worked out row
    by row from the stage before."""
    import hashlib
    import zlib  # noqa: F401 - same helpers as the operator tests
    from tests.llm.test_operators import base_counts, contaminated, fingerprint
    sf = "/root/testdata/sf0.001"
    kept = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema

    def stage(i, rows):
        work = corpus_pipeline.STAGES[i][1]
        from ledgerline.llm.common import materialise
        out = materialise(work(spark, materialise(spark.createDataFrame(rows, schema), "test-in"), sf), "test-out")
        return [tuple(r) for r in out.collect()]

    good = stage(0, kept)
    failed = {r for r in kept if base_counts(r[1])[5]}
    assert not failed & set(good) and set(good) <= set(kept) and len(good) > 0.8 * (len(kept) - len(failed))
    fps = {r[0]: fingerprint(r[1]) for r in good}
    parent = {d: d for d in fps}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    alone = stage(1, good)
    assert sorted(alone) == sorted(r for r in good if find(r[0]) == r[0])
    clean = stage(2, alone)
    hit = {d for d, _, n_hit, _, _ in contaminated([(r[0], r[1]) for r in alone], items) if n_hit}
    assert sorted(clean) == sorted(r for r in alone if r[0] not in hit)
    mixed = stage(3, clean)
    plan = mixing.mix_plan(spark.createDataFrame(clean, schema)).collect()
    copies = {r.doc_id: r.copies for r in plan}
    assert sorted(mixed) == sorted(r for r in clean for _ in range(copies[r[0]]))
    for source in {r.source for r in plan}:
        own = [r for r in plan if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1
    owner = sharding.lookup_table(corpus_pipeline.SHARDS)
    placed = stage(4, mixed)
    assert sorted(placed) == sorted(
        (*r, corpus_pipeline.SHARDS[owner[int(hashlib.md5(str(r[0]).encode()).hexdigest()[:15], 16) % sharding.TABLE_SIZE]])
        for r in mixed)
    whole = [tuple(r) for r in corpus_pipeline.run(spark, sf).collect()]
    assert sorted(whole) == sorted(placed)


def test_quality_classifier_equals_plain_numpy(spark):
    """Fourier features, ridge and isotonic regression over all rows at once."""
    rows = [(i, ("good words in a row. " * (1 + i % 7)) if i % 3 else "## | $ " * (2 + i % 5), "en", "s", 1) for i in range(120)]
    docs = crowded(spark, rows).select(*BASE).repartition(5)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)], "doc_id bigint, quality int")
    got = {r.doc_id: (r.raw, r.score, r.held_out) for r in quality_classifier.train_and_score(docs, labels).collect()}
    stats = {r.doc_id: np.array(r.x, float) for r in quality_classifier.document_statistics(docs, "doc_id", "text").collect()}
    train = [i for i in range(120) if not got[i][2]]
    x, y = np.array([stats[i] for i in train]), np.array([i % 3 > 0 for i in train], float)
    fmap = quality_classifier.FourierMap(x.mean(0), x.std(0), quality_classifier.FEATURES, quality_classifier.SEED)
    z = fmap(x)
    beta = np.linalg.solve(z.T @ z + quality_classifier.RIDGE * len(train) * np.eye(z.shape[1]) / quality_classifier.FEATURES, z.T @ y)
    raw = {i: float((fmap(stats[i][None]) @ beta)[0]) for i in stats}
    knots = isotonic_fit(np.array([raw[i] for i in train]), y, np.ones(len(train)))
    for i, (r, score, _) in got.items():
        assert r == pytest.approx(raw[i], abs=1e-5)
    exact = isotonic_apply(knots, np.array([raw[i] for i in sorted(got)]))
    assert np.mean(np.abs(exact - np.array([got[i][1] for i in sorted(got)]))) < 0.02


def test_toxicity_equals_all_pairs(spark):
    """Votes and neighbours from all cosines between documents and examples."""
    from tests.llm.test_operators import _labelled
    docs, labels = _labelled(spark, lambda i: f"the w{i % 30} of x{i % 9} y{i % 7} and so on w{i % 11}",
                             lambda i: f"the w{i % 20} badstem{i % 5} y{i % 8} and so badstem{i % 3} on")
    shared, knots, _ = toxicity.fit(docs, labels)
    voter = shared.value
    assert {t for t in voter.at if not t.startswith(b" ")} <= {b"bads", b"badste"}
    words = {w for r in docs.collect() for w in toxicity.words_of((r.text or "").encode())}
    assert {b" " + w for w in words if sum(w in toxicity.words_of((r.text or "").encode()) for r in docs.collect()) > 150} <= set(voter.at)
    dense = np.zeros((voter.index.n, len(voter.at)))
    for i in range(voter.index.n):
        t, w = voter.index.vector(i)
        dense[i, t] = w
    assert np.allclose((dense ** 2).sum(1), 1)
    scored = toxicity.train_and_score(docs, labels).collect()
    text = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    n_empty = 0
    for r in scored:
        t, w = voter.unit(voter.counts(text[r.doc_id]))
        cosine = dense[:, t] @ w if len(t) else np.zeros(len(dense))
        best = np.sort(cosine[cosine > 1e-12])[::-1][:toxicity.K]
        assert np.allclose(r.cosines, best, atol=1e-6) and len(r.neighbours) == len(r.neighbour_labels) == len(best)
        vote = sum(c * y for c, y in zip(r.cosines, r.neighbour_labels)) / (sum(r.cosines) + toxicity.SHRINK)
        assert r.vote == pytest.approx(vote if len(best) else 0.0)
        assert r.score == pytest.approx(float(isotonic_apply(knots, np.array([r.vote]))[0]))
        n_empty += not len(best)
    assert n_empty == 2           # the null and the empty text
