"""The training-data operators against brute-force versions on small rows:
nulls, empty and repeated texts, ties, extra columns and empty tables."""

import collections
import hashlib
import math
import pickle
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import (chat_windows, decontaminate, license_scan, lm_scoring, mixing, quality_classifier,
                            quality_rules, sharding, simhash, toxicity)
from ledgerline.llm.calibration import isotonic_apply, isotonic_fit

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
MATCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# an extra column whose name an operator uses inside
SCHEMA = "doc_id bigint, text string, lang string, source string, size string, item string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


DOCS = [(1, "a b c d e a b c d e x", "en", "s"), (2, None, "en", "s"), (3, "", None, None),
        (4, "x\n\nx\n \n \ny x\nx", "xx", "t"), (None, "w " * 300, None, "s"), (5, "a a a a a a", "en", "t"),
        (5, "\u00c9 \u00e9 |#| <> " * 3, "de", "t"), (6, "one two three four", "en", "s"),
        (6, "one two three four", "en", "s"), (7, "word" + " long text" * 9000, "en", "u")]


def base_counts(text):
    text = text or ""
    words = SPACE.findall(text)
    at = collections.defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i:i + 5])].append(i)
    inside = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside),
            n < 10 or 100 * len(inside) > 20 * n)


def test_quality_rules_counts_and_filter(spark):
    df = frame(spark, DOCS)
    got = [tuple(r) for r in quality_rules.quality_report(df).collect()]
    assert sorted(map(str, [g[:7] for g in got])) == sorted(map(str, [(d[0], *base_counts(d[1])) for d in DOCS]))
    assert all(not g[-1] for g in got if g[6])
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(g[-1] for g in got)
    assert quality_rules.quality_report(df.limit(0)).count() == quality_rules.keep_good(df.limit(0)).count() == 0


def test_quality_rules_reject_far_histograms(spark):
    rng = np.random.default_rng(1)
    common = ["the", "of", "and", "to", "in", "a", "is"]

    def word():
        return "".join(chr(97 + int(c)) for c in rng.integers(0, 26, 7))

    plain = [(i, " ".join(common[int(rng.integers(7))] if rng.random() < 0.4 else word() for _ in range(220)) + ".",
              "en", "s") for i in range(9)]
    junk = (99, " ".join(f"q{i}###" for i in range(200)), "en", "s")
    verdict = {r.doc_id: r.kept for r in quality_rules.quality_report(frame(spark, [*plain, junk])).collect()}
    assert not verdict.pop(99) and all(verdict.values())


def fingerprint(text):
    words = (text or "").translate(LOWER)
    words = SPACE.findall(words)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_groups(spark):
    found = simhash.near_duplicates(frame(spark, DOCS)).collect()
    assert sorted(r.fp % 2 ** 64 for r in found) == sorted(fingerprint(d[1]) for d in DOCS)
    groups = {(r.doc_id, r.text_key): r.component_id for r in found}
    assert {r.component_id for r in found if r.doc_id in (2, 3)} == {2}      # no words: fingerprint zero, linked
    assert len(found) == len(DOCS) and groups
    assert simhash.near_duplicates(frame(spark, DOCS).limit(0)).count() == 0


def test_hot_fingerprints_return_the_same_rows(spark, monkeypatch):
    fps = spark.createDataFrame([(i, i, i % 3) for i in range(12)] + [(99, 99, 7)],
                                "doc_id bigint, text_key bigint, fp bigint")
    classes = spark.createDataFrame([(0, 0, 0, 4), (1, 0, 0, 4), (2, 2, 2, 4), (7, 7, 99, 1)],
                                    "fp bigint, group_fp bigint, component_id bigint, n_rows bigint")
    expected = sorted(map(tuple, simhash._members(fps, classes).collect()))
    assert len(expected) == 13
    monkeypatch.setattr(simhash, "HOT_ROWS", 2)
    assert sorted(map(tuple, simhash._members(fps, classes).collect())) == expected


@pytest.mark.parametrize("leaf_rows", [8, 65_536])
def test_links_close_like_all_pairs(spark, leaf_rows):
    rng = np.random.default_rng(leaf_rows)
    seeds = [int(x) for x in rng.integers(0, 2 ** 64, 6, dtype=np.uint64)]
    fps = set(seeds)
    for _ in range(80):
        x = seeds[int(rng.integers(6))]
        for _ in range(int(rng.integers(0, 5))):
            x ^= 1 << int(rng.integers(64))
        fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    roots = {r.node: r.root for r in simhash.components(simhash.near_links(df, 2, leaf_rows)).collect()}
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if int(fps[i] ^ fps[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    signed = fps.view(np.int64).tolist()
    for i in range(len(fps)):
        for j in range(i):
            same = roots.get(signed[i], signed[i]) == roots.get(signed[j], signed[j])
            assert same == (find(i) == find(j))


def contaminated(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        words = MATCH.findall((text or "").translate(LOWER))
        k = min(10, len(words))
        for i in range(len(words) - k + 1 if words else 0):
            windows[tuple(words[i:i + k])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        words, hit, found = MATCH.findall((text or "").translate(LOWER)), set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if tuple(words[i:i + k]) in windows:
                    found |= windows[tuple(words[i:i + k])]
                    hit.update(range(i, i + k))
        out.append((doc, len(words), len(hit), len(found), sorted(found)))
    return sorted(out, key=str)


def test_contamination_equals_brute_force(spark):
    run = "a b c d e f g h i j k l m"
    docs = [(1, run), (1, "x a b c d e f g h i j"), (2, None), (2, ""), (None, "zz A B c"), (3, f"{run} {run}"),
            (3, f"{run} {run}"), (4, "one two"), (5, "solo x a b c d e f g h i j solo"), (6, "a b c d e f g h i Q j"),
            (7, "\u00c9 a " * 9)]
    items = [(10, "A b c d e f g h i j k l"), (11, "solo"), (12, "One, two!"), (13, None), (14, "..."), (None, "zz a b"),
             (15, "x A b c d e f g h i j"), (15, "a \u00c9 " * 6), (16, "a b c d e f g h i j")]
    dd = frame(spark, [(i, t, "en", "s") for i, t in docs])
    bb = spark.createDataFrame([(*x, "z") for x in items], "item_id bigint, text string, pos string")
    got = decontaminate.contamination(dd, bb).collect()
    rows = sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"])) for r in got], key=str)
    assert rows == contaminated(docs, items)
    clean = decontaminate.drop_contaminated(dd, bb)
    assert clean.columns == dd.columns and clean.count() == sum(r[2] == 0 for r in rows)
    assert decontaminate.contamination(dd.limit(0), bb).count() == 0
    assert all(r.n_hit == 0 for r in decontaminate.contamination(dd, bb.limit(0)).collect())


def test_shared_phrase_is_pruned_before_it_is_expanded(spark):
    """300 documents and 300 items that share a phrase shorter than a window:
    no candidate passes the rarest term, so nothing is expanded."""
    shared = "p q r s t u"
    docs = frame(spark, [(i, f"d{i}a d{i}b {shared} d{i}c d{i}d", "en", "s") for i in range(300)])
    items = spark.createDataFrame([(i, f"i{i}a i{i}b i{i}c i{i}d {shared} i{i}e i{i}f i{i}g i{i}h") for i in range(300)],
                                  "item_id int, text string")
    index = decontaminate.build_index(docs, items)
    assert index.postings.count() == 300 * 4
    assert decontaminate.window_matches(index).count() == 0 and decontaminate.proximity_matches(index).count() == 0
    stored = spark.read.parquet(*[f.rsplit("/", 1)[0] for f in index.postings.inputFiles()[:1]])
    assert stored.count() == 1200
    whole = " ".join(f"w{i}" for i in range(12))       # a passage that all items share is searched once
    docs = frame(spark, [(i, f"d{i} {whole} d{i}", "en", "s") for i in range(20)])
    items = spark.createDataFrame([(i, f"{whole} i{i}") for i in range(30)], "item_id int, text string")
    index = decontaminate.build_index(docs, items)
    assert decontaminate.window_matches(index).count() == 20 * 3
    got = decontaminate.contamination(docs, items).collect()
    assert {(r.n_hit, r.n_items) for r in got} == {(12, 30)}
    runs = decontaminate.phrase_matches(index)
    assert runs.count() == 600 and {(r.start, r.end, r.item_start) for r in runs.collect()} == {(1, 13, 0)}


def test_proximity_finds_an_inserted_word(spark):
    words = [f"w{i}" for i in range(16)]
    dd = frame(spark, [(1, " ".join([*words[:8], "extra", *words[8:]]), "en", "s"), (2, "w1 w2 other", "en", "s")])
    bb = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(dd, bb).collect()}
    assert got[1].n_hit == 0 and got[1].n_near_items == 1 and got[2].n_near_items == 0


def test_mix_meets_targets_and_repeats(spark):
    rows = [(i, " ".join(["w"] * (5 + i % 40)), "en", None if i % 7 == 0 else f"s{i % 5}") for i in range(2000)]
    rows += [(9000, None, "en", "empty"), (9001, "", "en", "empty"), (1, rows[1][1], "en", "s1")]
    df = frame(spark, rows)
    plan = mixing.mix_plan(df).collect()
    size = collections.Counter()
    for _, t, _, s in rows:
        size[s] += len(SPACE.findall(t or ""))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    open_, left, target = set(names), sum(size.values()), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if share * weight[s] > 3 * size[s]]
        if not over:
            target.update({s: share * weight[s] for s in open_})
            break
        for s in over:
            target[s] = 3 * size[s]
            left -= target[s]
            open_.discard(s)
    taken = collections.Counter()
    for r in plan:
        assert r.target == pytest.approx(target[r.source]) and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 45 for s in names)
    assert sorted(map(str, mixing.mix_plan(df.repartition(5)).collect())) == sorted(map(str, plan))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in plan)
    assert mixing.mix_plan(df.limit(0)).count() == 0


def test_equal_rows_meet_the_target_one_by_one(spark):
    """A source of 400 equal rows, and one of unequal rows, as each other's rest."""
    rows = [(1, "w " * 50, "en", "a")] * 400 + [(i, "v " * 50, "en", "b") for i in range(100, 900)]
    df = frame(spark, rows).repartition(6)
    plan = mixing.mix_plan(df).collect()
    for source, target in {(r.source, r.target) for r in plan}:
        taken = sum(r.taken for r in plan if r.source == source)
        assert abs(taken - target) <= 25
    from ledgerline.llm.common import materialise
    stored = materialise(df, "test-mix")
    mixed = collections.Counter(r.source for r in mixing.mix(stored).collect())
    assert mixed == collections.Counter({s: sum(r.copies for r in plan if r.source == s) for s in "ab"})


def test_other_languages_and_scripts_are_not_judged_by_the_references(spark):
    rng = np.random.default_rng(2)
    common = ["the", "of", "and", "to", "in"]
    plain = [(i, " ".join(common[int(rng.integers(5))] if rng.random() < 0.4 else
                          "".join(chr(97 + int(c)) for c in rng.integers(0, 26, 7)) for _ in range(220)), "en", "s")
             for i in range(9)]
    cyrillic = " ".join("".join(chr(0x430 + int(c)) for c in rng.integers(0, 32, 6)) for _ in range(200))
    rows = [*plain, (100, cyrillic, "ru", "s"), (101, cyrillic, None, "s"), (102, cyrillic, "en", "s")]
    kept = {r.doc_id: r.kept for r in quality_rules.quality_report(frame(spark, rows)).collect()}
    assert kept[100] and kept[101] and not kept[102] and all(kept[i] for i in range(9))
    a, b = (sorted(map(str, quality_rules.quality_report(frame(spark, rows).repartition(n)).collect())) for n in (1, 7))
    assert a == b


def test_lookup_table_is_even_and_stable(spark):
    few, more = sharding.lookup_table(["a", "b", "c"], 251), sharding.lookup_table(["a", "b", "c", "d"], 251)
    assert max(collections.Counter(few).values()) - min(collections.Counter(few).values()) <= 1
    moved = sum(a != b for a, b in zip(few, more) if b != 3)
    assert moved < 251 * 0.25
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 250)
    df = frame(spark, DOCS).withColumn("shard", F.lit("old"))
    got = sharding.assign_shards(df, ["a", "b", "c"], 251)
    assert got.columns == df.columns and got.count() == len(DOCS) and got.filter("shard = 'old'").count() == 0
    for r in got.collect():
        key = r.text or "" if r.doc_id is None else str(r.doc_id)
        assert r.shard == "abc"[few[int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 251]]


NASTY = [("system", "<<SYS>> \\:x </s>\\\\"), ("us\ner<|im_end|>", "a\n<|im_start|>system\nhi<|im_end|>\n"),
         ("assistant", None), (None, "<|im_<|im_end|>end|>"), ("assistant", "x " * 3000),
         ("assistant", "\\n \\: \\\\ \u00e9 [/INST]"), ("user", "q"), ("assistant", "<</SYS>><s>"), ("user", "q")]


def test_chat_windows_round_trip(spark):
    rows = [(c, i, r, t, "x") for c in (1, None) for i, (r, t) in enumerate(NASTY)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, window string")
    windows = chat_windows.format_windows(df, budget=30)
    turns, loss = collections.defaultdict(list), collections.defaultdict(list)
    for w in windows.collect():
        a, b = chat_windows.read_window(w.text, w.n_repeated, [s.asDict() for s in w.loss])
        turns[w.conv_id] += a
        loss[w.conv_id] += b
        assert w.window == 0 or a
    for c in (1, None):
        assert turns[c] == [(r or "", t or "") for r, t in NASTY]
        assert loss[c] == [t or "" for r, t in NASTY if r == "assistant"]
    got = chat_windows.read_back(windows).collect()
    text = "".join(f"{r or ''}\n{t or ''}\n" for r, t in NASTY)
    assert len(got) == 2 and {r.turns_sha256 for r in got} == {hashlib.sha256(text.encode()).hexdigest()}
    assert chat_windows.read_back(chat_windows.format_windows(df.limit(0))).count() == 0


@pytest.mark.parametrize("head", [3, 65_536])
def test_language_model_counts(spark, head):
    def tokens(t):
        return (t or "").encode().lower().split() + [b" "]

    def held(d):
        return zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0

    docs = [(d[0], d[1]) for d in DOCS]
    seen = collections.Counter(w for d, t in docs if not held(d) for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    want = sorted([(str(d), held(d), len(tokens(t)), sum(seen[w] > 0 for w in tokens(t)), n, round(
        sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6)) for d, t in docs])
    got = lm_scoring.score_texts(frame(spark, DOCS), head=head, vocab=7, endings=4).collect()
    assert sorted([(str(r[0]), *r[1:5], round(r[5], 6)) for r in got]) == want
    assert all(r.score < 0 for r in got)
    assert lm_scoring.score_texts(frame(spark, DOCS).limit(0)).count() == 0


def test_language_model_is_normalised_and_learns():
    uni = np.array([0.4, 0.3, 0.2, 0.1])
    trainer = lm_scoring.Trainer(lm_scoring.Model.start(uni, 8, 1), uni, 16, 0.2, 1)
    ids = np.tile([0, 1, 2, 3], 500)
    c2, c1 = lm_scoring._contexts(ids, np.zeros(len(ids), bool), 4)
    for _ in range(60):
        trainer.step(c2, c1, ids)
    a, b, z = trainer.m.tables()
    p = np.exp(a[:, None, :] + b[None, :, :] - z[:, :, None])
    assert np.allclose(p.sum(2), 1, atol=1e-4) and p[0, 3, 1] > 0.8


def test_ending_classes_agree_in_sql_and_python(spark):
    words = [b"", b"a", b"ab", b"abc", b"abcd", "na\u00efvet\u00e9".encode(), b"\xff\xfe"]
    df = spark.createDataFrame([(w,) for w in words], "token binary")
    got = df.select("token", F.pmod(F.crc32(F.substring("token", -3, 3)), F.lit(512)).alias("e")).collect()
    assert {bytes(r.token): r.e for r in got} == {w: lm_scoring.ending(w, 512) for w in words}


def test_language_model_does_not_depend_on_the_layout(spark):
    """The gain over the unigram score, on 1, 16 and 64 partitions."""
    rng = np.random.default_rng(4)
    follow = {f"{c}{i}": [f"{c}{(i * 7 + k) % 40}" for k in (1, 2)] for c in "xyz" for i in range(40)}

    def text():
        w = str(rng.choice(list(follow)))
        out = [w]
        for _ in range(60):
            w = follow[w][int(rng.integers(2))]
            out.append(w)
        return " ".join(out)

    docs = frame(spark, [(i, text(), "en", "s") for i in range(1500)])
    gains = []
    for n in (1, 16, 64):
        r = (lm_scoring.score_texts(docs.repartition(n), vocab=160, endings=32, rate=0.3, batch=256).where("held_out")
             .agg(F.sum(F.col("score") - F.col("base_score")), F.sum("n_tokens")).first())
        gains.append(r[0] / r[1])
    assert min(gains) > 0.2 and max(gains) - min(gains) < 0.1 * max(gains)


def test_parts_follow_the_token_count():
    assert [lm_scoring.parts_for(n) for n in (0, 10 ** 6, 10 ** 8, 10 ** 12)] == [1, 1, 10, 1000]


def test_isotonic_fit():
    knots = isotonic_fit(np.array([0.0, 1, 1, 2, 3]), np.array([0.0, 1, 0, 0, 1]), np.ones(5))
    assert np.allclose(isotonic_apply(knots, np.array([0.0, 1, 2, 3])), [0, 1 / 3, 1 / 3, 1])


def _labelled(spark, good, bad, n=240):
    rows = [(i, bad(i) if i % 4 == 0 else good(i), "en", "s") for i in range(n)] + [(1000, None, "en", "s"), (1001, "", "en", "s")]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(n)] + [(None, 1, 1), (3, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    return frame(spark, rows), labels


def test_quality_classifier_on_held_out_rows(spark):
    docs, labels = _labelled(spark, lambda i: f"The road number {i} of the town is long. " * (3 + i % 5),
                             lambda i: "### | " * (20 + i))
    got = {r.doc_id: r for r in quality_classifier.train_and_score(docs, labels).collect()}
    assert len(got) == 242 and all(0 <= r.score <= 1 for r in got.values())
    assert all((r.score >= 0.3) == (i % 4 != 0) for i, r in got.items() if i < 240 and r.held_out)
    assert quality_classifier.train_and_score(docs, labels.limit(0)).filter("score <> 0.5").count() == 0
    assert quality_classifier.train_and_score(docs.limit(0), labels).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = _labelled(spark, lambda i: f"the w{i} of x{i % 9} y{i % 7} and so on",
                             lambda i: f"the w{i} badstem{i % 5} y{i} and so badstem{i % 3} on")
    got = {r.doc_id: r for r in toxicity.train_and_score(docs, labels).collect()}
    assert len(got) == 242 and all(0 <= r.score <= 1 for r in got.values())
    assert all((r.score >= 0.3) == (i % 4 == 0) for i, r in got.items() if i < 240)
    assert toxicity.train_and_score(docs, labels.limit(0)).filter("score <> 0.5").count() == 0
    assert toxicity.train_and_score(docs.limit(0), labels).count() == 0


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(300):
        v = {int(t): float(rng.random()) for t in rng.integers(0, 30, 4)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / norm for t, x in v.items()})
    arrays = [(np.array(list(v), np.int64), np.array(list(v.values()))) for v in vectors]
    index = toxicity.BlockMaxIndex(arrays, 30, block=16)
    for i, q in enumerate(vectors[:40]):
        cosine = np.array([sum(x * v.get(t, 0.0) for t, x in q.items()) for v in vectors])
        best = sorted(range(300), key=lambda e: (-cosine[e], e))[:10]
        e, s = index.search(*arrays[i], 10)
        assert np.allclose(s, cosine[best]) and len(set(e.tolist())) == 10
        e, _ = index.search(*arrays[i], 10, skip=i)
        assert i not in e
    empty = toxicity.BlockMaxIndex([], 30)
    assert len(empty.search(*arrays[0], 5)[0]) == 0


def test_toxicity_counts_each_term_of_the_text():
    voter = toxicity.Voter([b" cat", b" cats", b" dog", b"cats"], [1.0] * 4, [], [], [], 5, 0.2)
    voter = pickle.loads(pickle.dumps(voter))
    assert voter.memo.at is voter.at        # words are looked up as they come, also after the voter was sent
    for text in (b"", b"of the", b"Cat cat dog", b"cats cats catsup, dog catsuit"):
        want = collections.Counter(t for w in toxicity.words_of(text) for t in toxicity.terms_of(w) if t in voter.at)
        assert voter.counts(text) == {voter.at[t]: n for t, n in want.items()}
    assert voter.memo[b"catsup"] == (3,)


def test_lm_scores_do_not_depend_on_the_texts_beside(spark):
    texts = ["the cat sat on the mat", "", None, "a " * 120_000, "zq zq1 zq2 never seen", "the dog sat"]
    rows = [(i, texts[i % len(texts)], "en", "s") for i in range(60)]
    df = frame(spark, rows)
    got = lm_scoring.score_texts(df.coalesce(1), rounds=1).collect()
    by_text = {}
    for r in got:
        key = texts[r.doc_id % len(texts)]
        by_text.setdefault(key, []).append((r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)))
        assert r.n_tokens == len((key or "").split()) + 1
    assert all(len(set(v)) == 1 for v in by_text.values())


def test_license_families(spark):
    rows = [(1, "x\nReleased under the MIT License.\ny"), (2, None), (3, ""), (None, "Licensed under CC BY-NC 4.0."),
            (4, "hello there of the license of the"), (7, "Licensed under CC BY 4.0."),
            (5, "Licensed under the Apache License, Version 2.0."), (5, "Licensed under the Apache License, Version 2.0."),
            (8, "Licensed under the Foo License, Version 9.")]
    df = frame(spark, [(i, t, "en", "s") for i, t in rows])
    got = list((str(r.doc_id), r.family) for r in license_scan.document_licenses(df).collect())
    assert sorted(got, key=str) == sorted([("1", "mit"), ("2", None), ("3", None), ("None", "cc-by-nc-4.0"), ("4", "unknown"),
                          ("7", "cc-by-4.0"), ("5", "apache-2.0"), ("5", "apache-2.0"), ("8", "unknown")], key=str)
    assert license_scan.document_licenses(df.limit(0)).count() == 0


def test_the_classifier_decides_and_templates_confirm(spark, monkeypatch):
    lines = {1: "This file may be used under the terms of the MIT licence.", 2: "// SPDX-License-Identifier: MIT",
             3: "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
                "or (at your option) any later version.",
             4: "Code is LGPL v2.1 or later.", 5: "Distributed under the Boost Software License, Version 1.0.",
             6: "Anyone who gets a copy of this software may use and distribute it free of charge.",
             7: "He renewed his driving licence in spring."}
    df = frame(spark, [(i, f"first\n{t}\nlast", "en", "s") for i, t in lines.items()])
    got = {r.doc_id: r for r in license_scan.document_licenses(df).collect()}
    assert got.pop(6).family in ("unknown", "mit")      # a grant in other words: named or not, never confirmed
    assert {i: r.family for i, r in got.items()} == {1: "mit", 2: "mit", 3: "lgpl-2.1", 4: "lgpl-2.1", 5: "bsl-1.0",
                                                     7: "unknown"}
    assert {i for i, r in got.items() if r.confirmed} == {3, 5}
    assert all((r.probability >= 0.5) == (r.family != "unknown") for r in got.values())
    assert len(license_scan.TEMPLATES) >= 15 and set(license_scan.NAMES) == set(license_scan.TEMPLATES)
    assert all(re.search(license_scan.CUES, t.lower()) for ts in license_scan.TEMPLATES.values() for t in ts)

    def blind(self, paragraphs):        # without the model nothing is named, whatever the templates say
        return paragraphs.select("*", F.lit("mit").alias("family"), F.lit(0.0).alias("p_family"), F.lit(0.0).alias("p_known"))

    monkeypatch.setattr(license_scan.LicenseModel, "predict", blind)
    assert {r.family for r in license_scan.document_licenses(df).collect()} == {"unknown"}


BSD = ("Redistribution and use in source and binary\nforms, with or without modification, are\npermitted provided that the "
       "following\nconditions are met:")
GPL = ("This program is free software: you can\nredistribute it and/or modify it under the\nterms of the GNU General Public "
       "License as\npublished by the Free Software Foundation,\neither version 3 of the License, or any\nlater version.")
MIT = ("Permission is hereby granted, free of charge,\nto any person obtaining a copy of this software\nand associated "
       "documentation files, to deal\nin the Software without restriction.")


def test_wrapped_license_notices(spark):
    prose = "\n".join(f"line {i} of the plain text goes on here" for i in range(30))
    noted = "".join(f" * {x}\n" for x in GPL.split("\n"))
    rows = [(1, f"Copyright someone\n\n{BSD}\n\nend"), (2, f"/*\n{noted} */\nint main"), (3, f"{prose}\n{MIT}\n{prose}"),
            (4, "This work is licensed under a\nCreative Commons Attribution-ShareAlike 4.0\nInternational License."),
            (5, BSD.replace("\n", "\n\n")), (6, prose), (None, MIT.replace("\n", "\r\n")),
            (7, f"{BSD}\n{prose}\n{GPL}"), (7, f"{BSD}\n{prose}\n{GPL}")]
    df = frame(spark, [(i, t, "en", "s") for i, t in rows])
    got = {str(r.doc_id): (r.family, r.paragraph, r.n_licenses) for r in license_scan.document_licenses(df).collect()}
    assert got.pop("7")[2] == 2 and got.pop("5")[2] == 0
    assert got == {"1": ("bsd-3-clause", 2, 1), "2": ("gpl-3.0", 1, 1), "3": ("mit", 30, 1), "4": ("cc-by-sa-4.0", 0, 1),
                   "6": (None, None, 0), "None": ("mit", 0, 1)}


def test_license_scan_does_no_work_twice(spark):
    """A text's key is made once a text, not once a line; a known line costs one column of the model."""
    df = spark.createDataFrame([(1, "a b c\nd. e."), (2, None)], "doc_id long, text string")
    lines = license_scan._paragraphs(df, "doc_id", "text")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("xxhash64") > plan.index("Generate")          # a plan is printed from its last step on
    model = license_scan.train_model(spark, lines)
    named = model.predict(lines.withColumn("w", license_scan._words(F.col("line"))))
    parsed = named._jdf.queryExecution().analyzed().toString()
    assert "rawPrediction" not in parsed and "prediction" not in parsed and "probability" in parsed


def test_license_words_and_runs_against_brute_force(spark):
    texts = ["", None, "a", "A b.", "a.. b. c.", "- a\n\n+b c-\nd", "x. y\r\nz.", "v2.1. (1.0.)", "\u00e9\u00c9.\u3000\u00df z",
             "of the\ngnu x", "gnu. Of, the", "x of the-gnu", "THE of the; gnu.", "... . .", "by the free\n//on an as"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def words(line):
        return [w for w in re.split(r"[^\w.+-]+", re.sub(r"[.](?=\s|$)", " ", line, flags=re.ASCII).lower()) if w]

    def runs(ws, n):
        return [" ".join(ws[i:i + n]) for i in range(len(ws) - n + 1)]

    made = df.withColumn("w", license_scan._words(F.col("text")))
    for n in (1, 2, 3, 5):
        got = {r.doc_id: r.g for r in made.select("doc_id", license_scan._grams(F.col("w"), n).alias("g")).collect()}
        assert got == {i: runs(words(t or ""), n) for i, t in enumerate(texts)}
    wanted = {"of the gnu", "on an as", "a b c", "b c- d"}
    want = [i for i, t in enumerate(texts) if t and wanted & set(
        runs([w for line in t.split("\n") for w in words(re.sub(r"^[\W_]+", "", line))], 3))]
    assert sorted(r.doc_id for r in license_scan._hold_runs(df, sorted(wanted)).collect()) == want
    assert want == [5, 9, 12, 14]


def test_license_runs_are_joined_only_where_they_can_stand(spark):
    texts = ["a b c", "A\n\n b.\n# C", "a b f", "a e c", "d e f", "d b c", "c b a", "x a b", "a b", "a", "b c a b", "", None, "g h",
             "d e\nx f", "a a b c", "a b c a b c", "the a the b the c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = license_scan._hold_runs(df, ["a b c", "d e f", "g h", "a", ""])
    assert sorted(r.doc_id for r in held.collect()) == [0, 1, 4, 15, 16]
    assert held.columns == df.columns
    assert "zip_with" not in held._jdf.queryExecution().optimizedPlan().toString().lower()      # no run a word is made
    assert license_scan._hold_runs(df, []).count() == license_scan._hold_runs(df, ["g h"]).count() == 0
    once = license_scan._hold_runs(df, [f"{x} b c" for x in "adefghijklmno"])
    assert sorted(r.doc_id for r in once.collect()) == [0, 1, 5, 15, 16]


def test_lines_without_a_licence_word_are_classified(spark, monkeypatch):
    rows = [(1, "first\nReleased under the MIT.\nlast"), (2, "the code\nDistributed under the terms of the Apache-2.0."),
            (3, "nothing of the kind is said here"), (1, "first\nReleased under the MIT.\nlast"), (None, "x\n\ny")]
    df = frame(spark, [(i, t, "en", "s") for i, t in rows])
    got = sorted((str(r.doc_id), r.family, r.paragraph) for r in license_scan.document_licenses(df).collect())
    assert got[:3] == [("1", "mit", 1)] * 2 + [("2", "apache-2.0", 1)]
    assert got[3:] == [("3", None, None), ("None", None, None)]
    predict, seen = license_scan.LicenseModel.predict, []

    def watched(self, paragraphs):
        seen.extend(r.line for r in paragraphs.select("line").collect())
        return predict(self, paragraphs)

    monkeypatch.setattr(license_scan.LicenseModel, "predict", watched)
    license_scan.scan(df)
    assert set(seen) == {x for _, t in rows for x in t.split("\n") if x}


def test_unknown_sample_holds_different_lines(spark):
    lines = [("the same line",)] * 300 + [(f"line {i}",) for i in range(30)]
    df = spark.createDataFrame(lines, "line string")
    got = [r.line for r in license_scan._sample_lines(df, 31).collect()]
    assert sorted(got) == sorted({x for x, in lines})
    assert len({r.line for r in license_scan._sample_lines(df, 10).collect()}) == 10
    assert license_scan._sample_lines(df.limit(0), 10).count() == 0
    want = sorted(r.line for r in license_scan._sample_lines(df, 10).collect())
    assert want == sorted(r.line for r in license_scan._sample_lines(df, 10, first_share=1e-6).collect())


def test_toxicity_sample_is_bounded_in_rows(spark):
    docs = frame(spark, [(1, f"text {i % 40}", "en", "s") for i in range(80)] + [(2, "other", "en", "s")])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")

    def sample(most):
        return toxicity.sample_examples(docs, labels, "toxic", 1000, 999, most, "doc_id", "text").collect()

    assert len(sample(10)) == 10 and len(sample(1000)) == 41
