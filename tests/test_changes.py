import contextlib
import datetime as dt
import glob
import io
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from ledgerline.operators import changes as ch

TARGET = T.StructType([T.StructField(c, t, True) for c, t in [
    ("id", T.StringType()), ("loan_status", T.StringType()), ("loan_amnt", T.DoubleType()),
    ("int_rate", T.DoubleType()), ("grade", T.StringType())]])
CHANGES = T.StructType([T.StructField(c, t, True) for c, t in [
    ("id", T.StringType()), ("old_status", T.StringType()), ("new_status", T.StringType()),
    ("loan_amnt", T.DoubleType()), ("int_rate", T.DoubleType())]])
SET = {"loan_status": "new_status", "loan_amnt": "loan_amnt", "int_rate": "int_rate"}


def _target(spark):
    return spark.createDataFrame([
        ("1", "Current", 100.0, 10.0, "A"), ("2", "Current", 200.0, 11.0, "B"),
        ("3", "Current", 300.0, 12.0, "C"), (None, "Current", 400.0, 13.0, "D")], TARGET)


def test_merge_update_semantics(spark):
    changes = spark.createDataFrame([
        ("1", "Current", "Charged Off", 150.0, 9.5),      # matching id
        ("9", "Current", "Default", 1.0, 1.0),            # not in target: ignored
        ("2", "Fully Paid", "Late (16-30 days)", 250.0, None),  # stale old status, NULL new rate
        (None, "Current", "Default", 5.0, 5.0),           # NULL id never matches
    ], CHANGES)
    out = {r.id: r for r in ch.merge_update(_target(spark), changes, "id", SET).collect()}
    assert len(out) == 4
    assert (out["1"].loan_status, out["1"].loan_amnt, out["1"].int_rate) == ("Charged Off", 150.0, 9.5)
    assert (out["2"].loan_status, out["2"].loan_amnt, out["2"].int_rate) == ("Late (16-30 days)", 250.0, None)
    assert (out["3"].loan_status, out["3"].loan_amnt) == ("Current", 300.0)
    assert (out[None].loan_status, out[None].loan_amnt) == ("Current", 400.0)
    assert out["1"].grade == "A"


def test_merge_refuses_duplicate_matches(spark):
    dup = spark.createDataFrame([("1", "Current", "Default", 1.0, 1.0), ("1", "Current", "Current", 2.0, 2.0)], CHANGES)
    with pytest.raises(PySparkException, match="merge refused"):
        ch.merge_update(_target(spark), dup, "id", SET).collect()
    # repeated key that is not in the target is harmless
    dup_unmatched = spark.createDataFrame([("8", "a", "b", 1.0, 1.0), ("8", "a", "c", 2.0, 2.0)], CHANGES)
    assert ch.merge_update(_target(spark), dup_unmatched, "id", SET).count() == 4


def test_merge_without_broadcast(spark):
    changes = spark.createDataFrame([("3", "Current", "Default", 1.0, 2.0)], CHANGES).hint("merge")
    out = ch.merge_update(_target(spark), changes, "id", SET)
    assert out.filter("id = '3'").first().loan_status == "Default"


AT = dt.datetime(2026, 6, 20, 12, 0, 0)
NUMBERED = "id bigint, loan_status string, loan_amnt double, grade string"
FEED = "id bigint, new_status string, loan_amnt double"
FEED_SET = {"loan_status": "new_status", "loan_amnt": "loan_amnt"}
PART_BY = "id div 10"


def _numbered(spark, n=40):
    rows = [(i, "Current", 100.0 + i, "AB"[i % 2]) for i in range(n)]
    return spark.createDataFrame([*rows, (None, "Current", 1.0, "A")], NUMBERED)


def _files(root):
    return {os.path.relpath(p, root) for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def _values(df):
    return {r.id: (r.loan_status, r.loan_amnt, r.grade) for r in df.collect()}


def test_merge_rewrites_only_the_partitions_it_touches(spark, tmp_dir):
    layer = f"{tmp_dir}/layer"
    assert ch.write_ranged(_numbered(spark), layer, PART_BY) == 41
    before = _files(layer)
    changes = spark.createDataFrame([(12, "Default", 1.0), (19, "Default", None), (35, "Late", 2.0), (99, "x", 0.0),
                                     (None, "x", 0.0)], FEED)
    ch.merge_ranged(spark, layer, changes, "id", FEED_SET, PART_BY)
    after = _files(layer)
    for part in ("key_part=0", "key_part=2", "key_part=__HIVE_DEFAULT_PARTITION__"):
        assert {f for f in before if f.startswith(part)} == {f for f in after if f.startswith(part)} != set()
    for part in ("key_part=1", "key_part=3"):
        assert not {f for f in before & after if f.startswith(part)}
    want = {i: ("Current", 100.0 + i, "AB"[i % 2]) for i in range(40)} | {None: ("Current", 1.0, "A")}
    want |= {12: ("Default", 1.0, "A"), 19: ("Default", None, "B"), 35: ("Late", 2.0, "B")}
    assert _values(ch.read_ranged(spark, layer)) == want
    assert ch.read_ranged(spark, layer).columns == ["id", "loan_status", "loan_amnt", "grade"]
    hits = ch.lookup_ranged(spark, layer, changes, "id", PART_BY)
    assert {r.id for r in hits.collect()} == {12, 19, 35}
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        hits.explain("formatted")
    assert "PartitionFilters: [key_part" in plan.getvalue()
    ch.merge_ranged(spark, layer, changes.limit(0), "id", FEED_SET, PART_BY)      # nothing to do
    assert _files(layer) == after


def _feed(spark, tmp_dir):
    layer, feed = f"{tmp_dir}/loans", f"{tmp_dir}/feed"
    assert ch.start_feed(spark, _numbered(spark), layer, PART_BY, feed, at=AT) == 41
    return layer, feed


def _apply(spark, layer, feed, name, rows):
    changes = spark.createDataFrame(rows, FEED)
    return ch.apply_change_set(spark, layer, feed, name, changes, "id", FEED_SET, PART_BY, at=AT)


def test_change_sets_history_log_images_and_replay(spark, tmp_dir):
    layer, feed = _feed(spark, tmp_dir)
    # the later set wins in a replay, though both carry one timestamp and its status sorts first
    assert _apply(spark, layer, feed, "b", [(1, "Late", 5.0), (2, "Late", 6.0), (77, "Late", 7.0)]) == 1
    assert _apply(spark, layer, feed, "a", [(1, "Default", 8.0)]) == 2
    history = [(h.seq, h.change_set, h.operation, h.num_rows, h.num_updated) for h in ch.feed_history(spark, feed).collect()]
    assert history == [(2, "a", "MERGE", 41, 1), (1, "b", "MERGE", 41, 2), (0, None, "WRITE", 41, None)]
    now = _values(ch.read_ranged(spark, layer))
    assert now[1] == ("Default", 8.0, "B") and now[2] == ("Late", 6.0, "A") and now[3] == ("Current", 103.0, "B")
    log = ch.visible_log(spark, feed)
    assert sorted((r.seq, r.change_set, r.id) for r in log.collect()) == [(1, "b", 1), (1, "b", 2), (1, "b", 77), (2, "a", 1)]
    assert {r.change_timestamp for r in log.collect()} == {AT}
    assert {(r.operation, r.source_system) for r in log.collect()} == {("UPDATE", "loan_servicing_feed")}
    assert _values(ch.replay_changes(_numbered(spark), log, "id", FEED_SET)) == now
    images = ch.visible_images(spark, feed).where("change_set = 'b'")
    keys = spark.createDataFrame([(1,), (2,), (77,)], "id bigint")
    sides = {r.id: r for r in ch.before_after(images.where("side = 'before'"), images.where("side = 'after'"), keys, "id",
                                              ["loan_status", "loan_amnt"]).collect()}
    assert set(sides) == {1, 2} and (sides[2].loan_status_before, sides[2].loan_status_after) == ("Current", "Late")
    assert (sides[1].loan_amnt_before, sides[1].loan_amnt_after) == (101.0, 5.0)
    with pytest.raises(ValueError):
        _apply(spark, layer, feed, "a/b", [(1, "x", 1.0)])


def test_a_crash_before_the_merge_shows_nothing_and_a_retry_logs_once(spark, tmp_dir, monkeypatch):
    layer, feed = _feed(spark, tmp_dir)
    _apply(spark, layer, feed, "first", [(1, "Late", 5.0)])
    real = ch.merge_ranged

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    rows = [(1, "Default", 8.0), (25, "Default", 9.0)]
    monkeypatch.setattr(ch, "merge_ranged", crash)
    with pytest.raises(RuntimeError):
        _apply(spark, layer, feed, "second", rows)
    assert {r.change_set for r in ch.visible_log(spark, feed).collect()} == {"first"}
    assert {r.change_set for r in ch.visible_images(spark, feed).collect()} == {"first"}
    replayed = _values(ch.replay_changes(_numbered(spark), ch.visible_log(spark, feed), "id", FEED_SET))
    assert replayed[1] == ("Late", 5.0, "B") and replayed[25] == ("Current", 125.0, "B")

    def half(spark_, path, changes, *args):       # one partition is merged, then the run is lost
        real(spark_, path, changes.where("id < 10"), *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(ch, "merge_ranged", half)
    with pytest.raises(RuntimeError):
        _apply(spark, layer, feed, "second", rows)
    monkeypatch.setattr(ch, "merge_ranged", real)
    assert _apply(spark, layer, feed, "second", rows) == 2
    assert _apply(spark, layer, feed, "second", rows) == 2          # applied: left alone
    assert sorted((r.change_set, r.id) for r in ch.visible_log(spark, feed).collect()) == [
        ("first", 1), ("second", 1), ("second", 25)]
    before = {(r.change_set, r.id): r.loan_amnt for r in ch.visible_images(spark, feed).where("side = 'before'").collect()}
    assert before == {("first", 1): 101.0, ("second", 1): 5.0, ("second", 25): 125.0}     # not those of the half merge
    assert _values(ch.read_ranged(spark, layer))[25] == ("Default", 9.0, "B")
    assert [h.seq for h in ch.feed_history(spark, feed).collect()] == [2, 1, 0]


def test_gold_refresh_equals_a_rebuild(spark, tmp_dir):
    keys = ["grade", "loan_status"]
    measures = [("n", "count", "*"), ("with_amt", "count", "loan_amnt"), ("avg_amt", "avg", "loan_amnt"),
                ("volume", "sum", "loan_amnt")]
    layer, feed = _feed(spark, tmp_dir)
    base = ch.group_sums(ch.read_ranged(spark, layer), keys, measures)
    base.write.parquet(f"{tmp_dir}/sums")
    base = spark.read.parquet(f"{tmp_dir}/sums")
    sets = [[(i, "Late", 0.1 * i) for i in range(0, 40, 3)], [(i, "Default", None) for i in range(0, 40, 6)],
            [(i, "Default", 7.77) for i in range(40)]]
    from ledgerline.operators.aggregate import summarise
    for n, rows in enumerate(sets):
        _apply(spark, layer, feed, f"s{n}", rows)
        deltas = ch.image_sums(ch.visible_images(spark, feed), keys, measures)
        got = {tuple(r) for r in ch.gold_refresh(base, deltas, keys, measures).collect()}
        want = {tuple(r) for r in summarise(ch.read_ranged(spark, layer), keys, measures).collect()}
        assert got == want
    assert {r[1] for r in got} == {"Default", "Current"} and len(got) == 3       # 'Late' lost its last row
    with pytest.raises(ValueError):
        ch.gold_refresh(base, base, keys, [("m", "max", "loan_amnt")])


def test_change_log_columns(spark):
    changes = spark.createDataFrame([("1", "Current", "Default", 1.0, 2.0)], CHANGES)
    log = ch.change_log(changes, changes.columns, dt.datetime(2026, 1, 1))
    assert log.columns == ["id", "old_status", "new_status", "loan_amnt", "int_rate", "operation",
                           "source_system", "change_timestamp"]
    assert dict(log.dtypes)["change_timestamp"] == "timestamp"


def test_replay_takes_latest_change_per_key(spark, tmp_dir):
    changes1 = spark.createDataFrame([("1", "Current", "Late (16-30 days)", 150.0, 9.5)], CHANGES)
    changes2 = spark.createDataFrame([("1", "Late (16-30 days)", "Charged Off", 140.0, 9.0),
                                      ("2", "Current", "Fully Paid", 200.0, 11.0)], CHANGES)
    ch.change_log(changes1, changes1.columns, dt.datetime(2026, 1, 1)).write.mode("append").parquet(f"{tmp_dir}/log")
    ch.change_log(changes2, changes2.columns, dt.datetime(2026, 2, 1)).write.mode("append").parquet(f"{tmp_dir}/log")
    log = spark.read.parquet(f"{tmp_dir}/log")
    latest = {r.id: r for r in ch.latest_changes(log, "id").collect()}
    assert latest["1"].new_status == "Charged Off" and latest["1"].change_timestamp == dt.datetime(2026, 2, 1)
    out = {r.id: r for r in ch.replay_changes(_target(spark), log, "id", SET).collect()}
    assert (out["1"].loan_status, out["1"].loan_amnt) == ("Charged Off", 140.0)
    assert out["2"].loan_status == "Fully Paid" and out["3"].loan_status == "Current"


def test_bucketed_target_is_not_shuffled(spark, tmp_dir):
    import uuid
    from pyspark.sql import functions as F
    name = f"loans_{uuid.uuid4().hex[:8]}"
    base = spark.range(0, 2000).select(F.col("id").cast("string").alias("id"), F.lit("Current").alias("loan_status"),
                                       F.col("id").cast("double").alias("loan_amnt"), F.lit(10.0).alias("int_rate"))
    base.repartition(4, "id").write.bucketBy(4, "id").option("path", f"{tmp_dir}/bucketed").saveAsTable(name)
    changes = spark.range(0, 2000, 3).select(F.col("id").cast("string").alias("id"), F.lit("Current").alias("old_status"),
                                             F.lit("Default").alias("new_status"), F.lit(1.0).alias("loan_amnt"),
                                             F.lit(2.0).alias("int_rate"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the shuffle join path
    try:
        merged = ch.merge_update(spark.table(name), changes, "id", SET)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            merged.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning(id") == 1      # only the change set moves
        assert merged.filter("loan_status = 'Default'").count() == 667 and merged.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP TABLE {name}")


def test_merge_with_a_hot_key_is_split_and_whole(spark):
    """One key holds a third of the target; the shuffle join is marked skewed
    by AQE and every row still comes back, updated once."""
    from pyspark.sql import functions as F
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 300000
        target = spark.range(0, n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
            F.concat(F.lit("Current-"), F.col("id").cast("string")).alias("loan_status"),
            F.col("id").cast("double").alias("loan_amnt"), F.lit(10.0).alias("int_rate"), F.lit("A").alias("grade"))
        changes = spark.createDataFrame([("hot", "Current", "Default", 2.0, 3.0), ("1", "Current", "Default", 2.0, 3.0)],
                                        CHANGES)
        merged = ch.merge_update(target, changes, "id", SET)
        rows = merged.collect()                    # executes this plan, so explain shows the final one
        assert len(rows) == n
        assert sum(r.loan_status == "Default" for r in rows) == n // 3 + 1
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            merged.explain()
        assert "isFinalPlan=true" in buf.getvalue() and "skew=true" in buf.getvalue()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_before_after_refuses_repeated_keys_and_long_layout(spark):
    from pyspark.sql import functions as F
    t = _target(spark)
    dup = t.unionByName(t.filter("id = '1'"))
    keys = spark.createDataFrame([("1",)], "id string")
    with pytest.raises(PySparkException, match="repeats"):
        ch.before_after(dup, t, keys, "id", ["loan_status"]).collect()
    long = ch.before_after(dup, t.withColumn("loan_status", F.lit("Default")), keys, "id", ["loan_status"],
                           layout="long").collect()
    assert sorted((r.snapshot, r.loan_status) for r in long) == [
        ("after", "Default"), ("before", "Current"), ("before", "Current")]
