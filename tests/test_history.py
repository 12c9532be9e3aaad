import random
from datetime import datetime, timedelta

import pytest
from conftest import RUN, by
from pyspark.sql import functions as F

from tallyworks.operators import scd2

SCHEMA = (
    "order_id string, note string, _valid_from timestamp, _valid_to timestamp, _is_current boolean, "
    "_updated_ts timestamp, _source_hash string"
)
OLD = datetime(2024, 1, 1)


def random_state(seed):
    """A target with history-only keys, null hashes and several current rows of a key; a unique batch."""
    rnd = random.Random(seed)
    target = []
    for i in range(rnd.randint(0, 25)):
        current = rnd.random() < 0.7
        target.append((f"k{rnd.randint(0, 12)}", f"t{i}", OLD, None if current else OLD + timedelta(days=1), current,
                       OLD, rnd.choice(["a", "b", "c", None])))
    staged = [(f"k{k}", f"s{k}", RUN, None, True, RUN, rnd.choice(["a", "b", "c"]))
              for k in range(16) if rnd.random() < 0.6]
    return target, staged


def expire_then_append(target, staged):
    """The same merge as two plain steps."""
    batch = {s[0]: s for s in staged}
    after = []
    for t in target:
        s = batch.get(t[0])
        if t[4] and s and t[6] is not None and s[6] is not None and t[6] != s[6]:
            t = (*t[:3], s[2], False, RUN, t[6])
        after.append(t)
    held = {t[0] for t in after if t[4]}
    return after + [s for s in staged if s[0] not in held]


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_merge_equals_expire_then_append(spark):
    """Forty random states side by side, their keys kept apart by a prefix."""
    t, s = [], []
    for seed in range(40):
        target, staged = random_state(seed)
        t += [(f"{seed}-{r[0]}", *r[1:]) for r in target]
        s += [(f"{seed}-{r[0]}", *r[1:]) for r in staged]
    target, staged = spark.createDataFrame(t, SCHEMA), spark.createDataFrame(s, SCHEMA)
    want = sorted(map(repr, expire_then_append(t, s)))
    assert rows(scd2.merge(target, staged, RUN)) == want
    changes = scd2.effective_changes(target, staged)
    assert changes.count() < staged.count()
    assert rows(scd2.merge(target, changes, RUN)) == want


def test_repeated_keys_in_the_batch_fail(spark):
    _, s = random_state(1)
    target, staged = spark.createDataFrame([], SCHEMA), spark.createDataFrame([*s, s[0]], SCHEMA)
    with pytest.raises(Exception, match="staged keys are not unique"):
        scd2.merge(target, staged, RUN).collect()


def test_null_keys_never_match(spark):
    row = (None, "x", OLD, None, True, OLD, "a")
    target, staged = spark.createDataFrame([row], SCHEMA), spark.createDataFrame([(*row[:6], "b")], SCHEMA)
    assert scd2.merge(target, staged, RUN).where("_is_current").count() == 2


def test_the_same_batch_again_changes_nothing_and_intervals_do_not_overlap(spark):
    _, s = random_state(3)
    first = spark.createDataFrame(s, SCHEMA)
    later = first.withColumns({"_source_hash": F.concat("_source_hash", F.lit("!")),
                               "_valid_from": scd2.utc_literal(RUN + timedelta(days=1))})
    one = scd2.merge(first.limit(0), first, RUN)
    two = scd2.merge(one, later, RUN + timedelta(days=1))
    assert rows(scd2.merge(two, later, RUN + timedelta(days=2))) == rows(two)
    assert two.where("_is_current").groupBy("order_id").count().where("count > 1").count() == 0
    both = two.alias("a").join(two.alias("b"), "order_id").where("a._valid_from < b._valid_from")
    assert both.count() == len(s)
    assert both.where("a._valid_to IS NULL OR a._valid_to > b._valid_from").count() == 0


def test_change_feed_replays_to_the_next_snapshot(spark):
    t, s = random_state(5)
    target, staged = spark.createDataFrame(t, SCHEMA), spark.createDataFrame(s, SCHEMA)
    feed = scd2.change_feed(scd2.classify(target, staged), RUN)
    plus = feed.where("_change_type IN ('insert', 'update_postimage')").select(*target.columns)
    minus = feed.where("_change_type = 'update_preimage'").select(*target.columns)
    assert rows(target.exceptAll(minus).unionByName(plus)) == rows(scd2.merge(target, staged, RUN))


def test_point_in_time_reads(spark):
    df = spark.createDataFrame(
        [("k", "one", OLD, RUN, False, RUN, "a"), ("k", "two", RUN, None, True, RUN, "b")], SCHEMA
    )
    assert [r.note for r in scd2.as_of(df, RUN - timedelta(seconds=1)).collect()] == ["one"]
    assert [r.note for r in scd2.as_of(df, RUN).collect()] == ["two"]
    assert scd2.as_of(df, OLD - timedelta(days=1)).count() == 0
    asked = spark.createDataFrame([("k", OLD), ("k", RUN), ("z", RUN)], "order_id string, at timestamp")
    got = scd2.as_of_join(asked, df, ["order_id"], "at").select("order_id", "at", "note").collect()
    assert sorted((r.order_id, r.at, r.note or "") for r in got) == [("k", OLD, "one"), ("k", RUN, "two"), ("z", RUN, "")]
    assert scd2.current_count(df).collect()[0].active_rows == 1


def test_stage_marks_rows(spark, raw):
    row = by(scd2.stage(raw, RUN))["A2"]
    assert (row._valid_from, row._valid_to, row._is_current, row._updated_ts) == (RUN, None, True, RUN)
    assert len(row._source_hash) == 32
