"""Prepared targets (stored keys and prints, bucketed tables) and feeds that can be replayed."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators import prepared
from tessera.operators.merge import merge
from tessera.operators.replay import ORDER, replay
from tessera.operators.staged import written_once
from tessera.plans import entities, specs
from tessera.sources.tables import fixture
from tests.util import AS_OF, rows

RES = "PmsInstanceId string, PmsResourceId string, ResourceName string, UtcCreatedDate timestamp, UtcLastModifiedDate timestamp"
BATCH = "PmsInstanceId string, PmsResourceId string, ResourceName string"
OWN = ("PmsInstanceId", "PmsResourceId", "ResourceName", "UtcLastModifiedDate")


def _resource(spark, data):
    return spark.createDataFrame([(t, i, n, AS_OF, AS_OF) for t, i, n in data], RES)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _depth(line):
    return max(line.rfind("+- "), line.rfind(":- "))


TARGET = [("T", "1", "a"), ("T", "2", None), ("T", "3", "c"), ("T", "3 ", "z"), ("U", "1", "same"), (None, "1", "n"), ("T", "8", "kept")]
INCOMING = [("t", " 1", "new"), ("T", "2", None), ("T", "3", "c"), ("U", "1", "same"), ("U", "1", "same"), ("T", "9", "add"), (None, "1", "n"), ("T", None, "k")]


@pytest.mark.parametrize("mode", ["collapse", "null_safe"])
@pytest.mark.parametrize("bound", [100, 0])
def test_a_prepared_target_gives_the_same_results(spark, mode, bound):
    target, batch = _resource(spark, TARGET), spark.createDataFrame(INCOMING, BATCH)
    plain = entities.resource_upsert(target, batch, as_of=AS_OF, mode=mode, max_broadcast_rows=bound)
    ready = prepared.prepare(target, specs.RESOURCE, mode)
    for settle in (True, False):
        r = entities.resource_upsert(
            ready, batch, as_of=AS_OF, mode=mode, max_broadcast_rows=bound, stored_print=True, stored_keys=True, settle=settle
        )
        assert rows(r.snapshot, *target.columns) == rows(plain.snapshot, *target.columns)
        assert rows(r.delta) == rows(plain.delta)
        # what the new snapshot carries is what preparing it again gives
        again = prepared.prepare(r.snapshot.select(*target.columns), specs.RESOURCE, mode)
        assert rows(r.snapshot, *sorted(r.snapshot.columns)) == rows(again, *sorted(r.snapshot.columns))


def test_a_second_batch_on_the_carried_prints(spark):
    target = prepared.prepare(_resource(spark, TARGET[:3]), specs.RESOURCE)
    options = dict(as_of=AS_OF, stored_print=True, stored_keys=True)
    first = entities.resource_upsert(target, spark.createDataFrame([("T", "1", "x"), ("T", "5", "y")], BATCH), **options)
    same = entities.resource_upsert(first.snapshot, spark.createDataFrame([("T", "1", "x "), ("T", "5", "y")], BATCH), **options)
    assert same.delta.count() == 0
    more = entities.resource_upsert(first.snapshot, spark.createDataFrame([("T", "5", None)], BATCH), **options)
    assert rows(more.delta, "PmsResourceId", "ActionPerformed") == [("5", 2)]


def test_the_match_reads_keys_and_print_alone(spark, sf_dir):
    """The 71 operands are not computed on the target: the first phase reads three columns of it."""
    base = tempfile.mkdtemp(prefix="tessera-prep-")
    v = lambda n: fixture(spark, sf_dir, n)
    prepared.prepare(v("patient_wide"), specs.PATIENT).write.parquet(os.path.join(base, "patient"))
    target = spark.read.parquet(os.path.join(base, "patient"))
    staged = entities.stage_patient(v("patient_wide_in"), v("location"), v("provider"), v("insurer"))
    staged = staged.unionByName(staged.limit(0))
    stored = target.select(*prepared.match_keys(specs.PATIENT, None, stored=True), prepared.PRINT)
    scan = next(x for x in _plan(stored).split("\n") if "FileScan" in x)
    assert scan.split("ReadSchema: ")[1].count(":") == 3 and "concat" not in _plan(stored)
    options = dict(stored_print=True, stored_keys=True)
    plain = merge(v("patient_wide"), staged, specs.PATIENT, AS_OF)
    r = merge(target, staged, specs.PATIENT, AS_OF, **options)
    names = v("patient_wide").columns
    assert rows(r.snapshot, *names) == rows(plain.snapshot, *names) and rows(r.delta) == rows(plain.delta)
    # the rows of the whole table again: nothing is left of the batch, so nothing wide is read for it
    reduced = prepared.changed_rows(r.snapshot, staged, specs.PATIENT, "collapse", True, None, None, None)
    assert reduced.count() < staged.count()


def test_a_conflict_is_still_an_error(spark):
    target = prepared.prepare(_resource(spark, [("T", "1", "a")]), specs.RESOURCE)
    batch = spark.createDataFrame([("T", "1", "a"), ("T", "1", "b"), ("T", "1", "c")], BATCH)
    r = entities.resource_upsert(target, batch, as_of=AS_OF, stored_print=True, stored_keys=True)
    with pytest.raises(Exception, match="several source rows"):
        r.snapshot.collect()
    with pytest.raises(ValueError, match="compares exactly"):
        entities.resource_upsert(target, batch, as_of=AS_OF, stored_print=True, collation="UTF8_LCASE")


def test_a_bucketed_target_is_not_exchanged(spark):
    """A large batch joins bucket by bucket: no Exchange stands above a scan of the target."""
    base = tempfile.mkdtemp(prefix="tessera-bucketed-")
    data = [("T" if i % 2 else "U", str(i), f"r{i}") for i in range(400)]
    ready = prepared.prepare(_resource(spark, data), specs.RESOURCE)
    name = "tessera_bucketed_test"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prepared.write_bucketed(ready, f"{name}_writer", 8, os.path.join(base, "t"))
        target = prepared.open_bucketed(spark, name, os.path.join(base, "t"), ready, 8)
        batch = spark.createDataFrame([("t", str(i), "new") for i in range(1, 500, 3)], BATCH)
        plain = entities.resource_upsert(_resource(spark, data), batch, as_of=AS_OF)
        r = entities.resource_upsert(target, batch, as_of=AS_OF, max_broadcast_rows=0, stored_keys=True, split_hot_keys=False)
        assert rows(r.snapshot, *OWN) == rows(plain.snapshot, *OWN) and rows(r.delta) == rows(plain.delta)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for df in (r.snapshot, r.delta):
            lines = _plan(df).split("\n")
            scans = [n for n, x in enumerate(lines) if "FileScan parquet" in x and "MatchKey" in x]
            assert scans
            for n in scans:
                depth, above = _depth(lines[n]), []
                for x in reversed(lines[:n]):
                    if _depth(x) < depth:
                        above.append(x)
                        depth = _depth(x)
                assert not any("Exchange" in x for x in above), "\n".join(lines)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}_writer")


# ------------------------------------------------------------------ replay


def _step(state, batch, order):
    r = entities.resource_upsert(state, batch, as_of=AS_OF, settle=True, changed_columns=True)
    return written_once(r.snapshot, "state"), r.changes.withColumn(ORDER, F.lit(order))


def test_set_to_null_is_told_from_unchanged(spark):
    start = _resource(spark, [("T", "1", "a"), ("T", "2", "b"), ("T", "3 ", "c")])
    batches = [[("T", "1", None), ("T", "4", "d")], [("T", "2", "b"), ("T", "4", None)], [("T", "1", "back"), ("T", "3", "e")], [("T", "4", "end")]]
    state, feed, states = start, None, []
    for n, data in enumerate(batches):
        state, changes = _step(state, spark.createDataFrame(data, BATCH), n)
        states.append(rows(state))
        feed = changes if feed is None else feed.unionByName(changes)
    assert rows(feed.filter(f"{ORDER} = 0 AND ActionPerformed = 2"), "ResourceName", "ChangedColumns") == [(None, "00100")]
    for n, want in enumerate(states):  # every prefix of the feed gives the state of its day
        assert rows(replay(start, feed.filter(F.col(ORDER) <= n), specs.RESOURCE)) == want
    shuffled = feed.orderBy(F.desc(ORDER)).repartition(5)
    assert rows(replay(start, shuffled, specs.RESOURCE)) == states[-1]
    assert rows(replay(start, feed.limit(0), specs.RESOURCE)) == rows(start)


def test_rows_without_a_match_key_are_added_as_they_are(spark):
    start = _resource(spark, [("T", None, "a")])
    state, feed = _step(start, spark.createDataFrame([("T", None, "b"), ("T", None, "b"), (None, "1", "c")], BATCH), 0)
    assert rows(replay(start, feed, specs.RESOURCE)) == rows(state)
    assert state.count() == 4


def test_what_cannot_be_told_apart_is_an_error(spark):
    start = _resource(spark, [("T", "1", "a")])
    _, twice = _step(start, spark.createDataFrame([("T", "5", "a"), ("T", "5", "b")], BATCH), 0)
    with pytest.raises(Exception, match="several changes of one key"):
        replay(start, twice, specs.RESOURCE).collect()
    _, update = _step(start, spark.createDataFrame([("T", "1", "x")], BATCH), 0)
    with pytest.raises(Exception, match="not there"):
        replay(start.limit(0), update, specs.RESOURCE).collect()


def test_a_feed_is_folded_once(spark):
    """Stored and added rows read the folded feed; neither folds it again."""
    target = spark.createDataFrame([("T", "1", "a", AS_OF, AS_OF)], "PmsInstanceId string, PmsResourceId string, ResourceName string, UtcCreatedDate timestamp, UtcLastModifiedDate timestamp")
    batch = spark.createDataFrame([("T", "1", "b"), ("T", "2", "c")], "PmsInstanceId string, PmsResourceId string, ResourceName string")
    r = entities.resource_upsert(target, batch, as_of=AS_OF, settle=True, changed_columns=True)
    out = replay(target, r.changes.withColumn(ORDER, F.lit(0)), specs.RESOURCE)
    assert "max(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert rows(out) == rows(r.snapshot)
