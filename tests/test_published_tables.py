"""Published tables at size: many partitions, many commits, several tables, several writers, retention, feeds."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.plans import entities
from tessera.sources import sinks
from tessera.sources.sinks import create_snapshot, latest_commit, publish, publish_purge, read_delta, read_feed, read_snapshot, sweep
from tessera.sources.tables import fixture
from tessera.streaming.microbatch import start_feed_stream, start_patient_stream, start_upsert_stream, upsert_batch
from tests.util import AS_OF, rows

RESOURCE = "PmsInstanceId string, PmsResourceId string, ResourceName string, UtcCreatedDate timestamp, UtcLastModifiedDate timestamp"
BATCH = "PmsInstanceId string, PmsResourceId string, ResourceName string"


def _merge(target, batch, clock):
    return entities.resource_upsert(target, batch, as_of=AS_OF, settle=True)


def _paths(*names):
    base = tempfile.mkdtemp(prefix="tessera-tables-")
    return [os.path.join(base, n) for n in names]


def _resource(spark, data):
    return spark.createDataFrame([(t, i, n, AS_OF, AS_OF) for t, i, n in data], RESOURCE)


def _batch(spark, data):
    return spark.createDataFrame(data, BATCH)


def _files(path, suffix=".parquet"):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(suffix)]


def test_1500_tenants_read_publish_and_purge(spark):
    snap, delta = _paths("snap", "delta")
    tenants = spark.range(1500).select(
        F.concat(F.lit("tenant-"), "id").alias("PmsInstanceId"), F.lit("1").alias("PmsResourceId"), F.lit("a").alias("ResourceName"),
        F.lit(AS_OF).alias("UtcCreatedDate"), F.lit(AS_OF).alias("UtcLastModifiedDate"),
    )
    create_snapshot(spark, tenants, snap)
    assert read_snapshot(spark, snap).count() == 1500
    assert len(_files(f"{snap}/data")) == 1500  # one file a partition
    batch = tenants.filter("PmsInstanceId < 'tenant-2'").select(F.upper("PmsInstanceId").alias("PmsInstanceId"), "PmsResourceId", F.lit("b").alias("ResourceName"))
    touched = batch.count()
    assert 400 < touched < 1500
    assert upsert_batch(spark, batch, 0, _merge, snap, delta)
    now = read_snapshot(spark, snap)
    assert now.count() == 1500 and now.filter("ResourceName = 'b'").count() == touched
    assert publish_purge(spark, snap, "Tenant-7", 0)
    assert read_snapshot(spark, snap).filter("PmsInstanceId = 'tenant-7'").count() == 0
    assert read_snapshot(spark, snap).count() == 1499


def test_the_partition_filter_is_flat(spark):
    """One set test, however many partitions: no tree of ORs that grows with them."""
    (snap,) = _paths("snap")
    create_snapshot(spark, _resource(spark, [(f"t{i}", "1", "a") for i in range(40)]), snap)
    plan = read_snapshot(spark, snap)._jdf.queryExecution().optimizedPlan().toString()
    assert " OR " not in plan and "INSET" in plan


def test_quotes_and_slashes_in_tenant_names(spark):
    snap, delta = _paths("snap", "delta")
    names = ["a'b", "a/b", "a\\b", "a=b", "a b%", "é", "t_", "null"]
    create_snapshot(spark, _resource(spark, [(n, "1", "a") for n in names] + [(None, "1", "a")]), snap)
    assert upsert_batch(spark, _batch(spark, [(n, "1", "b") for n in names]), 0, _merge, snap, delta)
    got = rows(read_snapshot(spark, snap), "PmsInstanceId", "ResourceName")
    assert got == sorted([(n, "b") for n in names] + [(None, "a")], key=lambda t: tuple((x is None, str(x)) for x in t))
    for n in names[:4]:
        assert publish_purge(spark, snap, n, names.index(n))
    sweep(spark, snap)
    assert spark.read.schema(RESOURCE).option("recursiveFileLookup", "true").parquet(f"{snap}/data").count() == 5


def test_a_publish_costs_the_same_after_300_commits(spark, monkeypatch):
    snap, delta = _paths("snap", "delta")
    create_snapshot(spark, _resource(spark, [("T0", "1", "a")]), snap)
    calls = []
    for name in ("_names", "_read"):
        real = getattr(sinks, name)
        monkeypatch.setattr(sinks, name, lambda s, p, real=real, name=name: calls.append((name, p)) or real(s, p))

    def cost(batch_id):
        calls.clear()
        tracker, group = spark.sparkContext.statusTracker(), f"cost-{batch_id}"
        spark.sparkContext.setJobGroup(group, group)
        assert upsert_batch(spark, _batch(spark, [("T0", "1", str(batch_id))]), batch_id, _merge, snap, delta)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(calls), len(tracker.getJobIdsForGroup(group))

    cost(0)
    before = cost(1)
    state = sinks._state(spark, snap, latest_commit(spark, snap))
    for n in range(300):  # commits of other batches that changed nothing
        state = {**state, "commit": state["commit"] + 1, "batch_id": n, "run_id": "other", "feeds": {}}
        assert sinks._commit(spark, snap, state)
    assert cost(2) == before
    assert not any(p.endswith("/commits") for name, p in calls if name == "_names")
    assert read_delta(spark, snap, delta).count() == 3


def test_a_lost_hint_is_found_again(spark):
    (snap,) = _paths("snap")
    create_snapshot(spark, _resource(spark, [("T0", "1", "a")]), snap)
    publish_purge(spark, snap, "T9", 0)
    sinks._write(spark, f"{snap}/commits/_latest", "1")  # an old hint
    assert latest_commit(spark, snap) == 2
    sinks._delete(spark, f"{snap}/commits/_latest")
    assert latest_commit(spark, snap) == 2


def test_the_feed_is_one_scan_of_committed_batches(spark, monkeypatch):
    snap, delta = _paths("snap", "delta")
    create_snapshot(spark, _resource(spark, [("T0", "1", "a")]), snap)
    for n in range(4):
        assert upsert_batch(spark, _batch(spark, [("T0", str(n + 2), "x")]), n, _merge, snap, delta)
    real = sinks._finish
    monkeypatch.setattr(sinks, "_finish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        upsert_batch(spark, _batch(spark, [("T0", "99", "x")]), 4, _merge, snap, delta)
    monkeypatch.setattr(sinks, "_finish", real)
    feed = read_delta(spark, snap, delta)
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan
    assert rows(feed, "PmsResourceId", "batch_id") == [("2", 0), ("3", 1), ("4", 2), ("5", 3)]
    seen = latest_commit(spark, snap)
    assert read_feed(spark, snap, delta, after=seen) is None
    assert upsert_batch(spark, _batch(spark, [("T0", "50", "x")]), 5, _merge, snap, delta)
    assert rows(read_feed(spark, snap, delta, after=seen), "PmsResourceId") == [("50",)]
    assert rows(read_feed(spark, snap, delta, after=2, upto=4), "PmsResourceId") == [("3",), ("4",)]


def test_a_feed_stream_hands_out_each_row_once(spark):
    snap, delta, ckpt = _paths("snap", "delta", "ckpt")
    create_snapshot(spark, _resource(spark, [("T0", "1", "a")]), snap)
    got = []

    def drain():
        q = start_feed_stream(spark, snap, delta, lambda df, _: got.extend(rows(df, "PmsResourceId")), ckpt, max_commits_per_trigger=2)
        q.awaitTermination(120)

    for n in range(3):
        upsert_batch(spark, _batch(spark, [("T0", f"n{n}", "x")]), n, _merge, snap, delta)
    drain()
    assert sorted(got) == [("n0",), ("n1",), ("n2",)]
    upsert_batch(spark, _batch(spark, [("T0", "n3", "x"), ("T1", "n4", "x")]), 3, _merge, snap, delta)
    publish_purge(spark, snap, "T1", 0)  # a commit without change rows
    drain()
    drain()
    assert sorted(got) == [(f"n{n}",) for n in range(5)]


def test_two_writers_of_one_commit(spark):
    """The slower writer starts again from the faster one's result; nothing is lost."""
    snap, delta = _paths("snap", "delta")
    create_snapshot(spark, _resource(spark, [("T0", "1", "a"), ("T1", "1", "a")]), snap)
    slow, fast = _batch(spark, [("T0", "2", "slow")]), _batch(spark, [("T0", "3", "fast")])
    runs = []

    def change(rows_):
        runs.append(1)
        if len(runs) == 1:
            assert upsert_batch(spark, fast, 0, _merge, snap, delta, run_id="fast")
        r = _merge(rows_, slow, AS_OF)
        return r.snapshot, r.delta

    assert publish(spark, snap, 0, slow, change, delta, run_id="slow")
    assert len(runs) == 2
    assert rows(read_snapshot(spark, snap), "PmsInstanceId", "PmsResourceId") == [("T0", "1"), ("T0", "2"), ("T0", "3"), ("T1", "1")]
    assert rows(read_delta(spark, snap, delta), "PmsResourceId", "run_id") == [("2", "slow"), ("3", "fast")]
    state = sinks._state(spark, snap, 3)
    assert not sinks._commit(spark, snap, state)  # a commit file is never replaced


def test_sweep_removes_what_no_kept_commit_lists(spark):
    snap, delta = _paths("snap", "delta")
    key = F.trim(F.col("PmsResourceId"))
    create_snapshot(spark, _resource(spark, [(t, str(i), "a") for t in ("T0", "T1") for i in range(20)]), snap, key=key, buckets=4)
    first = latest_commit(spark, snap)
    assert upsert_batch(spark, _batch(spark, [("T1", "3", "b")]), 0, _merge, snap, delta, key=key, buckets=4)
    assert publish_purge(spark, snap, "t0", 0)
    whole = rows(read_snapshot(spark, snap))
    assert sweep(spark, snap, keep=3) == []  # everything is still listed by a kept commit
    assert read_snapshot(spark, snap, commit=first).count() == 40
    gone = sweep(spark, snap, keep=2)  # the first commit goes: one bucket of T1 and its list of partitions
    assert len(gone) == 2
    assert read_snapshot(spark, snap, commit=2).count() == 40  # within retention: before the purge
    os.makedirs(f"{snap}/data/_version=9/_try=x")  # a writer at work
    assert sweep(spark, snap, keep=1)
    raw = spark.read.schema(RESOURCE).option("recursiveFileLookup", "true").parquet(f"{snap}/data")
    assert raw.filter("PmsInstanceId = 'T0'").count() == 0 and rows(raw) == whole
    assert not any("t_t0" in f for f in _files(snap, ""))
    assert os.path.exists(f"{snap}/data/_version=9") and sweep(spark, snap, keep=1) == []
    assert rows(read_snapshot(spark, snap)) == whole
    assert read_delta(spark, snap, delta).count() == 1  # feeds are read past the sweep


def test_an_archive_is_read_only_when_committed(spark, monkeypatch):
    snap, archive = _paths("snap", "archive")
    create_snapshot(spark, _resource(spark, [("T0", "1", "a"), ("T1", "1", "a")]), snap)
    removed = read_snapshot(spark, snap).filter("PmsInstanceId = 'T0'")
    real = sinks._finish
    monkeypatch.setattr(sinks, "_finish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        publish_purge(spark, snap, "T0", 0, removed, archive)
    assert read_feed(spark, snap, archive) is None
    monkeypatch.setattr(sinks, "_finish", real)
    assert publish_purge(spark, snap, "T0", 0, removed, archive)
    assert rows(read_feed(spark, snap, archive), "PmsInstanceId", "PmsResourceId") == [("T0", "1")]


def test_a_null_is_part_of_the_fingerprint(spark):
    a = spark.createDataFrame([("a", None)], "x string, y string")
    b = spark.createDataFrame([(None, "a")], "x string, y string")
    assert sinks.fingerprint_of(a) != sinks.fingerprint_of(b)
    assert sinks.fingerprint_of(a) == sinks.fingerprint_of(a.select("y", "x"))


def test_a_hot_tenant_is_split_over_files_and_small_ones_are_not(spark):
    (snap,) = _paths("snap")
    n = 200_000
    df = spark.range(n).repartition(8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 5)).alias("PmsInstanceId"),
        F.col("id").cast("string").alias("PmsResourceId"), F.sha2(F.col("id").cast("string"), 256).alias("ResourceName"),
        F.lit(AS_OF).alias("UtcCreatedDate"), F.lit(AS_OF).alias("UtcLastModifiedDate"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        create_snapshot(spark, df, snap)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    files = [f.split("_tenant=")[1].split("/")[0] for f in _files(f"{snap}/data")]
    assert files.count("t_hot") > 2
    assert sum(files.count(f"t_t{i}") for i in range(5)) <= 10  # 8 tasks hold each of them before


# ------------------------------------------------------------------ visits and pickups with their patients


def _practice(spark, sf_dir):
    path, feed = _paths("practice", "feed")
    v = lambda n: fixture(spark, sf_dir, n)
    create_snapshot(spark, v("visit"), path, key=F.trim(F.col("PmsVisitId")), buckets=2, name="visit")
    create_snapshot(spark, v("product_pickup"), path, key=F.trim(F.col("PmsOrderId")), buckets=2, name="product_pickup")
    create_snapshot(spark, v("patient"), path, key=F.trim(F.col("PmsPatientId")), buckets=8, name="patient")

    def visits(rows_, batch, patients, clock):
        return entities.visit_upsert(rows_, batch, v("location"), v("provider"), patients, as_of=AS_OF, settle=True)

    def pickups(rows_, batch, patients, clock):
        return entities.product_pickup_upsert(rows_, batch, v("location"), v("provider"), patients, as_of=AS_OF, settle=True)

    return path, feed, v, visits, pickups


def test_streams_of_visits_and_pickups_move_the_patients_with_them(spark, sf_dir, monkeypatch):
    path, feed, v, visits, pickups = _practice(spark, sf_dir)
    folders = _paths("visits", "pickups", "ckpt-v", "ckpt-p")
    v("visit_in").coalesce(1).write.parquet(folders[0])
    v("product_pickup_in").coalesce(1).write.parquet(folders[1])

    def visit_stream():
        return start_patient_stream(
            spark, folders[0], v("visit_in").schema, visits, path, "visit", f"{feed}/visit", folders[2],
            key=F.trim(F.col("PmsVisitId")), buckets=2, patient_buckets=8,
        )

    real = sinks._finish  # the files of both tables are written, the commit is lost
    monkeypatch.setattr(sinks, "_finish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception, match="lost"):
        visit_stream().awaitTermination(300)
    assert rows(read_snapshot(spark, path, name="patient")) == rows(v("patient"))
    assert read_feed(spark, path, f"{feed}/visit") is None
    monkeypatch.setattr(sinks, "_finish", real)
    visit_stream().awaitTermination(300)
    start_patient_stream(
        spark, folders[1], v("product_pickup_in").schema, pickups, path, "product_pickup", f"{feed}/pickup", folders[3],
        key=F.trim(F.col("PmsOrderId")), buckets=2, patient_buckets=8,
    ).awaitTermination(300)
    first, patients = visits(v("visit"), v("visit_in"), v("patient"), AS_OF)
    second, patients = pickups(v("product_pickup"), v("product_pickup_in"), patients, AS_OF)
    assert rows(read_snapshot(spark, path, name="visit")) == rows(first.snapshot)
    assert rows(read_snapshot(spark, path, name="product_pickup")) == rows(second.snapshot)
    assert rows(read_snapshot(spark, path, name="patient")) == rows(patients)
    assert read_feed(spark, path, f"{feed}/visit").count() == first.delta.count()
    assert read_feed(spark, path, f"{feed}/pickup").count() == second.delta.count()


def test_a_batch_copies_only_its_patients_buckets(spark, sf_dir):
    from tessera.streaming.microbatch import upsert_batch_with_patients

    path, feed, v, visits, _ = _practice(spark, sf_dir)
    batch = v("visit_in").filter(F.col("PmsPatientId").isNotNull()).limit(1)
    assert upsert_batch_with_patients(
        spark, batch, 0, visits, path, "visit", feed, AS_OF, key=F.trim(F.col("PmsVisitId")), buckets=2, patient_buckets=8
    )
    written = {f.split("_bucket=")[1].split("/")[0] for f in _files(f"{path}/patient/data/_version=4")}
    assert len(written) == 1


def test_a_stream_of_slot_ids_deletes(spark, sf_dir):
    snap, delta, src, ckpt = _paths("slots", "delta", "ids", "ckpt")
    slots, ids = fixture(spark, sf_dir, "slot_all"), fixture(spark, sf_dir, "slot_ids")
    create_snapshot(spark, slots, snap)
    ids.coalesce(1).write.parquet(src)

    def delete(rows_, batch, clock):
        return entities.availability_slot_mark_deleted(rows_, batch, AS_OF)

    start_upsert_stream(spark, src, ids.schema, delete, snap, delta, ckpt).awaitTermination(120)
    want = entities.availability_slot_mark_deleted(slots, ids, AS_OF)
    assert rows(read_snapshot(spark, snap)) == rows(want.snapshot)
    assert read_delta(spark, snap, delta).count() == want.delta.count()
