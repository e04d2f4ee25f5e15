"""Publishing protocol and the micro-batch stream: replay, crashes, emptied and odd partitions."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.operators.purge import purge_tenant
from tessera.plans import entities
from tessera.sources import sinks
from tessera.sources.sinks import create_snapshot, publish, publish_purge, read_delta, read_snapshot
from tessera.sources.tables import fixture
from tessera.streaming.microbatch import start_upsert_stream, upsert_batch, upsert_batch_with_patients
from tests.util import AS_OF, rows

T = "PmsInstanceId"


def _merge(target, batch, clock):
    return entities.resource_upsert(target, batch, as_of=AS_OF)


def _paths(*names):
    base = tempfile.mkdtemp(prefix="tessera-pub-")
    return [os.path.join(base, n) for n in names]


def _resource(spark, data):
    return spark.createDataFrame(
        [(t, i, n, AS_OF, AS_OF) for t, i, n in data],
        "PmsInstanceId string, PmsResourceId string, ResourceName string, UtcCreatedDate timestamp, UtcLastModifiedDate timestamp",
    )


def _batch(spark, data):
    return spark.createDataFrame(data, "PmsInstanceId string, PmsResourceId string, ResourceName string")


def _drop(tenant):
    """A change that deletes every row of the tenant."""
    return lambda df: (df.filter(F.col(T) != tenant), df.filter(F.col(T) == tenant).select(T, F.lit(3).alias("ActionPerformed")))


def test_publish_is_idempotent_per_batch(spark, sf_dir):
    snap, delta = _paths("snap", "delta")
    resource, batch = fixture(spark, sf_dir, "resource"), fixture(spark, sf_dir, "resource_in")
    create_snapshot(spark, resource, snap)
    assert rows(read_snapshot(spark, snap)) == rows(resource)
    assert upsert_batch(spark, batch, 0, _merge, snap, delta)
    expected = entities.resource_upsert(resource, batch, as_of=AS_OF)
    first = rows(read_snapshot(spark, snap), *resource.columns)
    assert first == rows(expected.snapshot, *resource.columns)
    changes = read_delta(spark, snap, delta)
    assert rows(changes.drop("batch_id", "run_id")) == rows(expected.delta)
    assert not upsert_batch(spark, batch, 0, _merge, snap, delta)  # a replay is a no-op
    assert upsert_batch(spark, batch, 1, _merge, snap, delta)  # the same rows again change nothing
    assert rows(read_snapshot(spark, snap), *resource.columns) == first
    assert read_delta(spark, snap, delta).filter("batch_id = 1").count() == 0
    with pytest.raises(ValueError, match="other rows"):
        upsert_batch(spark, batch.limit(3), 1, _merge, snap, delta)


def test_emptied_partitions_go(spark):
    snap, delta = _paths("snap", "delta")
    create_snapshot(spark, _resource(spark, [("T0", "1", "a"), ("T0", "2", "b"), ("T1", "1", "c")]), snap)
    ids = _batch(spark, [("T0", "1", None)])
    assert publish(spark, snap, 0, ids, _drop("T0"), delta)
    assert rows(read_snapshot(spark, snap), T, "PmsResourceId") == [("T1", "1")]
    assert publish(spark, snap, 1, _batch(spark, [("T1", "1", None)]), _drop("T1"), delta)
    assert read_snapshot(spark, snap).count() == 0  # every partition empty
    assert read_delta(spark, snap, delta).count() == 3
    assert upsert_batch(spark, _batch(spark, [("T0", "9", "z")]), 2, _merge, snap, delta)
    assert rows(read_snapshot(spark, snap), T, "PmsResourceId") == [("T0", "9")]


@pytest.mark.parametrize("overwrite", ["static", "dynamic"])
def test_purge_leaves_no_row_and_keeps_the_commits(spark, overwrite):
    (snap, delta, archive) = _paths("snap", "delta", "archive")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", overwrite)
    try:
        create_snapshot(spark, _resource(spark, [("AB-0", "1", "a"), ("AB-1", "1", "c"), (None, "5", "n")]), snap)
        batch = _batch(spark, [("AB-0", "3", "x")])
        assert upsert_batch(spark, batch, 0, _merge, snap, delta)
        removed = read_snapshot(spark, snap).filter("lower(PmsInstanceId) = 'ab-0'")
        assert publish_purge(spark, snap, "ab-0", 0, removed, archive)
        assert rows(read_snapshot(spark, snap), T, "PmsResourceId") == [("AB-1", "1"), (None, "5")]
        assert spark.read.parquet(archive).count() == 2
        assert not publish_purge(spark, snap, "AB-0", 0)
        assert not upsert_batch(spark, batch, 0, _merge, snap, delta)  # still known as applied
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_null_and_mixed_case_tenants(spark):
    snap, delta = _paths("snap", "delta")
    create_snapshot(spark, _resource(spark, [("AB-1", "1", "a"), ("", "1", "e"), (None, "7", "n")]), snap)
    batch = _batch(spark, [("ab-1", "1", "new"), (None, "8", "m"), ("", "1", "f")])
    assert upsert_batch(spark, batch, 0, _merge, snap, delta)
    got = rows(read_snapshot(spark, snap), T, "PmsResourceId", "ResourceName")
    assert got == sorted(
        [("AB-1", "1", "new"), ("", "1", "f"), (None, "7", "n"), (None, "8", "m")], key=lambda t: tuple((x is None, str(x)) for x in t)
    )
    assert rows(read_delta(spark, snap, delta), "PmsResourceId", "ActionPerformed") == [("1", 2), ("1", 2), ("8", 1)]


def test_two_tables_and_two_runs_do_not_mix(spark):
    a, b, da, db = _paths("a", "b", "da", "db")
    for path in (a, b):
        create_snapshot(spark, _resource(spark, [("T0", "1", "a")]), path)
    assert upsert_batch(spark, _batch(spark, [("T0", "2", "x")]), 0, _merge, a, da)
    assert upsert_batch(spark, _batch(spark, [("T0", "3", "y")]), 0, _merge, b, db)
    assert rows(read_snapshot(spark, b), "PmsResourceId") == [("1",), ("3",)]
    # a stream with a new checkpoint counts from 0 again
    assert upsert_batch(spark, _batch(spark, [("T0", "4", "z")]), 0, _merge, a, da, run_id="second")
    assert rows(read_snapshot(spark, a), "PmsResourceId") == [("1",), ("2",), ("4",)]
    assert read_delta(spark, a, da).count() == 2


def test_crash_before_the_commit_shows_nothing_and_runs_again(spark, monkeypatch):
    snap, delta = _paths("snap", "delta")
    create_snapshot(spark, _resource(spark, [("T0", "1", "a")]), snap)
    first, second = _batch(spark, [("T0", "2", "x")]), _batch(spark, [("T0", "3", "y"), ("T1", "1", "w")])
    assert upsert_batch(spark, first, 0, _merge, snap, delta)
    commit = sinks._commit
    monkeypatch.setattr(sinks, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        upsert_batch(spark, second, 1, _merge, snap, delta)
    assert rows(read_snapshot(spark, snap), "PmsResourceId") == [("1",), ("2",)]
    assert read_delta(spark, snap, delta).count() == 1
    monkeypatch.setattr(sinks, "_commit", commit)
    assert upsert_batch(spark, second, 1, _merge, snap, delta)
    assert rows(read_snapshot(spark, snap), T, "PmsResourceId") == [("T0", "1"), ("T0", "2"), ("T0", "3"), ("T1", "1")]
    assert read_delta(spark, snap, delta).count() == 3


def test_stream_applies_each_file_once(spark, sf_dir):
    src, snap, delta, ckpt = _paths("in", "snap", "delta", "ckpt")
    create_snapshot(spark, fixture(spark, sf_dir, "resource"), snap)
    batch = fixture(spark, sf_dir, "resource_in")
    batch.coalesce(1).write.parquet(src)
    q = start_upsert_stream(spark, src, batch.schema, _merge, snap, delta, ckpt)
    q.awaitTermination(120)
    expected = entities.resource_upsert(fixture(spark, sf_dir, "resource"), batch, as_of=AS_OF)
    assert read_delta(spark, snap, delta).count() == expected.delta.count()


def test_bucketed_layout_touches_only_its_buckets(spark, sf_dir):
    snap, delta = _paths("snap", "delta")
    key = F.trim(F.col("PmsResourceId"))
    resource = fixture(spark, sf_dir, "resource")
    create_snapshot(spark, resource, snap, key=key, buckets=8)
    batch = fixture(spark, sf_dir, "resource_in").filter(F.pmod(F.xxhash64(key), F.lit(8)) == 3)
    assert upsert_batch(spark, batch, 0, _merge, snap, delta, key=key, buckets=8)
    expected = entities.resource_upsert(resource, batch, as_of=AS_OF).snapshot
    assert rows(read_snapshot(spark, snap), *expected.columns) == rows(expected)
    versions = sinks.open_table(spark, snap).parts().groupBy("_version").agg(F.collect_set("_bucket").alias("b"))
    assert {r["_version"]: sorted(r["b"]) for r in versions.collect()}[2] == [3]


def test_small_batch_reads_only_the_touched_partitions(spark, sf_dir):
    """Literal partition filters on every scan of the target; files read are those of the touched buckets."""
    (snap,) = _paths("snap")
    key = F.trim(F.col("PmsResourceId"))
    create_snapshot(spark, fixture(spark, sf_dir, "resource"), snap, key=key, buckets=16)
    batch = fixture(spark, sf_dir, "resource_in").limit(1)
    table = sinks.open_table(spark, snap)
    touched = sinks.touched_parts(table, batch, key, 16)
    target = read_snapshot(spark, snap, touched)
    result = entities.resource_upsert(target, batch, as_of=AS_OF)
    for df in (result.snapshot, result.delta):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.split("\n") if "Scan parquet" in x and "_bucket" in x]
        assert scans and all("_bucket" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)
    assert len(target.inputFiles()) >= 1
    read = target.select(F.input_file_name().alias("f")).distinct().collect()
    want = {(r[T].lower(), r["_bucket"]) for r in touched.collect()}
    assert {(r.f.split("_tenant=t_")[1].split("/")[0], int(r.f.split("_bucket=")[1].split("/")[0])) for r in read} <= want


def test_visit_batch_publishes_the_patients_too(spark, sf_dir):
    path, delta = _paths("practice", "delta")
    v = lambda n: fixture(spark, sf_dir, n)
    create_snapshot(spark, v("visit"), path, name="visit")
    create_snapshot(spark, v("patient"), path, name="patient")

    def merge(visit, batch, patient, clock):
        return entities.visit_upsert(visit, batch, v("location"), v("provider"), patient, as_of=AS_OF)

    result, after = merge(v("visit"), v("visit_in"), v("patient"), AS_OF)
    assert upsert_batch_with_patients(spark, v("visit_in"), 0, merge, path, "visit", delta)
    assert not upsert_batch_with_patients(spark, v("visit_in"), 0, merge, path, "visit", delta)
    assert rows(read_snapshot(spark, path, name="visit"), *result.snapshot.columns) == rows(result.snapshot)
    assert rows(read_snapshot(spark, path, name="patient"), *after.columns) == rows(after)


def test_purge_of_the_other_letter_case(spark):
    df = _resource(spark, [("AB-0", "1", "a"), ("AB-1", "1", "c"), (None, "5", "n")])
    r = purge_tenant(df, "ab-0", "resource", as_of=AS_OF)
    assert rows(r.kept, T) == [("AB-1",), (None,)] and rows(r.delta, T) == [("AB-0",)]


def test_read_batch_with_declared_schema(spark, sf_dir):
    from tessera.sources.schemas import INPUT_SCHEMAS, read_batch

    base = tempfile.mkdtemp(prefix="tessera-batch-")
    batch = fixture(spark, sf_dir, "resource_in")
    batch.write.parquet(os.path.join(base, "resource"))
    got = read_batch(spark, os.path.join(base, "resource"), "resource")
    assert got.schema == INPUT_SCHEMAS["resource"]
    r = entities.resource_upsert(fixture(spark, sf_dir, "resource"), got, as_of=AS_OF)
    assert rows(r.delta) == rows(entities.resource_upsert(fixture(spark, sf_dir, "resource"), batch, as_of=AS_OF).delta)
    # A batch file without a column reads it as NULL instead of failing.
    batch.drop("ResourceName").write.parquet(os.path.join(base, "narrow"))
    narrow = read_batch(spark, os.path.join(base, "narrow"), "resource")
    assert narrow.filter(F.col("ResourceName").isNotNull()).count() == 0
    # Every declared patient column is one the patient merge spec knows.
    names = {f.name for f in INPUT_SCHEMAS["patient"].fields}
    assert {f.source for f in entities.specs.PATIENT.fields if f.insert != "clock"} <= names
