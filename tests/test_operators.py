"""Soft delete, lookups, rollups, slot diff / delete and purge on literal data."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators.diff import SLOT_COLUMNS, slot_mark_deleted, snapshot_diff
from tessera.operators.purge import purge_tenant
from tessera.operators.resolve import lookup, one_row, scalar_lookup
from tessera.operators.rollup import apply_patient_facts, patient_facts
from tessera.operators.softdelete import mark_deleted
from tessera.plans import specs
from tests.util import AS_OF, rows

OLD = dt.datetime(1995, 1, 1)


def _items(spark):
    return spark.createDataFrame(
        [("T", "10", "1", 0, OLD, OLD), ("T", "10", "2", 1, OLD, OLD), ("T", "11", "1", 0, OLD, OLD)],
        "PmsInstanceId string, PmsTransactionId string, PmsTransactionItemId string, Deleted int, "
        "UtcCreatedDate timestamp, UtcLastModifiedDate timestamp",
    )


def _ids(spark, data):
    return spark.createDataFrame(data, "PmsInstanceId string, PmsId string")


def test_soft_delete_hits_every_item_and_ignores_unknown_ids(spark):
    r = mark_deleted(_items(spark), _ids(spark, [("T", " 10 "), ("T", "99")]), specs.SOFT_DELETES["transaction_item"], AS_OF)
    assert rows(r.snapshot, "PmsTransactionId", "PmsTransactionItemId", "Deleted") == [
        ("10", "1", 1), ("10", "2", 1), ("11", "1", 0)
    ]
    # n items of one transaction -> n delta rows, logged under the item id column, trimmed id.
    assert rows(r.delta, "PmsTransactionItemId", "ActionPerformed", "UtcCreatedDate") == [("10", 3, AS_OF)] * 2


def test_soft_delete_same_row_twice_fails(spark):
    r = mark_deleted(_items(spark), _ids(spark, [("T", "11"), ("T", "11 ")]), specs.SOFT_DELETES["transaction_item"], AS_OF)
    with pytest.raises(PySparkException, match="hits one row twice"):
        r.delta.collect()


def _dim(spark):
    return spark.createDataFrame(
        [("T", "R1", "Flu"), ("T", "R2", "Exam"), ("T", "R3", "Exam "), ("U", "R1", "Other")],
        "PmsInstanceId string, PmsReasonId string, ReasonName string",
    )


def test_lookup_trimmed_and_tenant_scoped(spark):
    inp = spark.createDataFrame([("T", " R1"), ("U", "R1"), ("T", "R9"), ("V", "R1")], "PmsInstanceId string, rid string")
    out = lookup(inp, _dim(spark), "rid", "PmsReasonId", {"ReasonName": "name"})
    assert rows(out, "PmsInstanceId", "rid", "name") == [
        ("T", " R1", "Flu"), ("T", "R9", None), ("U", "R1", "Other"), ("V", "R1", None)
    ]


def test_scalar_lookup_errors_only_on_the_branch_taken(spark):
    inp = spark.createDataFrame(
        [("T", "R2", "Exam"), ("T", " ", "Flu"), ("T", None, "Exam")],
        "PmsInstanceId string, PmsReasonId string, ReasonName string",
    )
    d = scalar_lookup(inp, _dim(spark), F.col("ReasonName"), "ReasonName", "PmsReasonId", "_n")
    d = scalar_lookup(d, _dim(spark), F.col("PmsReasonId"), "PmsReasonId", "PmsReasonId", "_i")
    by = F.when(F.coalesce(F.trim("PmsReasonId"), F.lit("")) == "", one_row("_n")).otherwise(one_row("_i"))
    ok = d.filter(F.col("PmsReasonId").isNotNull()).select(by.alias("r"))
    assert sorted(r.r for r in ok.collect()) == ["R1", "R2"]  # 'Exam' by name is ambiguous, but not asked
    with pytest.raises(PySparkException, match="more than one row"):
        d.select(by.alias("r")).collect()


def test_rollups_lens_and_exam(spark):
    patient = spark.createDataFrame(
        [("T", "1", "N", dt.datetime(2000, 1, 1), OLD), ("T", "2", "N", None, OLD), ("T", "3", "N", dt.datetime(2000, 1, 1), OLD)],
        "PmsInstanceId string, PmsPatientId string, ContactLensWearer string, LastVisitOrExamDate timestamp, "
        "UtcLastModifiedDate timestamp",
    )
    staged = spark.createDataFrame(
        [
            ("T", "1", " Contact Lenses", "Other", dt.datetime(2005, 1, 1)),
            ("T", "2 ", "Frames", "Exam ", dt.datetime(2005, 1, 1)),
            ("T", "3", "Frames", "Exam", dt.datetime(1999, 1, 1)),
            ("T", "3", "Frames", "Exam", None),
            ("T", None, " Contact Lenses", "Exam", dt.datetime(2010, 1, 1)),
        ],
        "PmsInstanceId string, PmsPatientId string, ProductType string, VisitType string, VisitDate timestamp",
    )
    out = apply_patient_facts(patient, patient_facts(staged), AS_OF)
    assert rows(out) == [
        ("T", "1", "Y", dt.datetime(2000, 1, 1), AS_OF),   # lens wearer
        ("T", "2", "N", None, OLD),                        # NULL stored date never advances
        ("T", "3", "N", dt.datetime(2000, 1, 1), OLD),     # earlier exam does not go back
    ]


def _slots(spark, data):
    schema = (
        "PmsInstanceId string, PmsLocationId string, PmsProviderId string, PmsResourceId string, "
        "PmsAltLocationId string, StartDateTime timestamp, Length int, SlotType string, SwimLanes int, "
        "SlotInfo string, PmsCreatedDate timestamp, PmsLastModifiedDate timestamp, UtcCreatedDate timestamp, "
        "UtcLastModifiedDate timestamp"
    )
    return spark.createDataFrame(
        [(i, l, p, "r", "a", OLD, n, t, 1, "x", OLD, OLD, OLD, OLD) for i, l, p, n, t in data], schema
    )


def test_slot_diff_three_way(spark):
    cur = _slots(spark, [("T", "L", "P1", 30, "A"), ("T", "L", "P2", 30, "B"), ("T", None, "P3", 30, "A")])
    prev = _slots(spark, [("T", "L", "P1", 30, "A"), ("T", "L ", "P2", 30, "C"), ("T", "L", "P4", 30, "A"), ("T", None, "P3", 30, "A")])
    d = snapshot_diff(cur, prev)
    assert d.columns == [*SLOT_COLUMNS, "ActionPerformed"]
    got = rows(d, "PmsLocationId", "PmsProviderId", "SlotType", "ActionPerformed")
    assert got == [
        ("L", "P2", "B", 2),     # trailing blank in the key is ignored; current values
        ("L", "P4", "A", 3),     # only in the previous generation
        (None, "P3", "A", 1),    # a NULL key never matches: listed as new ...
        (None, "P3", "A", 3),    # ... and as deleted
    ]
    assert snapshot_diff(prev.filter("PmsLocationId is not null"), prev.filter("PmsLocationId is not null")).count() == 0


def test_slot_mark_deleted_all_times_of_a_key(spark):
    slots = _slots(spark, [("T", "L", "P1", 30, "A"), ("T", "L", "P1", 30, "B"), ("T", "L", "P2", 30, "A")])
    ids = spark.createDataFrame([("T", "L ", "P1", 30, 1)], "PmsInstanceId string, PmsLocationId string, PmsProviderId string, Length int, SwimLanes int")
    r = slot_mark_deleted(slots, ids, AS_OF)
    assert rows(r.snapshot, "PmsProviderId") == [("P2",)]
    assert rows(r.delta, "PmsLocationId", "PmsProviderId", "ActionPerformed") == [("L", "P1", 3)] * 2


def test_purge_keeps_other_and_null_tenants(spark):
    t = spark.createDataFrame([("A",)] * 2500 + [("B",)] * 3 + [(None,)], "PmsInstanceId string")
    r = purge_tenant(t, "A", "visit", as_of=AS_OF)
    assert r.kept.count() == 4
    assert r.delta.count() == 2500
    assert rows(r.report) == [("visit", 2500, 3)]
    slot = purge_tenant(_slots(spark, [("A", "L", "P", 30, "A")]), "A", "availability_slot", is_slot_table=True)
    assert slot.delta is None and slot.archive.count() == 1 and len(slot.archive.columns) == 10


def test_cluster_conf_sizes_partitions():
    from tessera.session import cluster_conf

    conf = cluster_conf(100 * (1 << 40), executor_cores=8, executors=1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(cluster_conf(1 << 20, 8, 10)["spark.sql.shuffle.partitions"]) == 80


def test_purge_removed_plus_kept_is_everything(spark, sf_dir):
    from tessera.sources.tables import fixture

    visit = fixture(spark, sf_dir, "visit")
    for tenant in ("T0", "T1", "T2", "nobody"):
        r = purge_tenant(visit, tenant, "visit")
        assert r.kept.count() + r.delta.count() == visit.count()
        assert r.kept.filter(F.col("PmsInstanceId") == tenant).count() == 0
