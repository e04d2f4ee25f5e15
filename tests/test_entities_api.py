"""The public procedure functions give the same rows as the oracle-checked queries."""

import pytest

import __spark_entry__ as E
from tessera.plans import entities
from tessera.sources.tables import fixture
from tests.util import AS_OF, rows


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert rows(a, *cols) == rows(b, *cols)


@pytest.fixture(scope="module")
def v(spark, sf_dir):
    return lambda name: fixture(spark, sf_dir, name)


def test_list_upserts(spark, sf_dir, v):
    q = E.queries()
    _same(entities.location_upsert(v("location"), v("location_in"), AS_OF).delta, q["location_upsert_delta"](spark, sf_dir))
    _same(entities.insurer_upsert(v("insurer"), v("insurer_in"), "name", AS_OF).snapshot,
          q["insurer_upsert_by_name_snapshot"](spark, sf_dir))
    _same(entities.recall_reason_upsert(v("recall_reason"), v("recall_reason_in"), "id", AS_OF).delta,
          q["recall_reason_upsert_by_id_delta"](spark, sf_dir))


def test_fact_upserts(spark, sf_dir, v):
    q = E.queries()
    r = entities.appointment_upsert(v("appointment"), v("appointment_in"), v("location"), v("provider"),
                                    v("patient"), v("appointment_reason"), AS_OF)
    _same(r.delta, q["appointment_upsert_delta"](spark, sf_dir))
    r = entities.patient_upsert(v("patient_wide"), v("patient_wide_in"), v("location"), v("provider"), v("insurer"), AS_OF)
    _same(r.snapshot, q["patient_upsert_snapshot"](spark, sf_dir))
    r, patient_after = entities.product_pickup_upsert(v("product_pickup"), v("product_pickup_in"), v("location"),
                                                      v("provider"), v("patient"), AS_OF)
    _same(r.delta, q["product_pickup_upsert_delta"](spark, sf_dir))
    _same(patient_after, q["product_pickup_lens_rollup"](spark, sf_dir))
    r, patient_after = entities.visit_upsert(v("visit"), v("visit_in"), v("location"), v("provider"), v("patient"), AS_OF)
    _same(r.snapshot, q["visit_upsert_snapshot"](spark, sf_dir))
    _same(patient_after, q["visit_patient_rollup"](spark, sf_dir))
    r = entities.recall_upsert(v("recall"), v("recall_in"), v("location"), v("provider"), v("patient"),
                               v("recall_reason"), AS_OF)
    _same(r.delta, q["recall_upsert_delta"](spark, sf_dir))
    r = entities.appointment_block_upsert(v("appointment_block"), v("appointment_block_in"), v("location"),
                                          v("provider"), v("resource"), AS_OF)
    _same(r.snapshot, q["appointment_block_upsert_snapshot"](spark, sf_dir))


def test_deletes_diff_purge(spark, sf_dir, v):
    q = E.queries()
    _same(entities.soft_delete("visit", v("visit"), v("order_ids"), AS_OF).delta, q["visit_mark_deleted_delta"](spark, sf_dir))
    _same(entities.availability_slot_compare(v("slot"), v("slot_cleared")), q["slot_diff"](spark, sf_dir))
    _same(entities.availability_slot_mark_deleted(v("slot_all"), v("slot_ids"), AS_OF).snapshot,
          q["slot_mark_deleted_snapshot"](spark, sf_dir))
    p = entities.batch_delete_tenant(v("slot_all"), "T1", "availability_slot", AS_OF)
    _same(p.archive, q["purge_slot_archive"](spark, sf_dir))
    assert p.delta is None


def test_slot_refresh_flow(spark, sf_dir, v):
    """Purge a tenant's slots into the archive, reload, diff against the archive."""
    from pyspark.sql import functions as F

    previous = v("slot_cleared")
    purged = entities.batch_delete_tenant(previous, "T1", "availability_slot", AS_OF)
    assert purged.kept.filter(F.col("PmsInstanceId") == "T1").count() == 0
    # The archive keeps the 10 slot columns; the diff reads audit columns as NULL there.
    archive = purged.archive.select(
        "*", *[F.lit(None).cast("timestamp").alias(c) for c in
               ("PmsCreatedDate", "PmsLastModifiedDate", "UtcCreatedDate", "UtcLastModifiedDate")]
    )
    reloaded = v("slot").filter(F.col("PmsInstanceId") == "T1")
    diff = entities.availability_slot_compare(reloaded, archive)
    whole = entities.availability_slot_compare(v("slot"), previous).filter(F.col("PmsInstanceId") == "T1")
    key = ["PmsInstanceId", "PmsLocationId", "PmsProviderId", "StartDateTime", "Length", "SwimLanes", "SlotType",
           "ActionPerformed"]
    assert rows(diff, *key) == rows(whole, *key)
