"""Results that must not depend on a size bound, and rules that hold in every output."""

import pytest

from tessera.operators.softdelete import mark_deleted
from tessera.plans import entities, specs
from tests.util import AS_OF, rows

RES = "PmsInstanceId string, PmsResourceId string, ResourceName string, UtcCreatedDate timestamp, UtcLastModifiedDate timestamp"
BATCH = "PmsInstanceId string, PmsResourceId string, ResourceName string"


def _tables(spark):
    target = [("AB", "1", "a"), ("ab", "2", "b"), ("AB", "3", "c"), (None, "4", "d"), ("AB", "5", "e"), ("AB", "5 ", "e")]
    batch = [("ab", "1", "A2"), ("AB", "2", "b"), ("AB", "9", "new"), (None, "4", "x"), ("AB", "5", "e"), ("AB", "1", "a")]
    return (
        spark.createDataFrame([(t, i, n, AS_OF, AS_OF) for t, i, n in target], RES),
        spark.createDataFrame(batch, BATCH),
    )


def test_snapshot_delta_and_pairs_are_equal_in_both_shapes(spark):
    target, batch = _tables(spark)
    small, large = (entities.resource_upsert(target, batch, as_of=AS_OF, max_broadcast_rows=n) for n in (100, 0))
    assert rows(small.snapshot) == rows(large.snapshot)
    assert rows(small.delta) == rows(large.delta)
    cols = ("s__PmsResourceId", "t__PmsResourceId", "_action")
    assert rows(small.classified, *cols) == rows(large.classified, *cols)
    assert large.classified.filter("_action is null").count() == 0


def test_tenant_letter_case_matches(spark):
    target, batch = _tables(spark)
    delta = entities.resource_upsert(target, batch, as_of=AS_OF).delta
    assert rows(delta, "PmsResourceId", "ActionPerformed") == [("1", 2), ("4", 1), ("9", 1)]


@pytest.mark.parametrize("bound", [100, 0])
def test_an_id_listed_twice_fails_in_both_outputs(spark, bound):
    schema = "PmsInstanceId string, PmsVisitId string, Deleted int, UtcLastModifiedDate timestamp"
    target = spark.createDataFrame([("T", "1", 0, AS_OF), ("T", "2", 0, AS_OF)], schema)
    ids = lambda *x: spark.createDataFrame([("t", i) for i in x], "PmsInstanceId string, PmsId string")
    spec = specs.SOFT_DELETES["visit"]
    twice = mark_deleted(target, ids("1", "1 "), spec, AS_OF, max_broadcast_rows=bound)
    for df in (twice.snapshot, twice.delta):
        with pytest.raises(Exception, match="hits one row twice"):
            df.collect()
    # listed twice without a target row: ignored, as every id that matches nothing
    fine = mark_deleted(target, ids("1", "7", "7"), spec, AS_OF, max_broadcast_rows=bound)
    assert rows(fine.snapshot, "PmsVisitId", "Deleted") == [("1", 1), ("2", 0)]
    assert rows(fine.delta, "PmsVisitId", "ActionPerformed") == [("1", 3)]


def test_purge_table_is_one_of_the_known(spark):
    target, _ = _tables(spark)
    with pytest.raises(ValueError, match="unknown table"):
        entities.batch_delete_tenant(target, "AB", "slot")


def test_staging_runs_once_per_call(spark, sf_dir):
    from tessera.sources.tables import fixture

    v = lambda n: fixture(spark, sf_dir, n)
    r = entities.appointment_upsert(
        v("appointment"), v("appointment_in"), v("location"), v("provider"), v("patient"), v("appointment_reason"), AS_OF
    )
    for df in (r.snapshot, r.delta):  # the lookups are in the staged table, not in the plan
        assert "_rsn" not in df._jdf.queryExecution().optimizedPlan().toString()
