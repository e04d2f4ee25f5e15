"""Hand-made cases for the merge rules and the reference's traps."""

import datetime as dt
import decimal

import pytest
from pyspark.errors import PySparkException

from tessera.operators.merge import merge
from tessera.plans import specs
from tests.util import AS_OF, rows

OLD = dt.datetime(1995, 1, 1)


def _loc(spark, data):
    return spark.createDataFrame(
        [(i, k, n, z, OLD, OLD) for i, k, n, z in data],
        "PmsInstanceId string, PmsLocationId string, LocationName string, TimeZone string, "
        "UtcCreatedDate timestamp, UtcLastModifiedDate timestamp",
    )


def _loc_in(spark, data):
    return spark.createDataFrame(
        list(data),
        "PmsInstanceId string, PmsLocationId string, LocationName string, TimeZone string",
    )


def _actions(r, key="PmsLocationId"):
    return dict(rows(r.delta, key, "ActionPerformed"))


def test_insert_update_unchanged(spark):
    t = _loc(spark, [("T", "1", "A", "UTC"), ("T", "2", "B", "UTC")])
    s = _loc_in(spark, [("T", "1", " A ", "UTC"), ("T", "2", "B2", "UTC"), ("T", "3", "C", "UTC")])
    r = merge(t, s, specs.LOCATION, AS_OF)
    assert _actions(r) == {"2": 2, "3": 1}
    snap = {k: (n, m) for k, n, m in rows(r.snapshot, "PmsLocationId", "LocationName", "UtcLastModifiedDate")}
    assert snap == {"1": ("A", OLD), "2": ("B2", AS_OF), "3": ("C", AS_OF)}


def test_null_collapse_vs_null_safe(spark):
    # NULL TimeZone on both sides: the fingerprint is NULL on both sides, so a real
    # name change is missed in collapse mode and seen in null_safe mode.
    t = _loc(spark, [("T", "1", "A", None)])
    s = _loc_in(spark, [("T", "1", "Z", None)])
    assert _actions(merge(t, s, specs.LOCATION, AS_OF)) == {}
    assert _actions(merge(t, s, specs.LOCATION, AS_OF, mode="null_safe")) == {"1": 2}
    # NULL on one side only: an update in both modes.
    s2 = _loc_in(spark, [("T", "1", "A", "UTC")])
    assert _actions(merge(t, s2, specs.LOCATION, AS_OF)) == {"1": 2}


def test_concatenation_boundary(spark):
    # 'ab' + 'c' = 'a' + 'bc': collapse mode sees no change.
    t = _loc(spark, [("T", "1", "ab", "c")])
    s = _loc_in(spark, [("T", "1", "a", "bc")])
    assert _actions(merge(t, s, specs.LOCATION, AS_OF)) == {}
    assert _actions(merge(t, s, specs.LOCATION, AS_OF, mode="null_safe")) == {"1": 2}


def test_raw_key_ignores_trailing_blanks_only(spark):
    t = _loc(spark, [("T", "5  ", "A", "UTC")])
    s = _loc_in(spark, [("T", "5", "A", "UTC"), ("T", " 5", "A", "UTC")])
    r = merge(t, s, specs.LOCATION, AS_OF)
    # '5' matches '5  ' (unchanged); ' 5' is a new key, inserted raw, logged trimmed.
    assert _actions(r) == {"5": 1}
    assert rows(r.snapshot, "PmsLocationId") == [(" 5",), ("5  ",)]


def test_two_updates_of_one_row_fail(spark):
    t = _loc(spark, [("T", "1", "A", "UTC")])
    s = _loc_in(spark, [("T", "1", "B", "UTC"), ("T", "1 ", "C", "UTC")])
    with pytest.raises(PySparkException, match="several source rows update one target row"):
        merge(t, s, specs.LOCATION, AS_OF).snapshot.collect()


def test_duplicate_source_rows_one_update_one_noop(spark):
    t = _loc(spark, [("T", "1", "A", "UTC")])
    s = _loc_in(spark, [("T", "1", "A", "UTC"), ("T", "1", "B", "UTC")])
    r = merge(t, s, specs.LOCATION, AS_OF)
    assert rows(r.snapshot, "PmsLocationId", "LocationName") == [("1", "B")]
    assert rows(r.delta, "PmsLocationId", "ActionPerformed") == [("1", 2)]


def test_duplicate_new_keys_are_all_inserted(spark):
    t = _loc(spark, [])
    s = _loc_in(spark, [("T", "9", "A", "UTC"), ("T", "9", "B", "UTC")])
    r = merge(t, s, specs.LOCATION, AS_OF)
    assert r.snapshot.count() == 2 and r.delta.count() == 2


def test_duplicate_stored_keys_both_kept(spark):
    t = _loc(spark, [("T", "1", "A", "UTC"), ("T", "1", "A", "UTC")])
    s = _loc_in(spark, [("T", "1", "A", "UTC")])
    r = merge(t, s, specs.LOCATION, AS_OF)
    assert r.snapshot.count() == 2 and r.delta.count() == 0


def test_null_key_never_matches(spark):
    t = _loc(spark, [("T", None, "A", "UTC")])
    s = _loc_in(spark, [("T", None, "A", "UTC")])
    r = merge(t, s, specs.LOCATION, AS_OF)
    assert r.snapshot.count() == 2
    assert rows(r.delta, "ActionPerformed") == [(1,)]


def test_tenant_scopes_the_key(spark):
    t = _loc(spark, [("T1", "1", "A", "UTC")])
    s = _loc_in(spark, [("T2", "1", "A", "UTC")])
    assert rows(merge(t, s, specs.LOCATION, AS_OF).delta, "PmsInstanceId", "ActionPerformed") == [("T2", 1)]


def test_merge_twice_is_idempotent(spark):
    t = _loc(spark, [("T", "1", "A", "UTC"), ("T", "2", "B", "UTC")])
    s = _loc_in(spark, [("T", "1", "A2", "UTC"), ("T", "3", "C", "UTC")])
    first = merge(t, s, specs.LOCATION, AS_OF)
    again = merge(first.snapshot, s, specs.LOCATION, AS_OF)
    assert again.delta.count() == 0
    assert first.snapshot.count() == t.count() + 1


def test_small_and_large_batch_plans_agree(spark):
    t = _loc(spark, [("T", str(i), f"N{i}", "UTC") for i in range(50)])
    s = _loc_in(spark, [("T", str(i), f"N{i % 7}", "UTC") for i in range(25, 80)])
    a = merge(t, s, specs.LOCATION, AS_OF, batch_small=True)
    b = merge(t, s, specs.LOCATION, AS_OF, batch_small=False)
    assert rows(a.snapshot) == rows(b.snapshot)
    assert rows(a.delta) == rows(b.delta)


def test_visit_date_never_goes_back(spark):
    cols = [f.name for f in specs.VISIT.fields]
    base = {c: "x" for c in cols}
    base.update(PmsInstanceId="T", PmsVisitId="1", ShowedUp=1, Deleted=0, SpendAmt=decimal.Decimal("1.00"),
                PmsCreatedDate=OLD, PmsLastModifiedDate=OLD, UtcCreatedDate=OLD, UtcLastModifiedDate=OLD)
    schema = ", ".join(
        f"{c} {'int' if c in ('ShowedUp', 'Deleted') else 'timestamp' if c.endswith('Date') else 'decimal(15,2)' if c == 'SpendAmt' else 'string'}"
        for c in cols
    )

    def df(**kw):
        d = dict(base, **kw)
        return spark.createDataFrame([tuple(d[c] for c in cols)], schema)

    t = df(VisitDate=dt.datetime(2000, 1, 1), VisitReason="old")
    earlier = df(VisitDate=dt.datetime(1999, 1, 1), VisitReason="new")
    r = merge(t, earlier, specs.VISIT, AS_OF)
    assert rows(r.snapshot, "VisitDate", "VisitReason") == [(dt.datetime(2000, 1, 1), "new")]
    null_t = df(VisitDate=None, VisitReason="old")
    r2 = merge(null_t, earlier, specs.VISIT, AS_OF)
    assert rows(r2.snapshot, "VisitDate") == [(None,)]


def test_collation_option_ignores_case_and_trailing_blanks(spark):
    t = _loc(spark, [("T", "1", "Main St", "UTC")])
    s = _loc_in(spark, [("T", "1", "MAIN ST", "utc")])
    assert _actions(merge(t, s, specs.LOCATION, AS_OF)) == {"1": 2}
    assert _actions(merge(t, s, specs.LOCATION, AS_OF, collation="UTF8_LCASE_RTRIM")) == {}


def test_minute_resolution_option(spark):
    cols = [f.name for f in specs.APPOINTMENT.fields]
    types = {"StartDate": "date", "Length": "int", "ShowedUp": "int", "Deleted": "int", "SpendAmt": "decimal(15,2)"}
    schema = ", ".join(
        f"{c} {types.get(c, 'timestamp' if c.endswith('Date') and c != 'StartDate' else 'string')}" for c in cols
    )
    base = {c: "x" for c in cols}
    base.update(StartDate=dt.date(2000, 1, 1), Length=30, ShowedUp=1, Deleted=0, SpendAmt=decimal.Decimal("1.00"),
                PmsCreatedDate=OLD, PmsLastModifiedDate=OLD, UTCCreatedDate=OLD, UTCLastModifiedDate=OLD)
    t = spark.createDataFrame([tuple(base[c] for c in cols)], schema)
    later = dict(base, PmsLastModifiedDate=OLD + dt.timedelta(seconds=20))
    s = spark.createDataFrame([tuple(later[c] for c in cols)], schema)
    full = merge(t, s, specs.APPOINTMENT, AS_OF)
    assert rows(full.delta, "ActionPerformed", "PmsLastModifiedDate", "PmsPatientId") == [(2, later["PmsLastModifiedDate"], None)]
    assert merge(t, s, specs.APPOINTMENT, AS_OF, time_resolution="minute").delta.count() == 0


@pytest.mark.parametrize("name,key", [
    ("resource_upsert_snapshot", "PmsResourceId"),
    ("provider_upsert_snapshot", "PmsProviderId"),
    ("appointment_block_upsert_snapshot", "PmsAppointmentId"),
    ("visit_upsert_snapshot", "PmsVisitId"),
])
def test_unique_keys_in_unique_keys_out(spark, sf_dir, name, key):
    import __spark_entry__ as E
    from pyspark.sql import functions as F

    snap = E.queries()[name](spark, sf_dir)
    worst = snap.groupBy("PmsInstanceId", F.trim(key)).count().agg(F.max("count")).first()[0]
    assert worst == 1


def test_rerun_of_the_same_batch_changes_nothing(spark, sf_dir):
    """Second merge of the same batch: empty feed for trimmed, defaulted entities."""
    from tessera.plans import entities
    from tessera.sources.tables import fixture

    for target, inp, fn in (("resource", "resource_in", entities.resource_upsert),
                            ("provider", "provider_in", entities.provider_upsert)):
        first = fn(fixture(spark, sf_dir, target), fixture(spark, sf_dir, inp), as_of=AS_OF)
        snap = spark.createDataFrame(first.snapshot.collect(), first.snapshot.schema)
        assert fn(snap, fixture(spark, sf_dir, inp), as_of=AS_OF).delta.count() == 0


@pytest.mark.parametrize("batch_small", [True, False])
def test_hot_key_third_of_batch(spark, batch_small):
    from pyspark.sql import functions as F

    t = spark.range(2000).selectExpr(
        "'T' AS PmsInstanceId", "CAST(id AS STRING) AS PmsLocationId", "'n' || CAST(id AS STRING) AS LocationName",
        "'UTC' AS TimeZone", "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate",
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate",
    )
    # 1,000 copies of key '7' that change nothing, plus 2,000 ordinary rows.
    hot = spark.range(1000).selectExpr("'T' AS PmsInstanceId", "'7' AS PmsLocationId", "' n7 ' AS LocationName", "'UTC' AS TimeZone")
    rest = spark.range(1000, 3000).selectExpr(
        "'T' AS PmsInstanceId", "CAST(id AS STRING) AS PmsLocationId", "'m' || CAST(id AS STRING) AS LocationName",
        "'UTC' AS TimeZone",
    )
    r = merge(t, hot.unionByName(rest), specs.LOCATION, AS_OF, batch_small=batch_small)
    assert r.snapshot.count() == 3000
    assert dict(rows(r.delta.groupBy("ActionPerformed").count())) == {1: 1000, 2: 1000}
    assert r.snapshot.filter(F.col("PmsLocationId") == "7").select("LocationName").first()[0] == "n7"
    changing = spark.range(1000).selectExpr("'T' AS PmsInstanceId", "'7' AS PmsLocationId", "'new' AS LocationName", "'UTC' AS TimeZone")
    with pytest.raises(PySparkException, match="several source rows update one target row"):
        merge(t, changing, specs.LOCATION, AS_OF, batch_small=batch_small).delta.collect()
