"""Merges against SQL written from the procedures' rules, not from the specs: visits, pickups, recalls, blocks."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import FIXTURE_BASE_TABLES, oracle_with
from tests.util import canon

NOW = "TIMESTAMP '2024-01-01 00:00:00'"
#: Operands of the change test, in the order of the statement.
OPERANDS = (
    "PmsLocationId PmsProviderId PmsPatientId PmsAppointmentId VisitDate VisitType VisitReason ShowedUp ICD1 ICD2 ICD3 "
    "CPT1 CPT2 CPT3 ProductType ProductBrand1 ProductBrand2 ProductBrand3 SpendAmt Deleted"
).split()
REFERENCES = ("PmsPatientId", "PmsLocationId", "PmsProviderId")
TRIMMED = (
    "PmsAppointmentId VisitType VisitReason ICD1 ICD2 ICD3 CPT1 CPT2 CPT3 ProductType ProductBrand1 ProductBrand2 ProductBrand3"
).split()
PLAIN = ("ShowedUp", "SpendAmt", "Deleted", "PmsCreatedDate", "PmsLastModifiedDate")


def _text(side):
    # one NULL operand makes the whole text NULL, and two NULL texts are equal
    return " || ".join(f"trim(CAST({side}.{c} AS VARCHAR))" for c in OPERANDS)


def _new():
    refs = [f"coalesce(trim(s.{c}), '0') AS {c}" for c in REFERENCES]
    return refs + [f"trim(s.{c}) AS {c}" for c in TRIMMED] + [f"s.{c} AS {c}" for c in PLAIN]


def _sql():
    rest = ", ".join(_new())
    joined = "lower(t.PmsInstanceId) = lower(s.PmsInstanceId) AND trim(t.PmsVisitId) = trim(s.PmsVisitId)"
    changed = f"({_text('s')}) IS DISTINCT FROM ({_text('t')})"
    later = "CASE WHEN s.VisitDate > t.VisitDate THEN s.VisitDate ELSE t.VisitDate END AS VisitDate"
    names = ", ".join(["PmsInstanceId", "PmsVisitId", "VisitDate", *REFERENCES, *TRIMMED, *PLAIN, "UtcCreatedDate", "UtcLastModifiedDate"])
    return f"""{oracle_with("visit", "visit_in")},
updated AS (SELECT t.PmsInstanceId, t.PmsVisitId, {later}, {rest}, t.UtcCreatedDate, {NOW} AS UtcLastModifiedDate
            FROM visit t JOIN visit_in s ON {joined} WHERE {changed}),
inserted AS (SELECT s.PmsInstanceId, trim(s.PmsVisitId) AS PmsVisitId, s.VisitDate, {rest}, {NOW} AS UtcCreatedDate,
             {NOW} AS UtcLastModifiedDate FROM visit_in s WHERE NOT EXISTS (SELECT 1 FROM visit t WHERE {joined})),
kept AS (SELECT t.* FROM visit t WHERE NOT EXISTS (SELECT 1 FROM visit_in s WHERE {joined} AND {changed}))
SELECT {names} FROM updated UNION ALL SELECT {names} FROM inserted UNION ALL SELECT {names} FROM kept"""


def test_visit_snapshot_follows_the_rules(spark, sf_dir):
    con = duckdb.connect()
    for t in FIXTURE_BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    df = E.queries()["visit_upsert_snapshot"](spark, sf_dir)
    res = con.execute(_sql())
    cols = [d[0] for d in res.description]
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, res.fetchall())


# ------------------------------------------------------------------ pickups, recalls and blocks, staging included


def _merged(views, staged, target, key, operands, insert, update, kind):
    """Snapshot or feed of a merge whose staging, operands and column rules are given as SQL."""
    joined = f"lower(t.PmsInstanceId) = lower(s.PmsInstanceId) AND trim(t.{key}) = trim(s.{key})"
    text = lambda side: " || ".join(f"trim(CAST({side}.{c} AS VARCHAR))" for c in operands)
    changed = f"({text('s')}) IS DISTINCT FROM ({text('t')})"
    missing = f"NOT EXISTS (SELECT 1 FROM {target} t WHERE {joined})"
    ctes = f"{oracle_with(*views)},\nst AS ({staged})"
    if kind == "delta":
        row = f"s.PmsInstanceId, trim(s.{key}) AS {key}, {NOW} AS UtcCreatedDate"
        return (
            f"{ctes}\nSELECT {row}, 1 AS ActionPerformed FROM st s WHERE {missing} "
            f"UNION ALL SELECT {row}, 2 AS ActionPerformed FROM st s JOIN {target} t ON {joined} WHERE {changed}"
        )
    names = ["PmsInstanceId", key, *insert, "UtcCreatedDate", "UtcLastModifiedDate"]
    cols = ", ".join(names)
    new = ", ".join(f"{rule} AS {c}" for c, rule in insert.items())
    old = ", ".join(f"{rule} AS {c}" for c, rule in {**insert, **update}.items())
    own = update.get(key, f"t.{key}")
    return f"""{ctes},
updated AS (SELECT t.PmsInstanceId, {own} AS _k, {old.replace(f"{own} AS {key}, ", "").replace(f", {own} AS {key}", "")},
            t.UtcCreatedDate, {NOW} AS UtcLastModifiedDate FROM {target} t JOIN st s ON {joined} WHERE {changed}),
inserted AS (SELECT s.PmsInstanceId, trim(s.{key}) AS {key}, {new}, {NOW} AS UtcCreatedDate, {NOW} AS UtcLastModifiedDate
             FROM st s WHERE {missing}),
kept AS (SELECT t.* FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM st s WHERE {joined} AND {changed}))
SELECT {cols.replace(f" {key},", f" _k AS {key},", 1)} FROM updated UNION ALL SELECT {cols} FROM inserted UNION ALL SELECT {cols} FROM kept"""


def _fallback(column, looked_up):
    return f"CASE WHEN coalesce(trim(i.{column}), '') = '' THEN trim(pat.{column}) ELSE trim({looked_up}.{column}) END AS {column}"


def _left(table, alias, column, equal):
    return f"LEFT JOIN {table} {alias} ON {equal}({alias}.{column}) = {equal}(i.{column}) AND lower({alias}.PmsInstanceId) = lower(i.PmsInstanceId)"


def _zero(column, how="trim({})"):
    return f"coalesce({how.format('s.' + column)}, '0')"


_DATES = ("OrderDate", "ReceivedDate", "NotifiedDate", "PickedUpDate", "SpendAmt", "PricedDate", "StatusChangedDate", "Deleted",
          "PmsCreatedDate", "PmsLastModifiedDate")
_TEXTS = ("ProductType", "ProductBrand1", "ProductBrand2", "ProductBrand3", "OrderStatus")
_IDS = ("PmsPatientId", "PmsLocationId", "PmsProviderId")


def _pickup(kind):
    # looked up by the raw ids (trailing blanks do not count), the patient's own where location or provider is blank
    staged = (
        f"SELECT i.* REPLACE (pat.PmsPatientId AS PmsPatientId, {_fallback('PmsLocationId', 'loc')}, {_fallback('PmsProviderId', 'prov')}) "
        f"FROM product_pickup_in i {_left('location', 'loc', 'PmsLocationId', 'rtrim')} "
        f"{_left('provider', 'prov', 'PmsProviderId', 'rtrim')} {_left('patient', 'pat', 'PmsPatientId', 'rtrim')}"
    )
    insert = {c: _zero(c, "{}") for c in _IDS} | {c: f"trim(s.{c})" for c in _TEXTS} | {c: f"s.{c}" for c in _DATES}
    operands = (
        "PmsOrderId PmsPatientId PmsLocationId PmsProviderId OrderDate ReceivedDate NotifiedDate PickedUpDate ProductType ProductBrand1 "
        "ProductBrand2 ProductBrand3 SpendAmt OrderStatus PricedDate StatusChangedDate Deleted"
    ).split()
    views = ("product_pickup", "product_pickup_in", "location", "provider", "patient")
    update = {c: _zero(c) for c in _IDS} | {"PmsOrderId": "trim(s.PmsOrderId)"}
    return _merged(views, staged, "product_pickup", "PmsOrderId", operands, insert, update, kind)


def _recall(kind):
    # trimmed lookups; the reason by its name when no id is given
    by = lambda c: (
        f"(SELECT r.PmsRecallReasonId FROM recall_reason r WHERE trim(r.{c}) = trim(i.{c}) AND lower(r.PmsInstanceId) = lower(i.PmsInstanceId))"
    )
    staged = (
        f"SELECT i.* REPLACE (pat.PmsPatientId AS PmsPatientId, {_fallback('PmsLocationId', 'loc')}, {_fallback('PmsProviderId', 'prov')}), "
        f"CASE WHEN coalesce(trim(i.PmsRecallReasonId), '') = '' THEN {by('ReasonName')} ELSE {by('PmsRecallReasonId')} END AS RecallReasonId "
        f"FROM recall_in i {_left('location', 'loc', 'PmsLocationId', 'trim')} "
        f"{_left('provider', 'prov', 'PmsProviderId', 'trim')} {_left('patient', 'pat', 'PmsPatientId', 'trim')}"
    )
    insert = {c: _zero(c) for c in _IDS} | {"RecallDate": "s.RecallDate", "RecallReasonId": _zero("RecallReasonId", "{}"), "Deleted": "s.Deleted"}
    operands = ("PmsPatientId", "PmsLocationId", "PmsProviderId", "RecallDate", "RecallReasonId", "Deleted")
    views = ("recall", "recall_in", "recall_reason", "location", "provider", "patient")
    return _merged(views, staged, "recall", "PmsRecallId", operands, insert, {}, kind)


def _block(kind):
    # trimmed lookups, '0' where nothing is found
    found = ", ".join(f"coalesce({a}.{c}, '0') AS {c}" for a, c in (("loc", "PmsLocationId"), ("prov", "PmsProviderId"), ("res", "PmsResourceId")))
    staged = (
        f"SELECT i.* REPLACE ({found}) FROM appointment_block_in i {_left('location', 'loc', 'PmsLocationId', 'trim')} "
        f"{_left('provider', 'prov', 'PmsProviderId', 'trim')} {_left('resource', 'res', 'PmsResourceId', 'trim')}"
    )
    insert = {c: _zero(c) for c in ("PmsLocationId", "PmsProviderId", "PmsResourceId")}
    insert |= {c: f"s.{c}" for c in ("StartDate", "StartTime", "Length", "Deleted")}
    operands = ("Length", "PmsLocationId", "PmsProviderId", "PmsResourceId", "StartDate", "StartTime", "Deleted")
    views = ("appointment_block", "appointment_block_in", "location", "provider", "resource")
    return _merged(views, staged, "appointment_block", "PmsAppointmentId", operands, insert, {}, kind)


@pytest.mark.parametrize("kind", ["snapshot", "delta"])
@pytest.mark.parametrize("entity, sql", [("product_pickup", _pickup), ("recall", _recall), ("appointment_block", _block)])
def test_staged_merges_follow_the_rules(spark, sf_dir, entity, sql, kind):
    con = duckdb.connect()
    for t in FIXTURE_BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    df = E.queries()[f"{entity}_upsert_{kind}"](spark, sf_dir)
    res = con.execute(sql(kind))
    cols = [d[0] for d in res.description]
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, res.fetchall())
