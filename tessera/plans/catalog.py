"""Registered queries (one per operator of the survey) and their oracle SQL.

Every query reads the driver tables through the fixture views, so its work
grows with the scale factor.  ``AS_OF`` is the fixed clock of every query, so
Spark and the oracle agree on the timestamps they write.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import prepared, replay
from tessera.operators.diff import SLOT_ARCHIVE_COLUMNS, SLOT_COLUMNS
from tessera.plans import entities, oracle, specs
from tessera.plans import staging_sql as stg
from tessera.session import ensure_checkpoint_dir
from tessera.sources import sinks
from tessera.sources.tables import oracle_with, register_fixtures
from tessera.streaming.microbatch import upsert_batch_with_patients

AS_OF = dt.datetime(2024, 1, 1, 0, 0, 0)
AS_OF_SQL = oracle.AS_OF_SQL
PURGE_TENANT = "T1"

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def _register(name: str, fn: QueryFn, sql: str | None) -> None:
    _QUERIES[name] = fn
    if sql is not None:
        _ORACLE[name] = sql


def _views(spark: SparkSession, sf_dir: str):
    register_fixtures(spark, sf_dir)
    return spark.table


# ------------------------------------------------------------------ reference-list merges


def _list_merge(name, upsert, spec: specs.MergeSpec, target: str, source: str, mode: str = "collapse", **how):
    def run(kind: str):
        def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
            v = _views(spark, sf_dir)
            r = upsert(v(target), v(source), as_of=AS_OF, mode=mode, **how)
            return r.snapshot if kind == "snapshot" else r.delta

        return fn

    name = name if mode == "collapse" else f"{name}_{mode}"
    prefix, src = oracle_with(target, source), f"SELECT * FROM {source}"
    _register(f"{name}_snapshot", run("snapshot"), oracle.merge_snapshot_sql(prefix, spec, target, src, mode))
    _register(f"{name}_delta", run("delta"), oracle.merge_delta_sql(prefix, spec, target, src, mode))


for _mode in ("collapse", "null_safe"):
    _list_merge("resource_upsert", entities.resource_upsert, specs.RESOURCE, "resource", "resource_in", _mode)
    _list_merge("location_upsert", entities.location_upsert, specs.LOCATION, "location", "location_in", _mode)
    _list_merge("provider_upsert", entities.provider_upsert, specs.PROVIDER, "provider", "provider_in", _mode)
    for _cols, _upsert in (
        (specs.INSURER_COLS, entities.insurer_upsert),
        (specs.APPOINTMENT_REASON_COLS, entities.appointment_reason_upsert),
        (specs.RECALL_REASON_COLS, entities.recall_reason_upsert),
    ):
        for _by in ("name", "id"):
            _spec, _table = specs.named_list(*_cols, _by), _cols[0]
            _list_merge(f"{_table}_upsert_by_{_by}", _upsert, _spec, _table, f"{_table}_in", _mode, match_by=_by)


# ------------------------------------------------------------------ soft deletes

_SOFT = {
    "appointment_block": ("appointment_block", "order_ids"),
    "appointment": ("appointment", "order_ids"),
    "patient": ("patient", "patient_ids"),
    "product_pickup": ("product_pickup", "order_ids"),
    "recall": ("recall", "order_ids"),
    "transaction": ("transaction_item", "transaction_ids"),
    "visit": ("visit", "order_ids"),
}


def _soft_delete(name: str, entity: str, target: str, ids: str) -> None:
    spec = specs.SOFT_DELETES[entity]

    def run(kind: str):
        def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
            v = _views(spark, sf_dir)
            r = entities.soft_delete(entity, v(target), v(ids), AS_OF)
            return r.snapshot if kind == "snapshot" else r.delta

        return fn

    prefix = oracle_with(target, ids)
    hit = (
        f"EXISTS (SELECT 1 FROM {ids} d WHERE d.PmsInstanceId = t.PmsInstanceId "
        f"AND trim(d.PmsId) = trim(t.{spec.key}))"
    )
    snap = (
        f"{prefix}\nSELECT * REPLACE (CASE WHEN {hit} THEN 1 ELSE Deleted END AS Deleted, "
        f"CASE WHEN {hit} THEN {AS_OF_SQL} ELSE UtcLastModifiedDate END AS UtcLastModifiedDate) FROM {target} t"
    )
    delta = (
        f"{prefix}\nSELECT d.PmsInstanceId AS PmsInstanceId, trim(d.PmsId) AS {spec.delta_key}, "
        f"{AS_OF_SQL} AS UtcCreatedDate, 3 AS ActionPerformed "
        f"FROM {ids} d JOIN {target} t ON d.PmsInstanceId = t.PmsInstanceId AND trim(d.PmsId) = trim(t.{spec.key})"
    )
    _register(f"{name}_mark_deleted_snapshot", run("snapshot"), snap)
    _register(f"{name}_mark_deleted_delta", run("delta"), delta)


for _name, (_target, _ids) in _SOFT.items():
    _soft_delete(_name, _target, _target, _ids)


# ------------------------------------------------------------------ staging


_STAGE_ARGS = {
    "appointment_block": (entities.stage_appointment_block, "appointment_block_in", "location", "provider", "resource"),
    "appointment": (
        entities.stage_appointment, "appointment_in", "location", "provider", "patient", "appointment_reason"
    ),
    "patient": (entities.stage_patient, "patient_wide_in", "location", "provider", "insurer"),
    "product_pickup": (entities.stage_product_pickup, "product_pickup_in", "location", "provider", "patient"),
    "recall": (entities.stage_recall, "recall_in", "location", "provider", "patient", "recall_reason"),
    "visit": (entities.stage_visit, "visit_in", "location", "provider", "patient"),
}


def _staged(spark: SparkSession, sf_dir: str, entity: str) -> tuple[DataFrame, bool, DataFrame]:
    """Staged batch of ``entity``, whether the raw batch is under the broadcast bound, the raw batch."""
    v = _views(spark, sf_dir)
    fn, inp, *dims = _STAGE_ARGS[entity]
    raw = v(inp)
    small = entities.batch_is_small(raw)
    return fn(raw, *[v(d) for d in dims], batch_small=small), small, raw


def _stage(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return _staged(spark, sf_dir, entity)[0]


for _e in stg.SQL:
    _register(
        f"{_e}_staged",
        (lambda e: lambda spark, sf_dir: _stage(spark, sf_dir, e))(_e),
        f"{oracle_with(*stg.VIEWS[_e])}\n{stg.SQL[_e]}",
    )


# ------------------------------------------------------------------ staged fact merges

_FACT = {
    "appointment_block": (entities.appointment_block_upsert, specs.APPOINTMENT_BLOCK, "appointment_block"),
    "appointment": (entities.appointment_upsert, specs.APPOINTMENT, "appointment"),
    "patient": (entities.patient_upsert, specs.PATIENT, "patient_wide"),
    "product_pickup": (entities.product_pickup_upsert, specs.PRODUCT_PICKUP, "product_pickup"),
    "recall": (entities.recall_upsert, specs.RECALL, "recall"),
    "visit": (entities.visit_upsert, specs.VISIT, "visit"),
}


def _fact_merge(entity: str, mode: str = "collapse", infix: str = "", src: str | None = None, **how) -> None:
    upsert, spec, target = _FACT[entity]
    _, inp, *dims = _STAGE_ARGS[entity]

    def run(kind: str):
        def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
            v = _views(spark, sf_dir)
            r = upsert(v(target), v(inp), *[v(d) for d in dims], as_of=AS_OF, mode=mode, **how)
            r = r[0] if isinstance(r, tuple) else r  # pickups and visits return the patients too
            return r.snapshot if kind == "snapshot" else r.delta

        return fn

    name = f"{entity}_upsert{infix}" if mode == "collapse" else f"{entity}_upsert{infix}_{mode}"
    prefix = oracle_with(target, *(stg.VIEWS[entity] if src is None else (inp,)))
    src = src or stg.SQL[entity]
    _register(f"{name}_snapshot", run("snapshot"), oracle.merge_snapshot_sql(prefix, spec, target, src, mode))
    _register(f"{name}_delta", run("delta"), oracle.merge_delta_sql(prefix, spec, target, src, mode))


for _mode in ("collapse", "null_safe"):  # null_safe compares every fingerprint operand on its own
    for _e in ("appointment_block", "appointment", "patient", "product_pickup", "recall"):
        _fact_merge(_e, _mode)
    _fact_merge("visit", _mode, src="SELECT * FROM visit_in")  # raw input, as the reference
    _fact_merge("visit", _mode, infix="_staged", use_staged=True)


# ------------------------------------------------------------------ rollups into patient


def _rollup(name: str, entity: str, lens: bool, exam: bool, public: str | None = None) -> None:
    from tessera.operators.rollup import apply_patient_facts, patient_facts

    def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = _views(spark, sf_dir)
        upsert, _, target = _FACT[entity]
        _, inp, *dims = _STAGE_ARGS[entity]
        return upsert(v(target), v(inp), *[v(d) for d in dims], as_of=AS_OF)[1]

    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged, small, _ = _staged(spark, sf_dir, entity)
        return apply_patient_facts(spark.table("patient"), patient_facts(staged, lens, exam), AS_OF, batch_small=small)

    lens_sql = (
        "EXISTS (SELECT 1 FROM st WHERE st.PmsInstanceId = p.PmsInstanceId "
        "AND trim(st.PmsPatientId) = trim(p.PmsPatientId) "
        "AND trim(st.ProductType) = 'Contact Lenses')"
        if lens else "FALSE"
    )
    exam_sql = (
        "(SELECT max(st.VisitDate) FROM st WHERE st.PmsInstanceId = p.PmsInstanceId "
        "AND trim(st.PmsPatientId) = trim(p.PmsPatientId) AND trim(st.VisitType) = 'Exam' AND st.VisitDate IS NOT NULL)"
        if exam else "CAST(NULL AS TIMESTAMP)"
    )
    advance = "coalesce(_exam > LastVisitOrExamDate, FALSE)"
    replace = (
        f"CASE WHEN _lens THEN 'Y' ELSE ContactLensWearer END AS ContactLensWearer, "
        f"CASE WHEN {advance} THEN _exam ELSE LastVisitOrExamDate END AS LastVisitOrExamDate, "
        f"CASE WHEN _lens OR {advance} THEN {AS_OF_SQL} ELSE UtcLastModifiedDate END AS UtcLastModifiedDate"
    )
    sql = (
        f"{oracle_with('patient', *stg.VIEWS[entity])},\nst AS ({stg.SQL[entity]}),\n"
        f"f AS (SELECT p.*, {lens_sql} AS _lens, {exam_sql} AS _exam FROM patient p)\n"
        f"SELECT * EXCLUDE (_lens, _exam) REPLACE ({replace}) FROM f"
    )
    _register(name, fn, sql)
    if public:  # the patients as the entity's upsert returns them
        _register(public, whole, sql)


_rollup("lens_wearer_rollup", "visit", lens=True, exam=False)
_rollup("last_exam_rollup", "visit", lens=False, exam=True)
_rollup("visit_patient_rollup", "visit", lens=True, exam=True, public="visit_upsert_patient")
_rollup("product_pickup_lens_rollup", "product_pickup", lens=True, exam=False, public="product_pickup_upsert_patient")


# ------------------------------------------------------------------ slots

_SLOT_COLS = ", ".join(SLOT_COLUMNS)
_SLOT_KEY_SQL = (
    "{a}.PmsInstanceId = {b}.PmsInstanceId AND rtrim({a}.PmsLocationId) = rtrim({b}.PmsLocationId) "
    "AND rtrim({a}.PmsProviderId) = rtrim({b}.PmsProviderId) AND {a}.StartDateTime = {b}.StartDateTime "
    "AND {a}.Length = {b}.Length AND {a}.SwimLanes = {b}.SwimLanes"
)
_SLOT_FP = " || ".join(
    f"(trim(CAST({{x}}.{c} AS STRING)))"
    for c in ("PmsLocationId", "PmsProviderId", "PmsResourceId", "PmsAltLocationId", "StartDateTime", "Length",
              "SlotType", "SwimLanes", "SlotInfo")
)
_SLOT_INS = (
    f"SELECT {_SLOT_COLS}, 1 AS ActionPerformed FROM slot c "
    f"WHERE NOT EXISTS (SELECT 1 FROM slot_cleared p WHERE {_SLOT_KEY_SQL.format(a='c', b='p')})"
)
_SLOT_MOD = (
    f"SELECT {', '.join('c.' + x for x in SLOT_COLUMNS)}, 2 AS ActionPerformed FROM slot c JOIN slot_cleared p "
    f"ON {_SLOT_KEY_SQL.format(a='c', b='p')} "
    f"WHERE ({_SLOT_FP.format(x='c')}) IS DISTINCT FROM ({_SLOT_FP.format(x='p')})"
)
_SLOT_DEL = (
    f"SELECT {_SLOT_COLS}, 3 AS ActionPerformed FROM slot_cleared p "
    f"WHERE NOT EXISTS (SELECT 1 FROM slot c WHERE {_SLOT_KEY_SQL.format(a='c', b='p')})"
)


def _slot_diff(action: int | None):
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = _views(spark, sf_dir)
        d = entities.availability_slot_compare(v("slot"), v("slot_cleared"))
        return d if action is None else d.filter(F.col("ActionPerformed") == action)

    return fn


_sp = oracle_with("slot", "slot_cleared")
_register("slot_diff", _slot_diff(None), f"{_sp}\n{_SLOT_INS}\nUNION ALL {_SLOT_MOD}\nUNION ALL {_SLOT_DEL}")
_register("slot_diff_inserted", _slot_diff(1), f"{_sp}\n{_SLOT_INS}")
_register("slot_diff_modified", _slot_diff(2), f"{_sp}\n{_SLOT_MOD}")
_register("slot_diff_deleted", _slot_diff(3), f"{_sp}\n{_SLOT_DEL}")


def _slot_delete(kind: str):
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = _views(spark, sf_dir)
        r = entities.availability_slot_mark_deleted(v("slot_all"), v("slot_ids"), AS_OF)
        return r.snapshot if kind == "snapshot" else r.delta

    return fn


_sd = oracle_with("slot_all", "slot_ids")
_SLOT_ID_KEY = (
    "d.PmsInstanceId = s.PmsInstanceId AND rtrim(d.PmsLocationId) = rtrim(s.PmsLocationId) "
    "AND rtrim(d.PmsProviderId) = rtrim(s.PmsProviderId) AND d.Length = s.Length AND d.SwimLanes = s.SwimLanes"
)
_register(
    "slot_mark_deleted_snapshot",
    _slot_delete("snapshot"),
    f"{_sd}\nSELECT s.* FROM slot_all s WHERE NOT EXISTS (SELECT 1 FROM slot_ids d WHERE {_SLOT_ID_KEY})",
)
_register(
    "slot_mark_deleted_delta",
    _slot_delete("delta"),
    f"{_sd}\nSELECT s.PmsInstanceId, trim(s.PmsLocationId) AS PmsLocationId, trim(s.PmsProviderId) AS PmsProviderId, "
    f"s.StartDateTime, s.Length, s.SwimLanes, {AS_OF_SQL} AS UtcCreatedDate, 3 AS ActionPerformed "
    f"FROM slot_all s JOIN slot_ids d ON {_SLOT_ID_KEY}",
)


# ------------------------------------------------------------------ tenant purge


def _purge(kind: str, table: str, name: str):
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = _views(spark, sf_dir)
        r = entities.batch_delete_tenant(v(table), PURGE_TENANT, name, AS_OF)
        return {"kept": r.kept, "delta": r.delta, "archive": r.archive, "report": r.report}[kind]

    return fn


_pv, _ps = oracle_with("visit_all"), oracle_with("slot_all")
_KEPT_SQL = f"{_pv}\nSELECT * FROM visit_all WHERE PmsInstanceId IS DISTINCT FROM '{PURGE_TENANT}'"
_register("purge_kept", _purge("kept", "visit_all", "visit"), _KEPT_SQL)
_register(
    "purge_delta", _purge("delta", "visit_all", "visit"),
    f"{_pv}\nSELECT PmsInstanceId, {AS_OF_SQL} AS UtcCreatedDate, 3 AS ActionPerformed FROM visit_all "
    f"WHERE PmsInstanceId = '{PURGE_TENANT}'",
)
_register(
    "purge_slot_archive", _purge("archive", "slot_all", "availability_slot"),
    f"{_ps}\nSELECT {', '.join(SLOT_ARCHIVE_COLUMNS)} FROM slot_all WHERE PmsInstanceId = '{PURGE_TENANT}'",
)
_register(
    "purge_report", _purge("report", "visit_all", "visit"),
    f"{_pv}\nSELECT 'visit' AS table_name, count(*) AS rows_deleted, "
    f"CAST(floor(count(*) / 1000) + 1 AS BIGINT) AS iterations FROM visit_all WHERE PmsInstanceId = '{PURGE_TENANT}'",
)


# ------------------------------------------------------------------ published tables, read back


def _published_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _published_slot_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slots after a published delete batch, as the table's readers see them."""
    v = _views(spark, sf_dir)
    path = _published_path(spark, "slots")
    sinks.create_snapshot(spark, v("slot_all"), path)
    ids = v("slot_ids")

    def change(slots: DataFrame) -> tuple[DataFrame, DataFrame]:
        r = entities.availability_slot_mark_deleted(slots, ids, AS_OF)
        return r.snapshot, r.delta

    sinks.publish(spark, path, 0, ids, change, f"{path}-delta")
    return sinks.read_snapshot(spark, path)


def _published_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visits after a published purge; the tenant is named in the other letter case."""
    path = _published_path(spark, "visits")
    sinks.create_snapshot(spark, _views(spark, sf_dir)("visit_all"), path)
    sinks.publish_purge(spark, path, PURGE_TENANT.lower(), 0)
    return sinks.read_snapshot(spark, path)


def _published_purge_swept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left on the disk after a purge and a sweep: every file under the table's data folder."""
    path = _published_path(spark, "visits")
    visits = _views(spark, sf_dir)("visit_all")
    sinks.create_snapshot(spark, visits, path, key=F.trim(F.col("PmsVisitId")), buckets=4)
    sinks.publish_purge(spark, path, PURGE_TENANT, 0)
    sinks.sweep(spark, path, keep=1)
    return spark.read.schema(visits.schema).option("recursiveFileLookup", "true").parquet(f"{path}/data")


def _published_in_two(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The slots after two delete batches; the feed has their rows in two commits."""
    v = _views(spark, sf_dir)
    path = _published_path(spark, "slots")
    sinks.create_snapshot(spark, v("slot_all"), path)
    odd = F.col("Length") % 2 == 1
    for batch_id, ids in enumerate((v("slot_ids").filter(odd), v("slot_ids").filter(~F.coalesce(odd, F.lit(False))))):

        def change(slots: DataFrame, ids: DataFrame = ids) -> tuple[DataFrame, DataFrame]:
            r = entities.availability_slot_mark_deleted(slots, ids, AS_OF)
            return r.snapshot, r.delta

        sinks.publish(spark, path, batch_id, ids, change, f"{path}-delta")
    return path, f"{path}-delta"


def _published_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole change feed of two published batches, one scan."""
    return sinks.read_delta(spark, *_published_in_two(spark, sf_dir)).drop("batch_id", "run_id")


def _resumed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed as a consumer sees that read up to the first batch, and later on from there."""
    path, feed = _published_in_two(spark, sf_dir)
    seen = sinks.latest_commit(spark, path) - 1
    first, rest = sinks.read_feed(spark, path, feed, upto=seen), sinks.read_feed(spark, path, feed, after=seen)
    return first.withColumn("reading", F.lit(1)).unionByName(rest.withColumn("reading", F.lit(2))).drop("batch_id", "run_id")


def _published_with_patients(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the two tables after visits were published with their patients in one commit."""
    v = _views(spark, sf_dir)
    path = _published_path(spark, "practice")
    sinks.create_snapshot(spark, v("visit"), path, key=F.trim(F.col("PmsVisitId")), buckets=2, name="visit")
    sinks.create_snapshot(spark, v("patient"), path, key=F.trim(F.col("PmsPatientId")), buckets=2, name="patient")

    def merged(visits: DataFrame, batch: DataFrame, patients: DataFrame, clock: dt.datetime):
        return entities.visit_upsert(visits, batch, v("location"), v("provider"), patients, clock, settle=True)

    upsert_batch_with_patients(
        spark, v("visit_in"), 0, merged, path, "visit", f"{path}-delta", AS_OF,
        key=F.trim(F.col("PmsVisitId")), buckets=2, patient_buckets=2,
    )
    return sinks.read_snapshot(spark, path, name=name)


_register("published_slot_delete_snapshot", _published_slot_delete, _ORACLE["slot_mark_deleted_snapshot"])
_register("published_purge_kept", _published_purge, _KEPT_SQL)
_register("published_purge_swept", _published_purge_swept, _KEPT_SQL)
_register("published_feed_delta", _published_feed, _ORACLE["slot_mark_deleted_delta"])
_register(
    "published_feed_resumed", _resumed_feed,
    f"{_sd}\nSELECT s.PmsInstanceId, trim(s.PmsLocationId) AS PmsLocationId, trim(s.PmsProviderId) AS PmsProviderId, "
    f"s.StartDateTime, s.Length, s.SwimLanes, {AS_OF_SQL} AS UtcCreatedDate, 3 AS ActionPerformed, "
    f"CASE WHEN s.Length % 2 = 1 THEN 1 ELSE 2 END AS reading FROM slot_all s JOIN slot_ids d ON {_SLOT_ID_KEY}",
)
_register(
    "published_visit_patient", lambda spark, sf_dir: _published_with_patients(spark, sf_dir, "patient"), _ORACLE["visit_patient_rollup"]
)
_register(
    "published_visit_snapshot", lambda spark, sf_dir: _published_with_patients(spark, sf_dir, "visit"), _ORACLE["visit_upsert_snapshot"]
)


# ------------------------------------------------------------------ replayed feeds, prepared targets


def _replayed(entity: str) -> QueryFn:
    """The old snapshot brought up to date by the feeds of two batches, and by nothing else."""

    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = _views(spark, sf_dir)
        upsert, spec, target = _FACT[entity]
        _, inp, *dims = _STAGE_ARGS[entity]
        half = F.pmod(F.xxhash64(F.trim(spec.key)), F.lit(2))
        state, feed = v(target), None
        for order in (0, 1):
            batch = v(inp).filter(half == order)
            r = upsert(state, batch, *[v(d) for d in dims], as_of=AS_OF, settle=True, changed_columns=True)
            changes = r.changes.withColumn(replay.ORDER, F.lit(order))
            feed = changes if feed is None else feed.unionByName(changes)
            state = r.snapshot
        return replay.replay(v(target), feed, spec)

    return fn


for _e in ("appointment", "patient"):
    _register(f"{_e}_feed_replayed", _replayed(_e), _ORACLE[f"{_e}_upsert_snapshot"])


def _prepared(entity: str, kind: str, mode: str) -> QueryFn:
    """The upsert against a target with stored match keys and print: narrow match, then the changed rows."""

    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = _views(spark, sf_dir)
        upsert, spec, target = _FACT[entity]
        _, inp, *dims = _STAGE_ARGS[entity]
        ready = prepared.prepare(v(target), spec, mode)
        r = upsert(ready, v(inp), *[v(d) for d in dims], as_of=AS_OF, mode=mode, stored_print=True, stored_keys=True)
        return r.snapshot.drop(prepared.PRINT, *prepared.KEYS) if kind == "snapshot" else r.delta

    return fn


for _e, _kind, _mode in (("appointment", "delta", "collapse"), ("patient", "snapshot", "collapse"), ("patient", "delta", "null_safe")):
    _suffix = "" if _mode == "collapse" else f"_{_mode}"
    _register(f"{_e}_prepared_{_kind}{_suffix}", _prepared(_e, _kind, _mode), _ORACLE[f"{_e}_upsert{_suffix}_{_kind}"])


# ------------------------------------------------------------------ ambiguous batches


def _conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch rows of every key that several rows of the batch would update in one target row."""
    v = _views(spark, sf_dir)
    batch = v("resource_in")
    again = batch.filter(F.length(F.trim("ResourceName")) % 2 == 0)
    again = again.withColumn("ResourceName", F.concat(F.trim("ResourceName"), F.lit("!")))
    result = entities.resource_upsert(v("resource"), batch.unionByName(again), as_of=AS_OF, on_conflict="report")
    return result.conflicts


_register(
    "merge_conflicts", _conflicts,
    f"""{oracle_with("resource", "resource_in")},
b AS (SELECT * FROM resource_in UNION ALL
      SELECT * REPLACE (trim(ResourceName) || '!' AS ResourceName) FROM resource_in WHERE length(trim(ResourceName)) % 2 = 0),
u AS (SELECT lower(t.PmsInstanceId) AS i, trim(t.PmsResourceId) AS k,
      (SELECT count(*) FROM b WHERE lower(b.PmsInstanceId) = lower(t.PmsInstanceId)
       AND trim(b.PmsResourceId) = trim(t.PmsResourceId) AND trim(b.ResourceName) IS DISTINCT FROM trim(t.ResourceName)) AS n
      FROM resource t)
SELECT b.*, g.n_targets FROM b JOIN (SELECT i, k, count(*) AS n_targets FROM u WHERE n > 1 GROUP BY i, k) g
ON lower(b.PmsInstanceId) = g.i AND trim(b.PmsResourceId) = g.k""",
)


# ------------------------------------------------------------------ match keys under a collation


def _mixed_case_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appointment reasons matched by name without letter case; every other name of the batch is in capitals."""
    v = _views(spark, sf_dir)
    odd = F.length(F.trim("ReasonName")) % 2 == 1
    batch = v("appointment_reason_in").withColumn("ReasonName", F.when(odd, F.upper("ReasonName")).otherwise(F.lower("ReasonName")))
    result = entities.appointment_reason_upsert(
        v("appointment_reason"), batch, match_by="name", as_of=AS_OF, key_collation="UTF8_LCASE_RTRIM"
    )
    return result.delta


_register(
    "mixed_case_name_upsert_delta", _mixed_case_names,
    f"""{oracle_with("appointment_reason", "appointment_reason_in")},
b AS (SELECT * REPLACE (CASE WHEN length(trim(ReasonName)) % 2 = 1 THEN upper(ReasonName) ELSE lower(ReasonName) END AS ReasonName)
      FROM appointment_reason_in),
j AS (SELECT b.PmsInstanceId, trim(b.PmsReasonId) AS PmsReasonId,
      CASE WHEN t.PmsInstanceId IS NULL THEN 1
           WHEN trim(b.PmsReasonId) || trim(b.ReasonName) IS DISTINCT FROM trim(t.PmsReasonId) || trim(t.ReasonName) THEN 2
      END AS ActionPerformed
      FROM b LEFT JOIN appointment_reason t
      ON lower(t.PmsInstanceId) = lower(b.PmsInstanceId) AND lower(trim(t.ReasonName)) = lower(trim(b.ReasonName)))
SELECT PmsInstanceId, PmsReasonId, {AS_OF_SQL} AS UtcCreatedDate, ActionPerformed FROM j
WHERE ActionPerformed IS NOT NULL""",
)


# ------------------------------------------------------------------ tenant ids in mixed letter case


def _mixed_case_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resource batch with every other tenant id in lower case: the same rows match."""
    v = _views(spark, sf_dir)
    odd = F.length(F.trim("PmsResourceId")) % 2 == 1
    batch = v("resource_in").withColumn(specs.TENANT, F.when(odd, F.lower(specs.TENANT)).otherwise(F.col(specs.TENANT)))
    return entities.resource_upsert(v("resource"), batch, as_of=AS_OF).delta


# Written from the rules, not from the spec: trimmed keys, tenant ids without letter case, the name as fingerprint.
_register(
    "mixed_case_tenant_upsert_delta", _mixed_case_upsert,
    f"""{oracle_with("resource", "resource_in")},
b AS (SELECT * REPLACE (CASE WHEN length(trim(PmsResourceId)) % 2 = 1 THEN lower(PmsInstanceId) ELSE PmsInstanceId END
      AS PmsInstanceId) FROM resource_in),
j AS (SELECT b.PmsInstanceId, trim(b.PmsResourceId) AS PmsResourceId,
      CASE WHEN t.PmsResourceId IS NULL THEN 1
           WHEN trim(b.ResourceName) IS DISTINCT FROM trim(t.ResourceName) THEN 2 END AS ActionPerformed
      FROM b LEFT JOIN resource t ON lower(t.PmsInstanceId) = lower(b.PmsInstanceId)
      AND trim(t.PmsResourceId) = trim(b.PmsResourceId))
SELECT PmsInstanceId, PmsResourceId, {AS_OF_SQL} AS UtcCreatedDate, ActionPerformed FROM j
WHERE ActionPerformed IS NOT NULL""",
)


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
