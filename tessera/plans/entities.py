"""The reference's 22 procedures as DataFrame functions.

Each ``*_upsert`` stages its input (reference resolution), then merges it into
the entity snapshot and returns ``MergeResult(snapshot, delta, classified)``.
Staging functions are public so they can be checked on their own.  DataFrames
in, DataFrames out; publishing is in ``tessera.sources.sinks``.  The staged batch
is written once to the shared checkpoint folder, since it feeds the inserts, the
updates and the change feed.

Table arguments are snapshot DataFrames (``location``, ``provider``, ...); the
input batch is ``inp``.  ``as_of`` is the call's clock, ``mode`` the fingerprint
comparison; ``options`` go to :func:`tessera.operators.merge.merge`
(``collation``, ``time_resolution``, ``max_broadcast_rows``, ``key_collation``, ``settle``,
``split_hot_keys``, ``on_conflict``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import is_blank
from tessera.operators.diff import slot_mark_deleted, snapshot_diff
from tessera.operators.broadcast import keys_are_small
from tessera.operators.merge import MergeResult, merge
from tessera.operators.purge import PurgeResult, purge_tenant
from tessera.operators.resolve import lookup, one_row, scalar_lookup
from tessera.operators.rollup import apply_patient_facts, patient_facts
from tessera.operators.softdelete import mark_deleted
from tessera.operators.staged import written_once
from tessera.plans import specs
from tessera.plans.specs import TENANT

I = TENANT


# ------------------------------------------------------------------ staging


def batch_is_small(inp: DataFrame, known: bool | None = None, max_rows: int | None = None) -> bool:
    """One size check of the raw batch per call (rows, and bytes of its ids) decides the plan shape."""
    ids = [c for c in inp.columns if c.startswith("Pms") and c.endswith("Id")]
    return known if known is not None else keys_are_small(inp, max_rows, ids)


def stage_appointment_block(
    inp: DataFrame,
    location: DataFrame,
    provider: DataFrame,
    resource: DataFrame,
    batch_small: bool | None = None,
    key_collation: str | None = None,
) -> DataFrame:
    """Three trimmed lookups; unresolved references become ``'0'``."""
    del batch_small  # no lookup into a table that grows with the data
    df = lookup(inp, location, "PmsLocationId", "PmsLocationId", {"PmsLocationId": "_loc"}, key_collation=key_collation)
    df = lookup(df, provider, "PmsProviderId", "PmsProviderId", {"PmsProviderId": "_prov"}, key_collation=key_collation)
    df = lookup(df, resource, "PmsResourceId", "PmsResourceId", {"PmsResourceId": "_res"}, key_collation=key_collation)
    return df.select(
        I, "PmsAppointmentId",
        F.coalesce("_loc", F.lit("0")).alias("PmsLocationId"),
        F.coalesce("_prov", F.lit("0")).alias("PmsProviderId"),
        F.coalesce("_res", F.lit("0")).alias("PmsResourceId"),
        "StartDate", "StartTime", "Length", "Deleted",
    )


def stage_appointment(
    inp: DataFrame,
    location: DataFrame,
    provider: DataFrame,
    patient: DataFrame,
    reason: DataFrame,
    batch_small: bool | None = None,
    key_collation: str | None = None,
) -> DataFrame:
    """Trimmed lookups (default ``'0'``), raw resource id, reason by id when given else by name.

    The reference also joins ``Resource`` but takes no column from it; the join is
    left out (it could only duplicate rows).
    """
    small = batch_is_small(inp, batch_small)
    df = lookup(inp, location, "PmsLocationId", "PmsLocationId", {"PmsLocationId": "_loc"}, key_collation=key_collation)
    df = lookup(df, provider, "PmsProviderId", "PmsProviderId", {"PmsProviderId": "_prov"}, key_collation=key_collation)
    df = lookup(
        df, patient, "PmsPatientId", "PmsPatientId", {"PmsPatientId": "_pat"}, probe=inp if small else None, key_collation=key_collation
    )
    df = scalar_lookup(df, reason, F.col("ReasonName"), "ReasonName", "PmsReasonId", "_rsn", key_collation=key_collation)
    df = scalar_lookup(df, reason, F.col("PmsReasonId"), "PmsReasonId", "PmsReasonId", "_rsi", key_collation=key_collation)
    reason_id = F.when(is_blank(F.col("PmsReasonId")), one_row("_rsn", "reason by name")).otherwise(
        one_row("_rsi", "reason by id")
    )
    return df.select(
        I, "PmsAppointmentId",
        F.coalesce("_pat", F.lit("0")).alias("PmsPatientId"),
        F.coalesce("_loc", F.lit("0")).alias("PmsLocationId"),
        F.coalesce("_prov", F.lit("0")).alias("PmsProviderId"),
        "PmsResourceId",
        reason_id.alias("PmsReasonId"),
        "StartDate", "StartTime", "Length", "ApptType", "ApptStatus", "ShowedUp", "SpendAmt",
        "ICD1", "ICD2", "ICD3", "CPT1", "CPT2", "CPT3", "Deleted",
        "PmsCreatedDate", "PmsLastModifiedDate", "UTCCreatedDate", "UTCLastModifiedDate",
    )


_INSURER_SLOTS = ("Primary", "Secondary", "Tertiary")


def stage_patient(
    inp: DataFrame,
    location: DataFrame,
    provider: DataFrame,
    insurer: DataFrame,
    batch_small: bool | None = None,
    key_collation: str | None = None,
) -> DataFrame:
    """Raw-key lookups for location/provider (default ``'0'``), three insurers by id
    when given else by name, ``Deleted`` forced to 0."""
    del batch_small  # no lookup into a table that grows with the data
    df = lookup(inp, location, "PmsLocationId", "PmsLocationId", {"PmsLocationId": "_loc"}, key_mode="rtrim", key_collation=key_collation)
    df = lookup(df, provider, "PmsProviderId", "PmsProviderId", {"PmsProviderId": "_prov"}, key_mode="rtrim", key_collation=key_collation)
    for slot in _INSURER_SLOTS:
        df = scalar_lookup(df, insurer, F.col(f"InsurerName{slot}"), "InsurerName", "PmsInsurerId", f"_in{slot}", key_collation=key_collation)
        df = scalar_lookup(df, insurer, F.col(f"InsurerID{slot}"), "PmsInsurerId", "PmsInsurerId", f"_ii{slot}", key_collation=key_collation)
    out = []
    for c in (I, "PmsPatientId", *specs.PATIENT_COLUMNS):
        if c == "PmsLocationId":
            out.append(F.coalesce("_loc", F.lit("0")).alias(c))
        elif c == "PmsProviderId":
            out.append(F.coalesce("_prov", F.lit("0")).alias(c))
        elif c in specs.PATIENT_INSURERS:
            slot = c[len("InsurerID"):]
            out.append(
                F.when(is_blank(F.col(c)), one_row(f"_in{slot}", "insurer by name"))
                .otherwise(one_row(f"_ii{slot}", "insurer by id"))
                .alias(c)
            )
        elif c == "Deleted":
            out.append(F.lit(0).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _fallback(blank_col: str, from_patient: str, from_lookup: str, trim: bool):
    pat, look = F.col(from_patient), F.col(from_lookup)
    if trim:
        pat, look = F.trim(pat), F.trim(look)
    return F.when(is_blank(F.col(blank_col)), pat).otherwise(look)


def stage_product_pickup(
    inp: DataFrame,
    location: DataFrame,
    provider: DataFrame,
    patient: DataFrame,
    batch_small: bool | None = None,
    key_collation: str | None = None,
) -> DataFrame:
    """Raw-key lookups; blank location/provider fall back to the patient's; patient id
    is the stored one (NULL when unknown)."""
    small = batch_is_small(inp, batch_small)
    df = lookup(inp, location, "PmsLocationId", "PmsLocationId", {"PmsLocationId": "_loc"}, key_mode="rtrim", key_collation=key_collation)
    df = lookup(df, provider, "PmsProviderId", "PmsProviderId", {"PmsProviderId": "_prov"}, key_mode="rtrim", key_collation=key_collation)
    df = lookup(
        df, patient, "PmsPatientId", "PmsPatientId",
        {"PmsPatientId": "_pat", "PmsLocationId": "_pat_loc", "PmsProviderId": "_pat_prov"},
        key_mode="rtrim",
        probe=inp if small else None,
        key_collation=key_collation,
    )
    return df.select(
        I, "PmsOrderId",
        F.col("_pat").alias("PmsPatientId"),
        _fallback("PmsLocationId", "_pat_loc", "_loc", trim=True).alias("PmsLocationId"),
        _fallback("PmsProviderId", "_pat_prov", "_prov", trim=True).alias("PmsProviderId"),
        "OrderDate", "ReceivedDate", "NotifiedDate", "PickedUpDate", "ProductType",
        "ProductBrand1", "ProductBrand2", "ProductBrand3", "SpendAmt", "OrderStatus",
        "PricedDate", "StatusChangedDate", "Deleted", "PmsCreatedDate", "PmsLastModifiedDate",
    )


def stage_recall(
    inp: DataFrame,
    location: DataFrame,
    provider: DataFrame,
    patient: DataFrame,
    reason: DataFrame,
    batch_small: bool | None = None,
    key_collation: str | None = None,
) -> DataFrame:
    """Trimmed lookups with patient fallback; recall reason by id when given else by name."""
    small = batch_is_small(inp, batch_small)
    df = lookup(inp, location, "PmsLocationId", "PmsLocationId", {"PmsLocationId": "_loc"}, key_collation=key_collation)
    df = lookup(df, provider, "PmsProviderId", "PmsProviderId", {"PmsProviderId": "_prov"}, key_collation=key_collation)
    df = lookup(
        df, patient, "PmsPatientId", "PmsPatientId",
        {"PmsPatientId": "_pat", "PmsLocationId": "_pat_loc", "PmsProviderId": "_pat_prov"},
        probe=inp if small else None,
        key_collation=key_collation,
    )
    df = scalar_lookup(df, reason, F.col("ReasonName"), "ReasonName", "PmsRecallReasonId", "_rsn", key_collation=key_collation)
    df = scalar_lookup(df, reason, F.col("PmsRecallReasonId"), "PmsRecallReasonId", "PmsRecallReasonId", "_rsi", key_collation=key_collation)
    reason_id = F.when(is_blank(F.col("PmsRecallReasonId")), one_row("_rsn", "recall reason by name")).otherwise(
        one_row("_rsi", "recall reason by id")
    )
    return df.select(
        I, "PmsRecallId",
        F.col("_pat").alias("PmsPatientId"),
        _fallback("PmsLocationId", "_pat_loc", "_loc", trim=True).alias("PmsLocationId"),
        _fallback("PmsProviderId", "_pat_prov", "_prov", trim=True).alias("PmsProviderId"),
        "RecallDate",
        reason_id.alias("RecallReasonId"),
        "Deleted",
    )


def stage_visit(
    inp: DataFrame,
    location: DataFrame,
    provider: DataFrame,
    patient: DataFrame,
    batch_small: bool | None = None,
    key_collation: str | None = None,
) -> DataFrame:
    """Trimmed lookups with untrimmed patient fallback.  Feeds the rollups only."""
    small = batch_is_small(inp, batch_small)
    df = lookup(inp, location, "PmsLocationId", "PmsLocationId", {"PmsLocationId": "_loc"}, key_collation=key_collation)
    df = lookup(df, provider, "PmsProviderId", "PmsProviderId", {"PmsProviderId": "_prov"}, key_collation=key_collation)
    df = lookup(
        df, patient, "PmsPatientId", "PmsPatientId",
        {"PmsPatientId": "_pat", "PmsLocationId": "_pat_loc", "PmsProviderId": "_pat_prov"},
        probe=inp if small else None,
        key_collation=key_collation,
    )
    return df.select(
        I, "PmsVisitId",
        F.col("_pat").alias("PmsPatientId"),
        _fallback("PmsLocationId", "_pat_loc", "_loc", trim=False).alias("PmsLocationId"),
        _fallback("PmsProviderId", "_pat_prov", "_prov", trim=False).alias("PmsProviderId"),
        "PmsAppointmentId", "VisitDate", "VisitType", "VisitReason", "ShowedUp",
        "ICD1", "ICD2", "ICD3", "CPT1", "CPT2", "CPT3", "ProductType",
        "ProductBrand1", "ProductBrand2", "ProductBrand3", "SpendAmt", "Deleted",
        "PmsCreatedDate", "PmsLastModifiedDate",
    )


# ------------------------------------------------------------------ procedures


def location_upsert(location, inp, as_of=None, mode="collapse", **options) -> MergeResult:
    return merge(location, inp, specs.LOCATION, as_of, mode, **options)


def provider_upsert(provider, inp, as_of=None, mode="collapse", **options) -> MergeResult:
    return merge(provider, inp, specs.PROVIDER, as_of, mode, **options)


def resource_upsert(resource, inp, as_of=None, mode="collapse", **options) -> MergeResult:
    return merge(resource, inp, specs.RESOURCE, as_of, mode, **options)


def insurer_upsert(insurer, inp, match_by="id", as_of=None, mode="collapse", **options) -> MergeResult:
    return merge(insurer, inp, specs.named_list(*specs.INSURER_COLS, match_by), as_of, mode, **options)


def appointment_reason_upsert(reason, inp, match_by="id", as_of=None, mode="collapse", **options) -> MergeResult:
    return merge(reason, inp, specs.named_list(*specs.APPOINTMENT_REASON_COLS, match_by), as_of, mode, **options)


def recall_reason_upsert(reason, inp, match_by="id", as_of=None, mode="collapse", **options) -> MergeResult:
    return merge(reason, inp, specs.named_list(*specs.RECALL_REASON_COLS, match_by), as_of, mode, **options)


def _staged_merge(target, inp, stage, dims, spec, as_of, mode, options) -> tuple[MergeResult, DataFrame, bool]:
    """Count the raw batch once, stage it once, merge it."""
    small = batch_is_small(inp, max_rows=options.get("max_broadcast_rows"))
    staged = written_once(stage(inp, *dims, small, options.get("key_collation")), "staged")
    result = merge(target, staged, spec, as_of, mode, batch_small=small, batch_keys=inp, **options)
    return result, staged, small


def appointment_block_upsert(block, inp, location, provider, resource, as_of=None, mode="collapse", **options):
    dims = (location, provider, resource)
    return _staged_merge(block, inp, stage_appointment_block, dims, specs.APPOINTMENT_BLOCK, as_of, mode, options)[0]


def appointment_upsert(
    appointment, inp, location, provider, patient, reason, as_of=None, mode="collapse", **options
) -> MergeResult:
    dims = (location, provider, patient, reason)
    return _staged_merge(appointment, inp, stage_appointment, dims, specs.APPOINTMENT, as_of, mode, options)[0]


def patient_upsert(patient, inp, location, provider, insurer, as_of=None, mode="collapse", **options) -> MergeResult:
    dims = (location, provider, insurer)
    return _staged_merge(patient, inp, stage_patient, dims, specs.PATIENT, as_of, mode, options)[0]


def product_pickup_upsert(pickup, inp, location, provider, patient, as_of=None, mode="collapse", **options):
    """Returns ``(MergeResult, patient_after_lens_rollup)``: two independent statements."""
    dims = (location, provider, patient)
    result, staged, small = _staged_merge(
        pickup, inp, stage_product_pickup, dims, specs.PRODUCT_PICKUP, as_of, mode, options
    )
    same = options.get("key_collation")
    facts = patient_facts(staged, lens=True, exam=False, key_collation=same)
    return result, apply_patient_facts(patient, facts, as_of, batch_small=small, key_collation=same)


def recall_upsert(
    recall, inp, location, provider, patient, reason, as_of=None, mode="collapse", **options
) -> MergeResult:
    dims = (location, provider, patient, reason)
    return _staged_merge(recall, inp, stage_recall, dims, specs.RECALL, as_of, mode, options)[0]


def visit_upsert(
    visit, inp, location, provider, patient, as_of=None, mode="collapse", use_staged=False, **options
):
    """Returns ``(MergeResult, patient_after_rollups)``.

    The rollups read the staged rows; the visit merge reads the raw input, as the
    reference does (``use_staged=True`` merges the resolved rows instead).
    """
    small = batch_is_small(inp, max_rows=options.get("max_broadcast_rows"))
    same = options.get("key_collation")
    staged = stage_visit(inp, location, provider, patient, small, same)
    if use_staged:  # else the patients alone read it, once
        staged = written_once(staged, "staged")
    facts = patient_facts(staged, key_collation=same)
    patient_after = apply_patient_facts(patient, facts, as_of, batch_small=small, key_collation=same)
    rows = staged if use_staged else inp
    result = merge(visit, rows, specs.VISIT, as_of, mode, batch_small=small, batch_keys=inp, **options)
    return result, patient_after


def soft_delete(entity: str, target, ids, as_of=None, **options) -> MergeResult:
    """``sp_<Entity>MarkDeleted`` for the seven entities that have one."""
    return mark_deleted(target, ids, specs.SOFT_DELETES[entity], as_of, **options)


def availability_slot_compare(current, previous, mode="collapse", **options) -> DataFrame:
    return snapshot_diff(current, previous, mode=mode, **options)


def availability_slot_mark_deleted(slots, ids, as_of=None) -> MergeResult:
    return slot_mark_deleted(slots, ids, as_of)


#: The tables a tenant can be purged from; the slot table is archived, the others are logged.
PURGE_TABLES = (
    "location", "provider", "resource", "insurer", "appointment_reason", "recall_reason", "appointment_block",
    "appointment", "patient", "product_pickup", "recall", "visit", "transaction_item", "availability_slot",
)


def batch_delete_tenant(table, tenant_id: str, table_name: str, as_of=None) -> PurgeResult:
    if table_name not in PURGE_TABLES:
        raise ValueError(f"unknown table {table_name!r}; one of {', '.join(PURGE_TABLES)}")
    return purge_tenant(table, tenant_id, table_name, is_slot_table=(table_name == "availability_slot"), as_of=as_of)
