"""Oracle SQL for the staging step of each entity (DuckDB text, over fixture views)."""

from __future__ import annotations

from tessera.functions.exprs import is_blank_sql as blank
from tessera.plans import specs


def _join(dim: str, alias: str, col: str, mode: str = "trim", src: str = "i", dim_col: str | None = None) -> str:
    dc = dim_col or col
    if mode == "trim":
        on = f"trim({alias}.{dc}) = trim({src}.{col})"
    else:  # rtrim: the T-SQL raw '=' ignores trailing blanks
        on = f"rtrim({alias}.{dc}) = rtrim({src}.{col})"
    return f"LEFT JOIN {dim} {alias} ON {alias}.PmsInstanceId = {src}.PmsInstanceId AND {on}"


def _scalar(dim: str, value: str, match: str, probe: str) -> str:
    return (
        f"(SELECT d.{value} FROM {dim} d WHERE d.PmsInstanceId = i.PmsInstanceId "
        f"AND trim(d.{match}) = trim({probe}))"
    )


APPOINTMENT_BLOCK = (
    "SELECT i.PmsInstanceId, i.PmsAppointmentId, coalesce(l.PmsLocationId, '0') AS PmsLocationId, "
    "coalesce(p.PmsProviderId, '0') AS PmsProviderId, coalesce(r.PmsResourceId, '0') AS PmsResourceId, "
    "i.StartDate, i.StartTime, i.Length, i.Deleted FROM appointment_block_in i "
    f"{_join('location', 'l', 'PmsLocationId')} {_join('provider', 'p', 'PmsProviderId')} "
    f"{_join('resource', 'r', 'PmsResourceId')}"
)

APPOINTMENT = (
    "SELECT i.PmsInstanceId, i.PmsAppointmentId, coalesce(pt.PmsPatientId, '0') AS PmsPatientId, "
    "coalesce(l.PmsLocationId, '0') AS PmsLocationId, coalesce(p.PmsProviderId, '0') AS PmsProviderId, "
    "i.PmsResourceId, "
    f"CASE WHEN {blank('i.PmsReasonId')} "
    f"THEN {_scalar('appointment_reason', 'PmsReasonId', 'ReasonName', 'i.ReasonName')} "
    f"ELSE {_scalar('appointment_reason', 'PmsReasonId', 'PmsReasonId', 'i.PmsReasonId')} END AS PmsReasonId, "
    "i.StartDate, i.StartTime, i.Length, i.ApptType, i.ApptStatus, i.ShowedUp, i.SpendAmt, "
    "i.ICD1, i.ICD2, i.ICD3, i.CPT1, i.CPT2, i.CPT3, i.Deleted, "
    "i.PmsCreatedDate, i.PmsLastModifiedDate, i.UTCCreatedDate, i.UTCLastModifiedDate "
    f"FROM appointment_in i {_join('location', 'l', 'PmsLocationId')} "
    f"{_join('provider', 'p', 'PmsProviderId')} {_join('patient', 'pt', 'PmsPatientId')}"
)


def _patient_col(c: str) -> str:
    if c == "PmsLocationId":
        return "coalesce(l.PmsLocationId, '0') AS PmsLocationId"
    if c == "PmsProviderId":
        return "coalesce(p.PmsProviderId, '0') AS PmsProviderId"
    if c in specs.PATIENT_INSURERS:
        slot = c[len("InsurerID"):]
        return (
            f"CASE WHEN {blank('i.' + c)} "
            f"THEN {_scalar('insurer', 'PmsInsurerId', 'InsurerName', f'i.InsurerName{slot}')} "
            f"ELSE {_scalar('insurer', 'PmsInsurerId', 'PmsInsurerId', 'i.' + c)} END AS {c}"
        )
    if c == "Deleted":
        return "0 AS Deleted"
    return f"i.{c}"


PATIENT = (
    "SELECT i.PmsInstanceId, i.PmsPatientId, "
    + ", ".join(_patient_col(c) for c in specs.PATIENT_COLUMNS)
    + f" FROM patient_wide_in i {_join('location', 'l', 'PmsLocationId', 'rtrim')} "
    f"{_join('provider', 'p', 'PmsProviderId', 'rtrim')}"
)


def _fallback(col: str, pat: str, look: str, trim: bool) -> str:
    if trim:
        pat, look = f"trim({pat})", f"trim({look})"
    return f"CASE WHEN {blank('i.' + col)} THEN {pat} ELSE {look} END AS {col}"


PRODUCT_PICKUP = (
    "SELECT i.PmsInstanceId, i.PmsOrderId, pt.PmsPatientId AS PmsPatientId, "
    f"{_fallback('PmsLocationId', 'pt.PmsLocationId', 'l.PmsLocationId', True)}, "
    f"{_fallback('PmsProviderId', 'pt.PmsProviderId', 'p.PmsProviderId', True)}, "
    "i.OrderDate, i.ReceivedDate, i.NotifiedDate, i.PickedUpDate, i.ProductType, "
    "i.ProductBrand1, i.ProductBrand2, i.ProductBrand3, i.SpendAmt, i.OrderStatus, "
    "i.PricedDate, i.StatusChangedDate, i.Deleted, i.PmsCreatedDate, i.PmsLastModifiedDate "
    f"FROM product_pickup_in i {_join('location', 'l', 'PmsLocationId', 'rtrim')} "
    f"{_join('provider', 'p', 'PmsProviderId', 'rtrim')} {_join('patient', 'pt', 'PmsPatientId', 'rtrim')}"
)

RECALL = (
    "SELECT i.PmsInstanceId, i.PmsRecallId, pt.PmsPatientId AS PmsPatientId, "
    f"{_fallback('PmsLocationId', 'pt.PmsLocationId', 'l.PmsLocationId', True)}, "
    f"{_fallback('PmsProviderId', 'pt.PmsProviderId', 'p.PmsProviderId', True)}, "
    "i.RecallDate, "
    f"CASE WHEN {blank('i.PmsRecallReasonId')} "
    f"THEN {_scalar('recall_reason', 'PmsRecallReasonId', 'ReasonName', 'i.ReasonName')} "
    f"ELSE {_scalar('recall_reason', 'PmsRecallReasonId', 'PmsRecallReasonId', 'i.PmsRecallReasonId')} "
    "END AS RecallReasonId, i.Deleted "
    f"FROM recall_in i {_join('location', 'l', 'PmsLocationId')} {_join('provider', 'p', 'PmsProviderId')} "
    f"{_join('patient', 'pt', 'PmsPatientId')}"
)

VISIT = (
    "SELECT i.PmsInstanceId, i.PmsVisitId, pt.PmsPatientId AS PmsPatientId, "
    f"{_fallback('PmsLocationId', 'pt.PmsLocationId', 'l.PmsLocationId', False)}, "
    f"{_fallback('PmsProviderId', 'pt.PmsProviderId', 'p.PmsProviderId', False)}, "
    "i.PmsAppointmentId, i.VisitDate, i.VisitType, i.VisitReason, i.ShowedUp, "
    "i.ICD1, i.ICD2, i.ICD3, i.CPT1, i.CPT2, i.CPT3, i.ProductType, "
    "i.ProductBrand1, i.ProductBrand2, i.ProductBrand3, i.SpendAmt, i.Deleted, "
    "i.PmsCreatedDate, i.PmsLastModifiedDate "
    f"FROM visit_in i {_join('location', 'l', 'PmsLocationId')} {_join('provider', 'p', 'PmsProviderId')} "
    f"{_join('patient', 'pt', 'PmsPatientId')}"
)

# Fixture views each staging text reads.
VIEWS = {
    "appointment_block": ("appointment_block_in", "location", "provider", "resource"),
    "appointment": ("appointment_in", "location", "provider", "patient", "appointment_reason"),
    "patient": ("patient_wide_in", "location", "provider", "insurer"),
    "product_pickup": ("product_pickup_in", "location", "provider", "patient"),
    "recall": ("recall_in", "location", "provider", "patient", "recall_reason"),
    "visit": ("visit_in", "location", "provider", "patient"),
}
SQL = {
    "appointment_block": APPOINTMENT_BLOCK,
    "appointment": APPOINTMENT,
    "patient": PATIENT,
    "product_pickup": PRODUCT_PICKUP,
    "recall": RECALL,
    "visit": VISIT,
}
