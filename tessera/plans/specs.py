"""Declarative per-entity merge specs.

A spec says, per target column, how an inserted value is built from the staged
source row, how an update rewrites it, which operands make up the row
fingerprint, and what the change feed (delta) carries.  The merge operator turns
a spec into one Spark plan; the oracle renderer turns the same spec into SQL.

Rules for :class:`Field.update`:

``keep``              the target value stays
``<form>``            the source value in that form (see ``tessera.functions.exprs``)
``clock``             the call's clock
``later``             ``CASE WHEN s > t THEN s ELSE t END`` (NULL never advances)
``cw:<test>:<new>:<old>``  column-wise: when ``test(s)`` and ``test(t)`` differ
                      (NULL-safe) the source in form ``new``, else the target in form ``old``

Rules for :class:`DeltaField.rule`:

``clock`` / ``action`` / ``<form>`` of the source column, or
``sp:<ins>:<test>:<upd>``  sparse: on insert the source in form ``ins``; on update
                      the source in form ``upd`` when ``test`` says the column
                      changed against the pre-image, else NULL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names of the entity tables (tenant, keys, payload) are
# the stored tables' names and appear as plain strings throughout the specs.
TENANT = "PmsInstanceId"


@dataclass(frozen=True)
class Field:
    name: str
    insert: str = "raw"
    update: str = "keep"
    src: str | None = None

    @property
    def source(self) -> str:
        return self.src or self.name


@dataclass(frozen=True)
class DeltaField:
    name: str
    rule: str
    src: str | None = None

    @property
    def source(self) -> str:
        return self.src or self.name


@dataclass(frozen=True)
class MergeSpec:
    entity: str
    key: str
    fields: tuple[Field, ...]
    fingerprint: tuple[tuple[tuple[str, str], ...], ...]
    delta: tuple[DeltaField, ...]
    src_key: str | None = None
    key_mode: str = "trim"
    tenant: str = TENANT

    @property
    def source_key(self) -> str:
        return self.src_key or self.key

    def column_names(self) -> list[str]:
        return [f.name for f in self.fields]


def _thin_delta(key: str, key_src: str | None = None) -> tuple[DeltaField, ...]:
    return (
        DeltaField(TENANT, "raw"),
        DeltaField(key, "trim", key_src),
        DeltaField("UtcCreatedDate", "clock"),
        DeltaField("ActionPerformed", "action"),
    )


def _fp(*cols: str, form: str = "ttext") -> tuple[tuple[tuple[str, str], ...], ...]:
    return (tuple((c, form) for c in cols),)


CLOCKS = (Field("UtcCreatedDate", "clock", "keep"), Field("UtcLastModifiedDate", "clock", "clock"))


# ------------------------------------------------------------------ reference lists

LOCATION = MergeSpec(
    entity="location",
    key="PmsLocationId",
    key_mode="rtrim",  # the reference matches this key untrimmed
    fields=(
        Field(TENANT),
        Field("PmsLocationId", "raw"),
        Field("LocationName", "trim", "trim"),
        Field("TimeZone", "trim", "trim"),
        *CLOCKS,
    ),
    fingerprint=_fp("LocationName", "TimeZone"),
    delta=_thin_delta("PmsLocationId"),
)

PROVIDER = MergeSpec(
    entity="provider",
    key="PmsProviderId",
    fields=(
        Field(TENANT),
        Field("PmsProviderId", "trim"),
        Field("ProviderFirstName", "trim", "trim"),
        Field("ProviderLastName", "trim", "trim"),
        *CLOCKS,
    ),
    fingerprint=_fp("ProviderFirstName", "ProviderLastName"),
    delta=_thin_delta("PmsProviderId"),
)

RESOURCE = MergeSpec(
    entity="resource",
    key="PmsResourceId",
    fields=(
        Field(TENANT),
        Field("PmsResourceId", "trim"),
        Field("ResourceName", "trim", "trim"),
        *CLOCKS,
    ),
    fingerprint=_fp("ResourceName"),
    delta=_thin_delta("PmsResourceId"),
)


def named_list(entity: str, id_col: str, name_col: str, match_by: str) -> MergeSpec:
    """Insurer and reason lists: keyed by id, or by name with the id as payload."""
    if match_by == "name":
        return MergeSpec(
            entity=entity,
            key=name_col,
            fields=(
                Field(TENANT),
                Field(id_col, "trim", "trim"),
                Field(name_col, "trim", "trim"),
                *CLOCKS,
            ),
            fingerprint=_fp(id_col, name_col),
            delta=_thin_delta(id_col),
        )
    if match_by == "id":
        return MergeSpec(
            entity=entity,
            key=id_col,
            fields=(
                Field(TENANT),
                Field(id_col, "trim"),
                Field(name_col, "trim", "trim"),
                *CLOCKS,
            ),
            fingerprint=_fp(name_col),
            delta=_thin_delta(id_col),
        )
    raise ValueError(f"match_by must be 'name' or 'id', not {match_by!r}")


INSURER_COLS = ("insurer", "PmsInsurerId", "InsurerName")
APPOINTMENT_REASON_COLS = ("appointment_reason", "PmsReasonId", "ReasonName")
RECALL_REASON_COLS = ("recall_reason", "PmsRecallReasonId", "ReasonName")


# ------------------------------------------------------------------ thin fact merges

APPOINTMENT_BLOCK = MergeSpec(
    entity="appointment_block",
    key="PmsAppointmentId",
    fields=(
        Field(TENANT),
        Field("PmsAppointmentId", "trim"),
        Field("PmsLocationId", "trim0", "trim0"),
        Field("PmsProviderId", "trim0", "trim0"),
        Field("PmsResourceId", "trim0", "trim0"),
        Field("StartDate", "raw", "raw"),
        Field("StartTime", "raw", "raw"),
        Field("Length", "raw", "raw"),
        Field("Deleted", "raw", "raw"),
        *CLOCKS,
    ),
    fingerprint=_fp(
        "Length", "PmsLocationId", "PmsProviderId", "PmsResourceId", "StartDate", "StartTime", "Deleted"
    ),
    delta=_thin_delta("PmsAppointmentId"),
)

PRODUCT_PICKUP = MergeSpec(
    entity="product_pickup",
    key="PmsOrderId",
    fields=(
        Field(TENANT),
        Field("PmsOrderId", "trim", "trim"),
        Field("PmsPatientId", "raw0", "trim0"),
        Field("PmsLocationId", "raw0", "trim0"),
        Field("PmsProviderId", "raw0", "trim0"),
        Field("OrderDate", "raw", "raw"),
        Field("ProductType", "trim", "trim"),
        Field("SpendAmt", "raw", "raw"),
        Field("OrderStatus", "trim", "trim"),
        Field("Deleted", "raw", "raw"),
        Field("ReceivedDate", "raw", "raw"),
        Field("NotifiedDate", "raw", "raw"),
        Field("PickedUpDate", "raw", "raw"),
        Field("PricedDate", "raw", "raw"),
        Field("StatusChangedDate", "raw", "raw"),
        Field("ProductBrand1", "trim", "trim"),
        Field("ProductBrand2", "trim", "trim"),
        Field("ProductBrand3", "trim", "trim"),
        Field("PmsCreatedDate", "raw", "raw"),
        Field("PmsLastModifiedDate", "raw", "raw"),
        *CLOCKS,
    ),
    fingerprint=_fp(
        "PmsOrderId", "PmsPatientId", "PmsLocationId", "PmsProviderId", "OrderDate", "ReceivedDate",
        "NotifiedDate", "PickedUpDate", "ProductType", "ProductBrand1", "ProductBrand2", "ProductBrand3",
        "SpendAmt", "OrderStatus", "PricedDate", "StatusChangedDate", "Deleted",
    ),
    delta=_thin_delta("PmsOrderId"),
)

RECALL = MergeSpec(
    entity="recall",
    key="PmsRecallId",
    fields=(
        Field(TENANT),
        Field("PmsRecallId", "trim"),
        Field("PmsPatientId", "trim0", "trim0"),
        Field("PmsLocationId", "trim0", "trim0"),
        Field("PmsProviderId", "trim0", "trim0"),
        Field("RecallDate", "raw", "raw"),
        Field("RecallReasonId", "raw0", "raw0"),
        Field("Deleted", "raw", "raw"),
        *CLOCKS,
    ),
    fingerprint=_fp("PmsPatientId", "PmsLocationId", "PmsProviderId", "RecallDate", "RecallReasonId", "Deleted"),
    delta=_thin_delta("PmsRecallId"),
)

VISIT = MergeSpec(
    entity="visit",
    key="PmsVisitId",
    fields=(
        Field(TENANT),
        Field("PmsVisitId", "trim"),
        Field("PmsPatientId", "trim0", "trim0"),
        Field("PmsLocationId", "trim0", "trim0"),
        Field("PmsProviderId", "trim0", "trim0"),
        Field("VisitDate", "raw", "later"),
        Field("VisitType", "trim", "trim"),
        Field("ProductType", "trim", "trim"),
        Field("SpendAmt", "raw", "raw"),
        Field("PmsAppointmentId", "trim", "trim"),
        Field("VisitReason", "trim", "trim"),
        Field("ShowedUp", "raw", "raw"),
        Field("ICD1", "trim", "trim"),
        Field("ICD2", "trim", "trim"),
        Field("ICD3", "trim", "trim"),
        Field("CPT1", "trim", "trim"),
        Field("CPT2", "trim", "trim"),
        Field("CPT3", "trim", "trim"),
        Field("ProductBrand1", "trim", "trim"),
        Field("ProductBrand2", "trim", "trim"),
        Field("ProductBrand3", "trim", "trim"),
        Field("Deleted", "raw", "raw"),
        Field("PmsCreatedDate", "raw", "raw"),
        Field("PmsLastModifiedDate", "raw", "raw"),
        *CLOCKS,
    ),
    fingerprint=_fp(
        "PmsLocationId", "PmsProviderId", "PmsPatientId", "PmsAppointmentId", "VisitDate", "VisitType",
        "VisitReason", "ShowedUp", "ICD1", "ICD2", "ICD3", "CPT1", "CPT2", "CPT3", "ProductType",
        "ProductBrand1", "ProductBrand2", "ProductBrand3", "SpendAmt", "Deleted",
    ),
    delta=_thin_delta("PmsVisitId"),
)


# ------------------------------------------------------------------ column-wise merges, sparse delta

_CW_RAW = "cw:raw:raw:raw"
_SP_RAW = "sp:raw:raw:raw"
_SP_TRIM = "sp:trim:ttext:trim"

_APPT_REFS = ("PmsPatientId", "PmsLocationId", "PmsProviderId", "PmsResourceId", "PmsReasonId")
_APPT_CODES = ("ICD1", "ICD2", "ICD3", "CPT1", "CPT2", "CPT3")
_AUDIT = ("PmsCreatedDate", "PmsLastModifiedDate", "UTCCreatedDate", "UTCLastModifiedDate")

APPOINTMENT = MergeSpec(
    entity="appointment",
    key="PmsAppointmentId",
    fields=(
        Field(TENANT),
        Field("PmsAppointmentId", "raw"),
        *(Field(c, "raw0", "cw:raw:raw0:raw") for c in _APPT_REFS),
        Field("StartDate", "raw", _CW_RAW),
        Field("StartTime", "raw", _CW_RAW),
        Field("Length", "raw", _CW_RAW),
        Field("ApptType", "raw", "cw:ttext:trim:raw"),
        Field("ApptStatus", "raw", "cw:ttext:trim:raw"),
        Field("ShowedUp", "raw", _CW_RAW),
        Field("SpendAmt", "raw", _CW_RAW),
        *(Field(c, "raw", "cw:ttext:trim:raw") for c in _APPT_CODES),
        Field("Deleted", "raw", _CW_RAW),
        *(Field(c, "raw", _CW_RAW) for c in _AUDIT),
    ),
    fingerprint=(
        (
            *((c, "text") for c in _APPT_REFS),
            ("StartDate", "text"), ("StartTime", "text"), ("Length", "text"), ("ApptType", "ttext"),
            ("ApptStatus", "text"), ("ShowedUp", "text"), ("SpendAmt", "text"),
            *((c, "ttext") for c in _APPT_CODES),
            ("Deleted", "text"),
        ),
        (("PmsCreatedDate", "text"),),
        (("PmsLastModifiedDate", "text"),),
        (("UTCCreatedDate", "text"),),
        (("UTCLastModifiedDate", "text"),),
    ),
    delta=(
        DeltaField(TENANT, "raw"),
        DeltaField("PmsAppointmentId", "trim"),
        DeltaField("UtcCreatedDate", _SP_RAW, "UTCCreatedDate"),
        DeltaField("ActionPerformed", "action"),
        *(DeltaField(c, _SP_RAW) for c in _APPT_REFS),
        DeltaField("StartDate", _SP_RAW),
        DeltaField("StartTime", _SP_RAW),
        DeltaField("Length", _SP_RAW),
        DeltaField("ApptType", _SP_TRIM),
        DeltaField("ApptStatus", _SP_TRIM),
        DeltaField("ShowedUp", _SP_RAW),
        DeltaField("SpendAmt", _SP_RAW),
        *(DeltaField(c, _SP_TRIM) for c in _APPT_CODES),
        DeltaField("Deleted", _SP_RAW),
        DeltaField("PmsCreatedDate", _SP_RAW),
        DeltaField("PmsLastModifiedDate", _SP_RAW),
        DeltaField("UTCLastModifiedDate", _SP_RAW),
    ),
)

# The patient table's column names (they must equal the stored
# table's), listed in the table's column order and grouped by rule class.
PATIENT_STRINGS_A = (
    "PatientNumber", "FirstName", "LastName", "PrimaryPhone", "PrimaryPhoneType", "SecondaryPhone",
    "SecondaryPhoneType", "CellPhone", "Email", "Address1", "Address2", "City", "State", "Country", "Zip",
)
PATIENT_STRINGS_B = (
    "SSN", "Gender", "PreferredLanguage", "Title", "CommunicationChoice1", "CommunicationChoice2",
    "CommunicationChoice3",
)
PATIENT_FLAGS = tuple(
    f"{use}{channel}Preference"
    for use in ("Survey", "Reminder", "Recall", "Pickup", "Other")
    for channel in ("Email", "SMS", "Voice", "Postal")
)
PATIENT_CODES = ("ICD1", "ICD2", "ICD3")
PATIENT_CODE_DATES = ("ICD1Date", "ICD2Date", "ICD3Date")
PATIENT_INSURERS = ("InsurerIDPrimary", "InsurerIDSecondary", "InsurerIDTertiary")
PATIENT_STRINGS_C = (
    "SpendingBehavior", "ContactLensWearer", "PrimaryInsuranceEIN", "PrimaryInsuranceGroupId",
    "SecondaryInsuranceGroupId", "TertiaryInsuranceGroupId", "PrimaryInsurancePolicyNo",
    "SecondaryInsurancePolicyNo", "TertiaryInsurancePolicyNo", "PrimaryInsurancePlanName",
    "SecondaryInsurancePlanName", "TertiaryInsurancePlanName", "PmsSpecificName1", "PmsSpecificValue1",
)
PATIENT_REFS = ("PmsLocationId", "PmsProviderId")

# Non-key columns in the reference's column order (fingerprint order = this, less the audit dates).
PATIENT_COLUMNS = (
    *PATIENT_REFS, *PATIENT_STRINGS_A, "DOB", *PATIENT_STRINGS_B, *PATIENT_FLAGS, "Status",
    *PATIENT_CODES, *PATIENT_CODE_DATES, *PATIENT_INSURERS, *PATIENT_STRINGS_C,
    "LastVisitOrExamDate", "Deleted", *_AUDIT,
)


def _patient_field(c: str) -> Field:
    if c in PATIENT_REFS:
        return Field(c, "trim0", "cw:raw:raw0:raw")
    if c in PATIENT_STRINGS_A or c in PATIENT_STRINGS_B or c in PATIENT_STRINGS_C:
        return Field(c, "trim", "cw:ttext:trim:trim")
    if c in PATIENT_CODES:
        return Field(c, "trim", "cw:ttext:raw:trim")
    if c in PATIENT_INSURERS:
        return Field(c, "raw0", "cw:ttext:raw:raw")
    if c == "Status":
        return Field(c, "raw", "cw:ttext:raw:raw")
    return Field(c, "raw", _CW_RAW)  # dates, flags, Deleted, audit


def _patient_delta(c: str) -> DeltaField:
    if c == "CommunicationChoice2":
        return DeltaField(c, "sp:raw:ttext:trim")
    if c in PATIENT_STRINGS_A or c in PATIENT_STRINGS_B or c in PATIENT_STRINGS_C or c in PATIENT_CODES:
        return DeltaField(c, _SP_TRIM)
    if c in PATIENT_FLAGS:
        return DeltaField(c, "sp:int0:raw:raw")
    if c in PATIENT_INSURERS:
        return DeltaField(c, "sp:raw0:ttext:raw")
    if c == "Status":
        return DeltaField(c, "sp:raw:ttext:raw")
    return DeltaField(c, _SP_RAW)


PATIENT = MergeSpec(
    entity="patient",
    key="PmsPatientId",
    fields=(Field(TENANT), Field("PmsPatientId", "trim"), *(_patient_field(c) for c in PATIENT_COLUMNS)),
    fingerprint=(
        tuple((c, "ttext" if c in PATIENT_CODES else "text") for c in PATIENT_COLUMNS if c not in _AUDIT),
    ),
    delta=(
        DeltaField(TENANT, "raw"),
        DeltaField("PmsPatientId", "raw"),
        DeltaField("UtcCreatedDate", _SP_RAW, "UTCCreatedDate"),
        DeltaField("ActionPerformed", "action"),
        *(_patient_delta(c) for c in PATIENT_COLUMNS if c != "UTCCreatedDate"),
    ),
)


# ------------------------------------------------------------------ soft deletes (G7)


@dataclass(frozen=True)
class SoftDeleteSpec:
    entity: str
    key: str                  # target column matched against the id list
    delta_key: str            # name of the id column in the delta
    tenant: str = TENANT
    extra: tuple[str, ...] = field(default_factory=tuple)


SOFT_DELETES = {
    "appointment_block": SoftDeleteSpec("appointment_block", "PmsAppointmentId", "PmsAppointmentId"),
    "appointment": SoftDeleteSpec("appointment", "PmsAppointmentId", "PmsAppointmentId"),
    "patient": SoftDeleteSpec("patient", "PmsPatientId", "PmsPatientId"),
    "product_pickup": SoftDeleteSpec("product_pickup", "PmsOrderId", "PmsOrderId"),
    "recall": SoftDeleteSpec("recall", "PmsRecallId", "PmsRecallId"),
    # Matches the transaction id, logs it under the item id column (every item of the transaction).
    "transaction_item": SoftDeleteSpec("transaction_item", "PmsTransactionId", "PmsTransactionItemId"),
    "visit": SoftDeleteSpec("visit", "PmsVisitId", "PmsVisitId"),
}
