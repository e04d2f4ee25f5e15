"""Declared schemas of the input batches, and the batch reader.

The reference receives each batch as a typed table parameter; its types are
not visible, so the types here are our choice (strings for ids and text,
``INT`` flags, ``DECIMAL(15,2)`` amounts, timestamps for ``*Date`` columns,
``DATE`` for an appointment's ``StartDate``).  Reading with a declared schema
means no schema inference (no sampling pass over the files) and a stable
column set even when a batch file lacks a column: it reads as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tessera.plans import specs

S, I, TS, D, AMT = StringType(), IntegerType(), TimestampType(), DateType(), DecimalType(15, 2)


def _schema(*cols: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


def _strings(*names: str) -> list[tuple[str, DataType]]:
    return [(n, S) for n in names]


_AUDIT4 = [("PmsCreatedDate", TS), ("PmsLastModifiedDate", TS), ("UTCCreatedDate", TS), ("UTCLastModifiedDate", TS)]
_UTC2 = [("UTCCreatedDate", TS), ("UTCLastModifiedDate", TS)]


def _patient_type(c: str) -> DataType:
    if c in specs.PATIENT_FLAGS or c in ("Status", "Deleted"):
        return I
    if c == "DOB" or c.endswith("Date"):
        return TS
    return S


# The input batch columns (names as the stored tables use them).
INPUT_SCHEMAS: dict[str, StructType] = {
    "id_list": _schema(*_strings("PmsInstanceId", "PmsId")),
    "slot_id_list": _schema(*_strings("PmsInstanceId", "PmsLocationId", "PmsProviderId"),
                            ("Length", I), ("SwimLanes", I)),
    "location": _schema(*_strings("PmsInstanceId", "PmsLocationId", "LocationName", "TimeZone")),
    "provider": _schema(*_strings("PmsInstanceId", "PmsProviderId", "ProviderFirstName", "ProviderLastName")),
    "resource": _schema(*_strings("PmsInstanceId", "PmsResourceId", "ResourceName")),
    "insurer": _schema(*_strings("PmsInstanceId", "PmsInsurerId", "InsurerName")),
    "appointment_reason": _schema(*_strings("PmsInstanceId", "PmsReasonId", "ReasonName")),
    "recall_reason": _schema(*_strings("PmsInstanceId", "PmsRecallReasonId", "ReasonName")),
    "appointment_block": _schema(
        *_strings("PmsInstanceId", "PmsAppointmentId", "PmsLocationId", "PmsProviderId", "PmsResourceId"),
        ("StartDate", D), ("StartTime", S), ("Length", I), ("Deleted", I), *_UTC2,
    ),
    "appointment": _schema(
        *_strings("PmsInstanceId", "PmsAppointmentId", "PmsPatientId", "PmsLocationId", "PmsProviderId",
                  "PmsResourceId", "PmsReasonId", "ReasonName"),
        ("StartDate", D), ("StartTime", S), ("Length", I), ("ApptType", S), ("ApptStatus", S),
        ("ShowedUp", I), ("SpendAmt", AMT), *_strings("ICD1", "ICD2", "ICD3", "CPT1", "CPT2", "CPT3"),
        ("Deleted", I), *_AUDIT4,
    ),
    "patient": _schema(
        *_strings("PmsInstanceId", "PmsPatientId"),
        *[(c, _patient_type(c)) for c in specs.PATIENT_COLUMNS],
        *_strings("InsurerNamePrimary", "InsurerNameSecondary", "InsurerNameTertiary"),
    ),
    "product_pickup": _schema(
        *_strings("PmsInstanceId", "PmsOrderId", "PmsPatientId", "PmsLocationId", "PmsProviderId"),
        ("OrderDate", TS), ("ReceivedDate", TS), ("NotifiedDate", TS), ("PickedUpDate", TS),
        *_strings("ProductType", "ProductBrand1", "ProductBrand2", "ProductBrand3"),
        ("SpendAmt", AMT), ("OrderStatus", S), ("PricedDate", TS), ("StatusChangedDate", TS),
        ("Deleted", I), *_AUDIT4,
    ),
    "recall": _schema(
        *_strings("PmsInstanceId", "PmsRecallId", "PmsPatientId", "PmsLocationId", "PmsProviderId",
                  "PmsRecallReasonId", "ReasonName"),
        ("RecallDate", TS), ("Deleted", I), *_UTC2,
    ),
    "visit": _schema(
        *_strings("PmsInstanceId", "PmsVisitId", "PmsPatientId", "PmsLocationId", "PmsProviderId",
                  "PmsAppointmentId"),
        ("VisitDate", TS), ("VisitType", S), ("VisitReason", S), ("ShowedUp", I),
        *_strings("ICD1", "ICD2", "ICD3", "CPT1", "CPT2", "CPT3", "ProductType", "ProductBrand1",
                  "ProductBrand2", "ProductBrand3"),
        ("SpendAmt", AMT), ("Deleted", I), *_AUDIT4,
    ),
}


def read_batch(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Scan an input batch with its declared schema (no inference; missing columns read as NULL)."""
    return spark.read.schema(INPUT_SCHEMAS[kind]).parquet(path)
