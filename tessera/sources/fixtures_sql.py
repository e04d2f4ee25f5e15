"""Fixture views derived from the driver tables (text of FIXTURES.md section 3).

Each body is portable SQL that Spark and DuckDB both run.  Targets (``X``) carry
the full column list of a snapshot table, inputs (``X_in``) are the row batches a
client would send.  Order matters: later bodies read earlier views.
"""

from __future__ import annotations

# Fixture SQL bodies, in dependency order.
FIXTURE_VIEWS: dict[str, str] = {
    'tenant': (
        "SELECT 'T0' AS PmsInstanceId UNION ALL SELECT 'T1' UNION ALL SELECT 'T2'"
    ),
    'location': (
        'SELECT t.PmsInstanceId, '
        "CASE WHEN n_nationkey % 5 = 0 THEN CAST(n_nationkey AS STRING) || '  ' ELSE CAST(n_nationkey AS STRING) END AS PmsLocationId, "
        "n_name AS LocationName, CASE WHEN n_regionkey = 1 THEN NULL ELSE 'UTC' END AS TimeZone, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM nation CROSS JOIN tenant t WHERE n_nationkey % 7 <> 6"
    ),
    'location_in': (
        'SELECT t.PmsInstanceId, '
        "CASE WHEN n_nationkey % 8 = 3 THEN ' ' || CAST(n_nationkey AS STRING) ELSE CAST(n_nationkey AS STRING) END AS PmsLocationId, "
        "CASE WHEN n_nationkey % 4 = 0 THEN n_name || ' HQ' ELSE ' ' || n_name || ' ' END AS LocationName, "
        "CASE WHEN n_regionkey = 1 THEN NULL ELSE 'UTC' END AS TimeZone FROM nation CROSS JOIN tenant t WHERE n_nationkey % 3 <> 2"
    ),
    'provider': (
        'SELECT t.PmsInstanceId, CAST(s_suppkey AS STRING) AS PmsProviderId, s_name AS ProviderFirstName, '
        "CAST(s_nationkey AS STRING) AS ProviderLastName, TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM supplier CROSS JOIN tenant t WHERE s_suppkey % 6 <> 5"
    ),
    'provider_in': (
        'SELECT t.PmsInstanceId, '
        "CASE WHEN s_suppkey % 4 = 0 THEN ' ' || CAST(s_suppkey AS STRING) ELSE CAST(s_suppkey AS STRING) END AS PmsProviderId, "
        "CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' Jr' ELSE s_name || ' ' END AS ProviderFirstName, "
        'CAST(s_nationkey AS STRING) AS ProviderLastName FROM supplier CROSS JOIN tenant t WHERE s_suppkey % 5 <> 1'
    ),
    'resource': (
        "SELECT 'T' || CAST(p_partkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(p_partkey AS STRING) AS PmsResourceId, p_name AS ResourceName, '
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM part WHERE p_partkey % 7 <> 0"
    ),
    'resource_in': (
        "SELECT 'T' || CAST(p_partkey % 3 AS STRING) AS PmsInstanceId, "
        "CASE WHEN p_partkey % 9 = 0 THEN CAST(p_partkey AS STRING) || ' ' ELSE CAST(p_partkey AS STRING) END AS PmsResourceId, "
        "CASE WHEN p_partkey % 4 = 0 THEN p_name || ' v2' WHEN p_partkey % 11 = 0 THEN NULL ELSE ' ' || p_name END AS ResourceName FROM part WHERE p_partkey % 5 <> 0"
    ),
    'insurer': (
        "SELECT t.PmsInstanceId, 'I' || CAST(n_nationkey AS STRING) AS PmsInsurerId, n_name AS InsurerName, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM nation CROSS JOIN tenant t WHERE n_nationkey % 6 <> 5"
    ),
    'insurer_in': (
        'SELECT t.PmsInstanceId, '
        "CASE WHEN n_nationkey % 4 = 0 THEN 'N' ELSE 'I' END || CAST(n_nationkey AS STRING) AS PmsInsurerId, "
        "CASE WHEN n_nationkey % 3 = 0 THEN n_name || ' Co' ELSE n_name || ' ' END AS InsurerName FROM nation CROSS JOIN tenant t WHERE n_nationkey % 5 <> 4"
    ),
    'appointment_reason': (
        "SELECT t.PmsInstanceId, 'R' || CAST(b.k AS STRING) AS PmsReasonId, b.p_brand AS ReasonName, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM (SELECT p_brand, "
        'min(p_partkey) AS k FROM part GROUP BY p_brand) b CROSS JOIN tenant t WHERE b.k % 6 <> 5'
    ),
    'appointment_reason_in': (
        'SELECT t.PmsInstanceId, '
        "CASE WHEN b.k % 4 = 0 THEN 'X' ELSE 'R' END || CAST(b.k AS STRING) AS PmsReasonId, "
        "CASE WHEN b.k % 3 = 0 THEN b.p_brand || ' new' ELSE b.p_brand || ' ' END AS ReasonName FROM (SELECT p_brand, "
        'min(p_partkey) AS k FROM part GROUP BY p_brand) b CROSS JOIN tenant t WHERE b.k % 5 <> 4'
    ),
    'recall_reason': (
        'SELECT t.PmsInstanceId, substr(p.o_orderpriority, 1, 1) AS PmsRecallReasonId, '
        "p.o_orderpriority AS ReasonName, TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM (SELECT DISTINCT o_orderpriority FROM orders) p CROSS JOIN tenant t WHERE substr(p.o_orderpriority, 1, 1) <> '5'"
    ),
    'recall_reason_in': (
        'SELECT t.PmsInstanceId, '
        "CASE WHEN substr(p.o_orderpriority, 1, 1) = '3' THEN '33' ELSE substr(p.o_orderpriority, 1, 1) END AS PmsRecallReasonId, "
        "CASE WHEN substr(p.o_orderpriority, 1, 1) = '2' THEN '2-RENAMED' ELSE p.o_orderpriority || ' ' END AS ReasonName FROM (SELECT DISTINCT o_orderpriority FROM orders) p CROSS JOIN tenant t"
    ),
    'patient': (
        "SELECT 'T' || CAST(c_custkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(c_custkey AS STRING) AS PmsPatientId, CAST(c_nationkey AS STRING) AS PmsLocationId, '
        'CAST(c_custkey % 10 + 1 AS STRING) AS PmsProviderId, c_name AS FirstName, '
        'CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_mktsegment END AS Status, '
        "CAST(c_acctbal AS DECIMAL(15,2)) AS SpendAmt, 'N' AS ContactLensWearer, "
        "CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE TIMESTAMP '1995-06-01 00:00:00' END AS LastVisitOrExamDate, 0 AS Deleted, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM customer WHERE c_custkey % 10 <> 0"
    ),
    'patient_in': (
        "SELECT 'T' || CAST(c_custkey % 3 AS STRING) AS PmsInstanceId, "
        "CASE WHEN c_custkey % 9 = 0 THEN ' ' || CAST(c_custkey AS STRING) ELSE CAST(c_custkey AS STRING) END AS PmsPatientId, "
        'CAST(c_nationkey AS STRING) AS PmsLocationId, CAST(c_custkey % 10 + 1 AS STRING) AS PmsProviderId, '
        "CASE WHEN c_custkey % 6 = 0 THEN c_name || '  ' ELSE c_name END AS FirstName, "
        'CASE WHEN c_custkey % 8 = 0 OR c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS Status, '
        'CAST(c_acctbal + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS DECIMAL(15,2)) AS SpendAmt FROM customer WHERE c_custkey % 4 <> 3'
    ),
    'patient_wide': (
        "SELECT 'T' || CAST(c.c_custkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(c.c_custkey AS STRING) AS PmsPatientId, '
        "CASE WHEN c.c_nationkey % 7 = 6 OR c.c_nationkey % 5 = 0 THEN '0' ELSE CAST(c.c_nationkey AS STRING) END AS PmsLocationId, "
        "CASE WHEN (c.c_custkey % 10 + 1) % 6 = 5 THEN '0' ELSE CAST(c.c_custkey % 10 + 1 AS STRING) END AS PmsProviderId, "
        "CAST(c.c_custkey AS STRING) AS PatientNumber, c.c_name AS FirstName, 'x' AS LastName, "
        "'x' AS PrimaryPhone, 'x' AS PrimaryPhoneType, 'x' AS SecondaryPhone, 'x' AS SecondaryPhoneType, "
        "'x' AS CellPhone, 'x' AS Email, 'x' AS Address1, 'x' AS Address2, 'x' AS City, 'x' AS State, "
        "'x' AS Country, 'x' AS Zip, 'x' AS SSN, 'x' AS Gender, 'x' AS PreferredLanguage, 'x' AS Title, "
        "'x' AS CommunicationChoice1, 'x' AS CommunicationChoice2, 'x' AS CommunicationChoice3, "
        "'x' AS SpendingBehavior, 'x' AS PrimaryInsuranceEIN, 'x' AS PrimaryInsuranceGroupId, "
        "'x' AS PrimaryInsurancePolicyNo, 'x' AS PrimaryInsurancePlanName, 'x' AS SecondaryInsuranceGroupId, "
        "'x' AS SecondaryInsurancePolicyNo, 'x' AS SecondaryInsurancePlanName, "
        "'x' AS TertiaryInsuranceGroupId, 'x' AS TertiaryInsurancePolicyNo, 'x' AS TertiaryInsurancePlanName, "
        "'x' AS PmsSpecificName1, 'x' AS PmsSpecificValue1, 'N' AS ContactLensWearer, "
        "TIMESTAMP '1995-06-01 00:00:00' AS DOB, TIMESTAMP '1995-06-01 00:00:00' AS ICD1Date, "
        "TIMESTAMP '1995-06-01 00:00:00' AS ICD2Date, TIMESTAMP '1995-06-01 00:00:00' AS ICD3Date, "
        "TIMESTAMP '1995-06-01 00:00:00' AS LastVisitOrExamDate, CAST(0 AS INT) AS SurveyEmailPreference, "
        'CAST(0 AS INT) AS SurveySMSPreference, CAST(0 AS INT) AS SurveyVoicePreference, '
        'CAST(0 AS INT) AS SurveyPostalPreference, CAST(0 AS INT) AS ReminderEmailPreference, '
        'CAST(0 AS INT) AS ReminderSMSPreference, CAST(0 AS INT) AS ReminderVoicePreference, '
        'CAST(0 AS INT) AS ReminderPostalPreference, CAST(0 AS INT) AS RecallEmailPreference, '
        'CAST(0 AS INT) AS RecallSMSPreference, CAST(0 AS INT) AS RecallVoicePreference, '
        'CAST(0 AS INT) AS RecallPostalPreference, CAST(0 AS INT) AS PickupEmailPreference, '
        'CAST(0 AS INT) AS PickupSMSPreference, CAST(0 AS INT) AS PickupVoicePreference, '
        'CAST(0 AS INT) AS PickupPostalPreference, CAST(0 AS INT) AS OtherEmailPreference, '
        'CAST(0 AS INT) AS OtherSMSPreference, CAST(0 AS INT) AS OtherVoicePreference, '
        "CAST(0 AS INT) AS OtherPostalPreference, CAST(1 AS INT) AS Status, 'A1' AS ICD1, 'A2' AS ICD2, "
        "'A3' AS ICD3, 'I0' AS InsurerIDPrimary, 'I1' AS InsurerIDSecondary, 'I2' AS InsurerIDTertiary, "
        "CAST(0 AS INT) AS Deleted, TIMESTAMP '1995-01-01 00:00:00' AS PmsCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsLastModifiedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UTCCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UTCLastModifiedDate FROM customer c WHERE c.c_custkey % 10 <> 0"
    ),
    'patient_wide_in': (
        "SELECT 'T' || CAST(c.c_custkey % 3 AS STRING) AS PmsInstanceId, "
        "CASE WHEN c.c_custkey % 9 = 0 THEN ' ' || CAST(c.c_custkey AS STRING) ELSE CAST(c.c_custkey AS STRING) END AS PmsPatientId, "
        'CAST(c.c_nationkey AS STRING) AS PmsLocationId, '
        'CAST(c.c_custkey % 10 + 1 AS STRING) AS PmsProviderId, CAST(c.c_custkey AS STRING) AS PatientNumber, '
        "CASE WHEN c.c_custkey % 6 = 0 THEN c.c_name || '  ' ELSE c.c_name END AS FirstName, 'x' AS LastName, "
        "'x' AS PrimaryPhone, 'x' AS PrimaryPhoneType, 'x' AS SecondaryPhone, 'x' AS SecondaryPhoneType, "
        "'x' AS CellPhone, 'x' AS Email, 'x' AS Address1, 'x' AS Address2, "
        "CASE WHEN c.c_custkey % 11 = 0 THEN NULL WHEN c.c_custkey % 5 = 0 THEN 'moved' ELSE 'x' END AS City, "
        "'x' AS State, 'x' AS Country, 'x' AS Zip, 'x' AS SSN, 'x' AS Gender, 'x' AS PreferredLanguage, "
        "'x' AS Title, 'x' AS CommunicationChoice1, 'x' AS CommunicationChoice2, 'x' AS CommunicationChoice3, "
        "'x' AS SpendingBehavior, 'x' AS PrimaryInsuranceEIN, 'x' AS PrimaryInsuranceGroupId, "
        "'x' AS PrimaryInsurancePolicyNo, 'x' AS PrimaryInsurancePlanName, 'x' AS SecondaryInsuranceGroupId, "
        "'x' AS SecondaryInsurancePolicyNo, 'x' AS SecondaryInsurancePlanName, "
        "'x' AS TertiaryInsuranceGroupId, 'x' AS TertiaryInsurancePolicyNo, 'x' AS TertiaryInsurancePlanName, "
        "'x' AS PmsSpecificName1, 'x' AS PmsSpecificValue1, 'N' AS ContactLensWearer, "
        "TIMESTAMP '1995-06-01 00:00:00' AS DOB, TIMESTAMP '1995-06-01 00:00:00' AS ICD1Date, "
        "TIMESTAMP '1995-06-01 00:00:00' AS ICD2Date, TIMESTAMP '1995-06-01 00:00:00' AS ICD3Date, "
        "TIMESTAMP '1995-06-01 00:00:00' AS LastVisitOrExamDate, "
        'CAST(CASE WHEN c.c_custkey % 10 = 0 THEN NULL WHEN c.c_custkey % 7 = 0 THEN 1 ELSE 0 END AS INT) AS SurveyEmailPreference, '
        'CAST(0 AS INT) AS SurveySMSPreference, CAST(0 AS INT) AS SurveyVoicePreference, '
        'CAST(0 AS INT) AS SurveyPostalPreference, CAST(0 AS INT) AS ReminderEmailPreference, '
        'CAST(0 AS INT) AS ReminderSMSPreference, CAST(0 AS INT) AS ReminderVoicePreference, '
        'CAST(0 AS INT) AS ReminderPostalPreference, CAST(0 AS INT) AS RecallEmailPreference, '
        'CAST(0 AS INT) AS RecallSMSPreference, CAST(0 AS INT) AS RecallVoicePreference, '
        'CAST(0 AS INT) AS RecallPostalPreference, CAST(0 AS INT) AS PickupEmailPreference, '
        'CAST(0 AS INT) AS PickupSMSPreference, CAST(0 AS INT) AS PickupVoicePreference, '
        'CAST(0 AS INT) AS PickupPostalPreference, CAST(0 AS INT) AS OtherEmailPreference, '
        'CAST(0 AS INT) AS OtherSMSPreference, CAST(0 AS INT) AS OtherVoicePreference, '
        "CAST(0 AS INT) AS OtherPostalPreference, CAST(1 AS INT) AS Status, ' A1' AS ICD1, ' A2' AS ICD2, "
        "' A3' AS ICD3, CASE WHEN c.c_custkey % 3 = 0 THEN ' ' ELSE 'I0' END AS InsurerIDPrimary, "
        "(SELECT min(InsurerName) FROM insurer WHERE PmsInsurerId = 'I0') AS InsurerNamePrimary, "
        "CASE WHEN c.c_custkey % 3 = 1 THEN ' ' ELSE 'I1' END AS InsurerIDSecondary, "
        "(SELECT min(InsurerName) FROM insurer WHERE PmsInsurerId = 'I1') AS InsurerNameSecondary, "
        "CASE WHEN c.c_custkey % 3 = 2 THEN ' ' ELSE 'I2' END AS InsurerIDTertiary, "
        "(SELECT min(InsurerName) FROM insurer WHERE PmsInsurerId = 'I2') AS InsurerNameTertiary, "
        "CAST(0 AS INT) AS Deleted, TIMESTAMP '1995-01-01 00:00:00' AS PmsCreatedDate, "
        "CASE WHEN c.c_custkey % 5 = 0 THEN TIMESTAMP '1996-01-01 00:00:00' ELSE TIMESTAMP '1995-01-01 00:00:00' END AS PmsLastModifiedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UTCCreatedDate, "
        "CASE WHEN c.c_custkey % 5 = 0 THEN TIMESTAMP '1996-01-01 00:00:00' ELSE TIMESTAMP '1995-01-01 00:00:00' END AS UTCLastModifiedDate FROM customer c WHERE c.c_custkey % 4 <> 3"
    ),
    'appointment_block': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(o_orderkey AS STRING) AS PmsAppointmentId, '
        "CASE WHEN o_custkey % 25 % 7 = 6 THEN '0' ELSE CAST(o_custkey % 25 AS STRING) END AS PmsLocationId, "
        "CASE WHEN (o_custkey % 10 + 1) % 6 = 5 THEN '0' ELSE CAST(o_custkey % 10 + 1 AS STRING) END AS PmsProviderId, "
        "'0' AS PmsResourceId, CAST(o_orderdate AS DATE) AS StartDate, '09:00' AS StartTime, "
        'CAST(o_orderkey % 4 * 15 AS INT) AS Length, 0 AS Deleted, '
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM orders WHERE o_orderkey % 5 <> 0"
    ),
    'appointment_block_in': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        "CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderkey AS STRING) || ' ' ELSE CAST(o_orderkey AS STRING) END AS PmsAppointmentId, "
        'CAST(o_custkey % 25 AS STRING) AS PmsLocationId, '
        "CAST(o_custkey % 10 + 1 AS STRING) AS PmsProviderId, 'none' AS PmsResourceId, "
        'CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS StartDate, '
        "CASE WHEN o_orderkey % 6 = 0 THEN '10:30' ELSE '09:00' END AS StartTime, "
        'CAST(o_orderkey % 4 * 15 AS INT) AS Length, '
        'CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END AS Deleted FROM orders WHERE o_orderkey % 4 <> 3'
    ),
    'appointment': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(o_orderkey AS STRING) AS PmsAppointmentId, CAST(o_custkey AS STRING) AS PmsPatientId, '
        'CAST(o_custkey % 25 AS STRING) AS PmsLocationId, '
        'CAST(o_custkey % 10 + 1 AS STRING) AS PmsProviderId, '
        "CAST(o_custkey % 40 AS STRING) AS PmsResourceId, 'R1' AS PmsReasonId, "
        "CAST(o_orderdate AS DATE) AS StartDate, '09:00' AS StartTime, CAST(30 AS INT) AS Length, "
        'o_orderstatus AS ApptType, o_orderpriority AS ApptStatus, 1 AS ShowedUp, '
        "CAST(o_totalprice AS DECIMAL(15,2)) AS SpendAmt, 'A1' AS ICD1, 'A2' AS ICD2, 'A3' AS ICD3, "
        "'C1' AS CPT1, 'C2' AS CPT2, 'C3' AS CPT3, 0 AS Deleted, o_orderdate AS PmsCreatedDate, "
        'o_orderdate AS PmsLastModifiedDate, o_orderdate AS UTCCreatedDate, '
        'o_orderdate AS UTCLastModifiedDate FROM orders WHERE o_orderkey % 5 <> 0'
    ),
    'appointment_in': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(o_orderkey AS STRING) AS PmsAppointmentId, CAST(o_custkey AS STRING) AS PmsPatientId, '
        'CAST(o_custkey % 25 AS STRING) AS PmsLocationId, '
        'CAST(o_custkey % 10 + 1 AS STRING) AS PmsProviderId, '
        'CAST(o_custkey % 40 AS STRING) AS PmsResourceId, '
        "CASE WHEN o_orderkey % 3 = 0 THEN 'R1' WHEN o_orderkey % 3 = 1 THEN ' ' ELSE NULL END AS PmsReasonId, "
        "(SELECT min(ReasonName) FROM appointment_reason WHERE PmsReasonId = 'R1') AS ReasonName, "
        'CAST(o_orderdate AS DATE) AS StartDate, '
        "CASE WHEN o_orderkey % 6 = 0 THEN '10:30' ELSE '09:00' END AS StartTime, CAST(30 AS INT) AS Length, "
        "o_orderstatus || ' ' AS ApptType, "
        "CASE WHEN o_orderkey % 8 = 0 THEN o_orderpriority || ' ' ELSE o_orderpriority END AS ApptStatus, 1 AS ShowedUp, "
        'CAST(o_totalprice AS DECIMAL(15,2)) AS SpendAmt, '
        "CASE WHEN o_orderkey % 10 = 1 THEN NULL ELSE 'A1' END AS ICD1, 'A2' AS ICD2, ' A3' AS ICD3, "
        "'C1' AS CPT1, 'C2' AS CPT2, 'C3' AS CPT3, 0 AS Deleted, o_orderdate AS PmsCreatedDate, "
        'o_orderdate AS PmsLastModifiedDate, o_orderdate AS UTCCreatedDate, '
        'o_orderdate AS UTCLastModifiedDate FROM orders WHERE o_orderkey % 4 <> 3'
    ),
    'visit': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(o_orderkey AS STRING) AS PmsVisitId, CAST(o_custkey AS STRING) AS PmsPatientId, '
        'CAST(o_custkey % 25 AS STRING) AS PmsLocationId, '
        'CAST(o_custkey % 10 + 1 AS STRING) AS PmsProviderId, '
        "CASE WHEN o_orderkey % 13 = 1 THEN NULL WHEN o_orderkey % 7 = 0 THEN TIMESTAMP '1999-01-01 00:00:00' ELSE o_orderdate END AS VisitDate, "
        "'Other' AS VisitType, 'Frames' AS ProductType, CAST(o_totalprice AS DECIMAL(15,2)) AS SpendAmt, "
        "'A' || CAST(o_orderkey AS STRING) AS PmsAppointmentId, 'check' AS VisitReason, 1 AS ShowedUp, "
        "'I1' AS ICD1, 'I2' AS ICD2, 'I3' AS ICD3, 'C1' AS CPT1, 'C2' AS CPT2, 'C3' AS CPT3, "
        "'B1' AS ProductBrand1, 'B2' AS ProductBrand2, 'B3' AS ProductBrand3, 0 AS Deleted, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsLastModifiedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM orders WHERE o_orderkey % 5 <> 0"
    ),
    'visit_in': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(o_orderkey AS STRING) AS PmsVisitId, CAST(o_custkey AS STRING) AS PmsPatientId, '
        "CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE CAST(o_custkey % 25 AS STRING) END AS PmsLocationId, "
        'CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 10 + 1 AS STRING) END AS PmsProviderId, '
        'CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS VisitDate, '
        "CASE WHEN o_orderpriority LIKE '1%' THEN 'Exam ' ELSE 'Other' END AS VisitType, "
        "CASE WHEN o_orderkey % 9 = 0 THEN ' Contact Lenses' ELSE 'Frames' END AS ProductType, "
        'CAST(o_totalprice AS DECIMAL(15,2)) AS SpendAmt, '
        "'A' || CAST(o_orderkey AS STRING) AS PmsAppointmentId, 'check' AS VisitReason, 1 AS ShowedUp, "
        "'I1' AS ICD1, 'I2' AS ICD2, 'I3' AS ICD3, 'C1' AS CPT1, 'C2' AS CPT2, 'C3' AS CPT3, "
        "'B1' AS ProductBrand1, 'B2' AS ProductBrand2, 'B3' AS ProductBrand3, 0 AS Deleted, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsLastModifiedDate FROM orders WHERE o_orderkey % 4 <> 3"
    ),
    'product_pickup': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(o_orderkey AS STRING) AS PmsOrderId, CAST(o_custkey AS STRING) AS PmsPatientId, '
        'CAST(o_custkey % 25 AS STRING) AS PmsLocationId, '
        'CAST(o_custkey % 10 + 1 AS STRING) AS PmsProviderId, o_orderdate AS OrderDate, '
        "'Frames' AS ProductType, CAST(o_totalprice AS DECIMAL(15,2)) AS SpendAmt, "
        'o_orderstatus AS OrderStatus, 0 AS Deleted, o_orderdate AS ReceivedDate, '
        'o_orderdate AS NotifiedDate, o_orderdate AS PickedUpDate, o_orderdate AS PricedDate, '
        "o_orderdate AS StatusChangedDate, 'B1' AS ProductBrand1, 'B2' AS ProductBrand2, "
        "'B3' AS ProductBrand3, TIMESTAMP '1995-01-01 00:00:00' AS PmsCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsLastModifiedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM orders WHERE o_orderkey % 5 <> 0"
    ),
    'product_pickup_in': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(o_orderkey AS STRING) AS PmsOrderId, CAST(o_custkey AS STRING) AS PmsPatientId, '
        "CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE CAST(o_custkey % 25 AS STRING) END AS PmsLocationId, "
        'CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 10 + 1 AS STRING) END AS PmsProviderId, '
        'o_orderdate AS OrderDate, '
        "CASE WHEN o_orderkey % 9 = 0 THEN ' Contact Lenses' ELSE 'Frames' END AS ProductType, "
        "CAST(o_totalprice AS DECIMAL(15,2)) AS SpendAmt, o_orderstatus || ' ' AS OrderStatus, 0 AS Deleted, "
        'o_orderdate AS ReceivedDate, o_orderdate AS NotifiedDate, o_orderdate AS PickedUpDate, '
        "o_orderdate AS PricedDate, o_orderdate AS StatusChangedDate, 'B1' AS ProductBrand1, "
        "'B2' AS ProductBrand2, 'B3' AS ProductBrand3, TIMESTAMP '1995-01-01 00:00:00' AS PmsCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsLastModifiedDate FROM orders WHERE o_orderkey % 4 <> 3"
    ),
    'recall': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(o_orderkey AS STRING) AS PmsRecallId, CAST(o_custkey AS STRING) AS PmsPatientId, '
        'CAST(o_custkey % 25 AS STRING) AS PmsLocationId, '
        'CAST(o_custkey % 10 + 1 AS STRING) AS PmsProviderId, o_orderdate AS RecallDate, '
        'substr(o_orderpriority, 1, 1) AS RecallReasonId, 0 AS Deleted, '
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM orders WHERE o_orderkey % 5 <> 0"
    ),
    'recall_in': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        "CAST(o_orderkey AS STRING) AS PmsRecallId, CAST(o_custkey AS STRING) || ' ' AS PmsPatientId, "
        "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_custkey % 25 AS STRING) END AS PmsLocationId, "
        'CAST(o_custkey % 10 + 1 AS STRING) AS PmsProviderId, '
        "CASE WHEN o_orderkey % 6 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' ELSE o_orderdate END AS RecallDate, "
        'CASE WHEN o_orderkey % 2 = 0 THEN substr(o_orderpriority, 1, 1) ELSE NULL END AS PmsRecallReasonId, '
        'o_orderpriority AS ReasonName, 0 AS Deleted FROM orders WHERE o_orderkey % 4 <> 3'
    ),
    'transaction_item': (
        "SELECT 'T' || CAST(l_orderkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(l_orderkey AS STRING) AS PmsTransactionId, '
        'CAST(l_linenumber AS STRING) AS PmsTransactionItemId, 0 AS Deleted, '
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM lineitem"
    ),
    'patient_ids': (
        "SELECT 'T' || CAST(c_custkey % 3 AS STRING) AS PmsInstanceId, "
        "CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS STRING) || ' ' ELSE CAST(c_custkey AS STRING) END AS PmsId FROM customer WHERE c_custkey % 5 = 0"
    ),
    'order_ids': (
        "SELECT 'T' || CAST(o_custkey % 3 AS STRING) AS PmsInstanceId, "
        "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS STRING) || ' ' ELSE CAST(o_orderkey AS STRING) END AS PmsId FROM orders WHERE o_orderkey % 6 = 0"
    ),
    'transaction_ids': (
        "SELECT 'T' || CAST(o_orderkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(o_orderkey AS STRING) AS PmsId FROM orders WHERE o_orderkey % 11 = 0'
    ),
    'slot': (
        "SELECT 'T' || CAST(l_suppkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(l_suppkey AS STRING) AS PmsLocationId, CAST(l_partkey AS STRING) AS PmsProviderId, '
        'CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE CAST(l_orderkey % 7 AS STRING) END AS PmsResourceId, '
        'l_shipdate AS StartDateTime, CAST(l_quantity AS INT) AS Length, l_returnflag AS SlotType, '
        "l_linenumber AS SwimLanes, l_linestatus AS SlotInfo, 'alt' AS PmsAltLocationId, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsLastModifiedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM lineitem WHERE l_orderkey % 6 <> 0"
    ),
    'slot_cleared': (
        "SELECT 'T' || CAST(l_suppkey % 3 AS STRING) AS PmsInstanceId, "
        'CAST(l_suppkey AS STRING) AS PmsLocationId, CAST(l_partkey AS STRING) AS PmsProviderId, '
        'CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE CAST(l_orderkey % 7 AS STRING) END AS PmsResourceId, '
        'l_shipdate AS StartDateTime, CAST(l_quantity AS INT) AS Length, '
        "CASE WHEN l_orderkey % 5 = 0 THEN 'X' ELSE l_returnflag END AS SlotType, l_linenumber AS SwimLanes, "
        "l_linestatus AS SlotInfo, 'alt' AS PmsAltLocationId, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS PmsLastModifiedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate, "
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate FROM lineitem WHERE l_orderkey % 8 <> 0"
    ),
    'slot_ids': (
        'SELECT DISTINCT PmsInstanceId, PmsLocationId, PmsProviderId, Length, '
        "SwimLanes FROM slot WHERE SlotType = 'R' AND Length % 5 = 0"
    ),
}

# The same tables whole, for the statements that need no unmatched rows.
FIXTURE_VIEWS['visit_all'] = FIXTURE_VIEWS['visit'].removesuffix(' WHERE o_orderkey % 5 <> 0')
FIXTURE_VIEWS['slot_all'] = FIXTURE_VIEWS['slot'].removesuffix(' WHERE l_orderkey % 6 <> 0')
