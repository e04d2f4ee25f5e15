"""Fact-to-parent rollups into the patient snapshot (update-only merges, no delta).

* lens wearer: patients with a staged row whose trimmed ``ProductType`` is
  ``'Contact Lenses'`` get ``ContactLensWearer = 'Y'`` and the clock;
* last exam: ``MAX(VisitDate)`` over staged rows with trimmed ``VisitType = 'Exam'``
  and a date, per patient; written only when it is later than the stored date
  (a NULL stored date never advances).

Both facts are aggregated per ``(tenant, trimmed patient id)`` first: the
aggregate is partial on the map side, so a patient holding a third of all
visits costs one row per map task before the shuffle.  The patient snapshot
then takes one left join with that per-patient row (broadcast when the row
bound holds).  Applying both rollups in one pass gives the same rows as the two
statements in sequence: they touch different columns and set the same clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.merge import clock
from tessera.functions.exprs import collated_key, tenant_key
from tessera.plans.specs import TENANT

# The literals the reference compares trimmed columns with.
CONTACT_LENSES = "Contact Lenses"
EXAM = "Exam"


def patient_facts(
    staged: DataFrame, lens: bool = True, exam: bool = True, key_collation: str | None = None
) -> DataFrame:
    """One row per ``(_i, _k)`` patient: ``_lens`` flag and ``_exam`` latest exam date."""
    aggs = []
    if lens:
        is_lens = F.trim(F.col("ProductType")) == F.lit(CONTACT_LENSES)
        aggs.append(F.max(F.when(is_lens, F.lit(True))).alias("_lens"))
    else:
        aggs.append(F.lit(None).cast("boolean").alias("_lens"))
    if exam:
        is_exam = (F.trim(F.col("VisitType")) == F.lit(EXAM)) & F.col("VisitDate").isNotNull()
        aggs.append(F.max(F.when(is_exam, F.col("VisitDate"))).alias("_exam"))
    else:
        aggs.append(F.lit(None).cast("timestamp").alias("_exam"))
    wanted = None
    if lens:
        wanted = F.trim(F.col("ProductType")) == F.lit(CONTACT_LENSES)
    if exam:
        e = (F.trim(F.col("VisitType")) == F.lit(EXAM)) & F.col("VisitDate").isNotNull()
        wanted = e if wanted is None else (wanted | e)
    return (
        staged.filter(wanted & F.col("PmsPatientId").isNotNull())
        .groupBy(tenant_key(TENANT).alias("_i"), collated_key(F.trim(F.col("PmsPatientId")), key_collation).alias("_k"))
        .agg(*aggs)
    )


def apply_patient_facts(
    patient: DataFrame,
    facts: DataFrame,
    as_of: dt.datetime | None = None,
    batch_small: bool | None = None,
    key_collation: str | None = None,
) -> DataFrame:
    """Patient snapshot after the rollups (same columns, same row count).

    ``facts`` has at most one row per distinct patient key of the batch (every
    stored id that matched one trimmed input id trims to that same value), so
    when the batch is under the broadcast bound, so are the facts.
    """
    now = clock(as_of)
    f = F.broadcast(facts) if batch_small else facts
    p = patient.withColumn("_i", tenant_key(TENANT)).withColumn("_k", collated_key(F.trim(F.col("PmsPatientId")), key_collation))
    j = p.join(f, ["_i", "_k"], "left")
    lens = F.coalesce(F.col("_lens"), F.lit(False))
    advance = F.coalesce(F.col("_exam") > F.col("LastVisitOrExamDate"), F.lit(False))
    out = []
    for c in patient.columns:
        lc = c.lower()
        if lc == "contactlenswearer":
            out.append(F.when(lens, F.lit("Y")).otherwise(F.col(c)).alias(c))
        elif lc == "lastvisitorexamdate":
            out.append(F.when(advance, F.col("_exam")).otherwise(F.col(c)).alias(c))
        elif lc == "utclastmodifieddate":
            out.append(F.when(lens | advance, now).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def lens_wearer_rollup(patient: DataFrame, staged: DataFrame, as_of=None, **kw) -> DataFrame:
    return apply_patient_facts(patient, patient_facts(staged, lens=True, exam=False), as_of, **kw)


def last_exam_rollup(patient: DataFrame, staged: DataFrame, as_of=None, **kw) -> DataFrame:
    return apply_patient_facts(patient, patient_facts(staged, lens=False, exam=True), as_of, **kw)


def visit_patient_rollup(patient: DataFrame, staged: DataFrame, as_of=None, **kw) -> DataFrame:
    return apply_patient_facts(patient, patient_facts(staged, lens=True, exam=True), as_of, **kw)
