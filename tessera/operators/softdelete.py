"""Soft delete by id list: ``MERGE ... WHEN MATCHED THEN UPDATE SET Deleted = 1``.

* matched target rows get ``Deleted = 1`` and the call's clock; unmatched ids are
  ignored; already deleted rows are hit again (no guard, as in the reference);
* one delta row (action 3) per (id row, target row) match, carrying the trimmed
  id from the list;
* an id list that hits one target row twice is rejected (MERGE rule).

The id list is the small side: broadcast behind a row bound, so hit rows are
found by a scan and a hash probe and the snapshot is never shuffled.  Past the
bound, one sort-merge join on ``(tenant, trimmed key)`` (the target's rows move
once; the delta's inner join moves only its two key columns).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import collated_key, tenant_key
from tessera.operators.broadcast import keys_are_small
from tessera.operators.merge import DELETE, MergeResult, clock
from tessera.plans.specs import SoftDeleteSpec


def mark_deleted(
    target: DataFrame,
    ids: DataFrame,
    spec: SoftDeleteSpec,
    as_of: dt.datetime | None = None,
    id_col: str = "PmsId",
    max_broadcast_rows: int | None = None,
    key_collation: str | None = None,
) -> MergeResult:
    now = clock(as_of)
    tenant = spec.tenant
    t = target.withColumn("_i", tenant_key(tenant)).withColumn("_k", collated_key(F.trim(F.col(spec.key)), key_collation))
    t = t.withColumn("_own", F.col(spec.key).cast("string"))
    given = F.trim(F.col(id_col))
    keys = ids.select(
        F.col(tenant).alias("_t"), tenant_key(tenant).alias("_i"), collated_key(given, key_collation).alias("_k"), given.alias("_g")
    )
    small = keys_are_small(keys.select("_i", "_k", "_t", "_g"), max_broadcast_rows)

    # The id list counted per key (a partial aggregation: an id listed a million
    # times is one row per map task before the shuffle).  One left join with it
    # marks the hit rows: broadcast when the id list is under the bound (the
    # target is scanned, not shuffled), else one sort-merge join.
    counted = keys.groupBy("_i", "_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_t"), F.min("_g").alias("_g"))
    counted = F.broadcast(counted) if small else counted
    # The MERGE rule holds in both outputs: a target row hit by two id rows fails the call.
    # (The message names the target's own key, so that the check stays above the
    # join: an id listed twice that matches nothing is ignored.)
    twice = F.raise_error(F.concat(F.lit(f"{spec.entity}: id list hits one row twice, key="), F.col("_own")))
    hit = F.when(F.col("_n") > 1, twice.cast("boolean")).otherwise(F.col("_n").isNotNull())
    snapshot = t.join(counted, ["_i", "_k"], "left").select(
        *[
            F.when(hit, F.lit(1)).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c.lower() == "deleted"
            else F.when(hit, now).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c.lower() == "utclastmodifieddate"
            else F.col(c)
            for c in target.columns
        ]
    )

    # One delta row per (id row, target row).  Every target row with key k is hit
    # by every id row with key k, so "a target row hit twice" is "k listed twice
    # and present" - then the call fails; otherwise each hit row has one id row.
    classified = t.select("_i", "_k", "_own").join(counted, ["_i", "_k"], "inner").filter(hit)
    delta = classified.select(
        F.col("_t").alias(tenant),
        F.col("_g").alias(spec.delta_key),
        now.alias("UtcCreatedDate"),
        F.lit(DELETE).alias("ActionPerformed"),
    )
    return MergeResult(snapshot=snapshot, delta=delta, classified=classified)
