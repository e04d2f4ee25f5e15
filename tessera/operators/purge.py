"""Tenant purge: remove every row of one tenant from a snapshot table.

The reference deletes in 1,000-row transactions to stay under lock escalation.
Spark has no row locks: the purge is one filter.  What the loop produced is
kept as data:

* ``kept``    the table without the tenant's rows (rows with a NULL tenant stay);
* ``delta``   one thin row per removed row (tenant, clock, action 3, no business
              id) - for every table except the slot table;
* ``archive`` for the slot table, the removed rows' 10 slot columns, destined for
              the cleared-slot table (the intended copy: exactly the removed rows);
* ``report``  one row: table, rows deleted, loop iterations ``floor(n/1000)+1``.

With the snapshot stored partitioned by tenant, ``filter(tenant == X)`` reads one
partition and the publish step drops it; nothing else is rewritten.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import tenant_key
from tessera.operators.diff import SLOT_ARCHIVE_COLUMNS
from tessera.operators.merge import DELETE, clock
from tessera.plans.specs import TENANT

# Fixed value: the reference's delete batch size (used for the iteration count).
BATCH_SIZE = 1000


@dataclass
class PurgeResult:
    kept: DataFrame
    delta: DataFrame | None
    archive: DataFrame | None
    report: DataFrame


def purge_tenant(
    table: DataFrame,
    tenant_id: str,
    table_name: str,
    is_slot_table: bool = False,
    as_of: dt.datetime | None = None,
) -> PurgeResult:
    now = clock(as_of)
    own = F.lower(F.lit(tenant_id))
    removed = table.filter(tenant_key(TENANT) == own)
    kept = table.filter(~tenant_key(TENANT).eqNullSafe(own))
    delta = archive = None
    if is_slot_table:
        archive = removed.select(*SLOT_ARCHIVE_COLUMNS)
    else:
        delta = removed.select(
            F.col(TENANT), now.alias("UtcCreatedDate"), F.lit(DELETE).alias("ActionPerformed")
        )
    n = F.count(F.lit(1))
    report = removed.agg(
        F.lit(table_name).alias("table_name"),
        n.alias("rows_deleted"),
        (F.floor(n / F.lit(BATCH_SIZE)) + F.lit(1)).cast("long").alias("iterations"),
    )
    return PurgeResult(kept=kept, delta=delta, archive=archive, report=report)
