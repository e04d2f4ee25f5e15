"""Broadcast only behind a proven size bound.

``F.broadcast`` ships a whole relation to every executor.  That is right for a
batch of ids or a per-tenant reference list and wrong for anything that grows
with the data.  The check here is an exact row count of the (batch-sized)
relation.  ``count()`` is a partial aggregation: every task sends one number,
nothing else moves.  (``limit(n + 1).count()`` looks cheaper but plans a
single-partition exchange after a per-partition limit, so on thousands of
partitions up to ``n`` rows from *each* would funnel into one task.)  The batch
is scanned once more; the target never is.  Beyond the bound the caller gets
the plain relation and Spark plans a shuffle join (with AQE free to re-plan it
at runtime from real statistics).
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a join key set / lookup list we are willing to broadcast.  Key rows are
# narrow (tenant id + business id, ~80 bytes), so 2M rows stay well under the
# 8 GB hard broadcast limit and typical executor memory.
# ``TESSERA_MAX_BROADCAST_ROWS`` overrides it (0 forces the shuffle plans, as the
# tests do to check both plan shapes against the oracle).
DEFAULT_MAX_BROADCAST_ROWS = int(os.environ.get("TESSERA_MAX_BROADCAST_ROWS", 2_000_000))
# Bytes of the strings in such a key set; names may be of any width.
MAX_BROADCAST_BYTES = 256 << 20


def bound(max_rows: int | None = None) -> int:
    """The bound of a call: its own, or the default as it is at the time of the call."""
    return DEFAULT_MAX_BROADCAST_ROWS if max_rows is None else max_rows


def row_count_at_most(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` has no more than ``max_rows`` rows (one distributed count; none when the bound is 0)."""
    return bound(max_rows) > 0 and df.count() <= bound(max_rows)


def keys_are_small(keys: DataFrame, max_rows: int | None = None, columns: list[str] | None = None) -> bool:
    """True when rows and text bytes of a key set are both under their bounds (one partial aggregation).

    ``columns``: the key columns, where ``keys`` has others too.
    """
    if bound(max_rows) <= 0:
        return False
    strings = [f.name for f in keys.schema.fields if f.dataType.typeName() == "string" and (columns is None or f.name in columns)]
    widths: list[Column] = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long") for c in strings]
    size = reduce(lambda a, b: a + b, widths, F.lit(0).cast("long"))
    row = keys.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return row["n"] <= bound(max_rows) and (row["b"] or 0) <= MAX_BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when the row bound holds, else ``(df, False)``."""
    if keys_are_small(df, max_rows):
        return F.broadcast(df), True
    return df, False
