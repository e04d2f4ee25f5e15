"""A change feed that can be replayed: sparse values beside a bitmask of the columns that changed.

The sparse delta says NULL both for "unchanged" and for "set to NULL".  Here every
row names its columns: ``ChangedColumns`` has a ``1`` for each snapshot column that
the change wrote a different value to, in the order of the entity's fields (an
insert has them all).  Feeds of many batches fold into one row per key, the latest
written value of each column winning, and old snapshot + folded feed = new snapshot.

Rows are named by their match key (tenant and business key as the merge compares
them), which no update changes.  A key that changes twice in one batch - a batch
that inserts it twice, stored rows that share it - cannot be told apart: folding
fails on it instead of guessing.  Rows without a match key match nothing, so they
are only ever inserted; they are added as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import collated_key, norm_key
from tessera.operators.prepared import KEYS, match_keys
from tessera.operators.staged import written_once
from tessera.plans.specs import MergeSpec

MASK, ORDER = "ChangedColumns", "ChangeOrder"
_INSERT = 1


def changes_of(rows: DataFrame, spec: MergeSpec, new: list[Column], old: dict[str, Column], action: Column) -> DataFrame:
    """The feed of a merge from its changed rows: match key, action, mask and the changed columns' new values.

    ``rows`` have the match key as ``_i`` and ``_k``; ``new`` are the snapshot's
    columns as the merge computes them, ``old`` the target's.
    """
    names = [f.name for f in spec.fields]
    named = [F.col(c).alias(name) for c, name in zip(("_i", "_k"), KEYS, strict=True)]
    wide = rows.select(*named, *new, *[c.alias(f"_old_{n}") for n, c in old.items()], action.alias("ActionPerformed"))
    is_insert = F.col("ActionPerformed") == _INSERT
    bits = {n: is_insert | ~F.col(n).eqNullSafe(F.col(f"_old_{n}")) for n in names}
    mask = F.concat(*[F.when(bits[n], "1").otherwise("0") for n in names])
    return wide.select(*KEYS, *[F.when(bits[n], F.col(n)).alias(n) for n in names], mask.alias(MASK), "ActionPerformed")


def _fail(what: str) -> Column:
    return F.raise_error(F.concat(F.lit(what), F.coalesce(F.col(KEYS[1]).cast("string"), F.lit("NULL")))).cast("boolean")


def _named() -> Column:
    return F.col(KEYS[0]).isNotNull() & F.col(KEYS[1]).isNotNull()


def fold(feed: DataFrame, spec: MergeSpec, order: str = ORDER) -> DataFrame:
    """One row per match key: for every column the latest value written, as ``(at, value)``, or null if none was.

    A partial aggregation: a key that changed a million times is one row per task.
    """

    def latest(position: int, name: str) -> Column:
        written = F.substring(F.col(MASK), position + 1, 1) == "1"
        return F.max(F.when(written, F.struct(F.col(order).alias("at"), F.col(name).alias("value")))).alias(f"_new_{name}")

    named = feed.filter(_named())
    # Only keys are counted, and no row of the count is left: it fails or it is empty.
    twice = F.when(F.count(F.lit(1)) > 1, _fail("several changes of one key at once, key=")).otherwise(F.lit(False))
    counted = named.groupBy(*KEYS, order).agg(twice.alias("_twice")).filter("_twice").drop("_twice")
    columns = [f.name for f in spec.fields]
    changes = named.select(*KEYS, order, *columns, MASK, "ActionPerformed").unionByName(counted, allowMissingColumns=True)
    inserted = F.max(F.col("ActionPerformed") == _INSERT).alias("_inserted")
    return changes.groupBy(*KEYS).agg(*[latest(p, n) for p, n in enumerate(columns)], inserted)


def replay(snapshot: DataFrame, feed: DataFrame, spec: MergeSpec, order: str = ORDER, key_collation: str | None = None) -> DataFrame:
    """``snapshot`` after the changes of ``feed``, in ascending ``order`` (a batch or commit number).

    Columns and types are the snapshot's.  Changes of keys that the snapshot does
    not have must begin with their insert; their rows are added.
    """
    names = [f.name for f in spec.fields]

    def key_of(column: str) -> Column:
        return collated_key(norm_key(F.col(column), spec.key_mode), key_collation)

    keyed = snapshot.select(*names, *match_keys(spec, key_of, stored=False))
    folded = fold(feed, spec, order).withColumnsRenamed(dict(zip(KEYS, ("_i", "_k"), strict=True)))
    folded = written_once(folded, "folded")  # stored rows and added ones both read it

    def value(name: str, stored: bool) -> Column:
        new, kind = F.col(f"_new_{name}"), snapshot.schema[name].dataType
        return F.when(new.isNotNull(), new["value"]).otherwise(F.col(name) if stored else F.lit(None)).cast(kind).alias(name)

    kept = keyed.join(folded, ["_i", "_k"], "left").select(*[value(n, True) for n in names])
    present = keyed.select("_i", "_k").distinct().withColumn("_there", F.lit(True))
    missing = F.raise_error(F.concat(F.lit("a change of a row that is not there, key="), F.col("_k").cast("string"))).cast("boolean")
    # The test names both sides, so that it stays above the join.
    is_added = F.when(F.col("_there").isNull(), F.when(F.col("_inserted"), F.lit(True)).otherwise(missing)).otherwise(F.lit(False))
    added = folded.join(present, ["_i", "_k"], "left").filter(is_added).select(*[value(n, False) for n in names])
    unnamed = feed.filter(~_named()).select(*[F.col(n).cast(snapshot.schema[n].dataType).alias(n) for n in names])
    return kept.unionByName(added).unionByName(unnamed)
