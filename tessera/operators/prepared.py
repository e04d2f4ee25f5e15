"""Targets that are prepared for merging: stored match keys, stored row fingerprints, bucketed tables.

A merge compares trimmed keys, a lower-case tenant and a fingerprint of up to 71
concatenated operands.  Computed from the wide rows these cost a scan of every
column for every batch, and no table layout knows them.  Stored beside the row:

* ``MatchTenant``, ``MatchKey`` - the keys as they are compared.  A table bucketed
  by them joins a large batch bucket by bucket: the batch moves, the target does not;
* ``RowPrint`` - the fingerprint.  The match then reads three narrow columns; the
  wide ones are read for keys that are changed, which are few when a client sends
  its whole table again.

A print belongs to a fingerprint mode (and time resolution): a target that was
prepared with one is merged with the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.exprs import collated_key, concat_text, form, norm_key, tenant_key
from tessera.operators.staged import written_once
from tessera.plans.specs import MergeSpec

PRINT = "RowPrint"
KEYS = ("MatchTenant", "MatchKey")


def row_print(df: DataFrame, spec: MergeSpec, mode: str = "collapse", time_resolution: str | None = None) -> Column:
    """128 bits (hexadecimal) of a row's fingerprint operands: equal prints, no change."""
    names = {f.name.lower(): f for f in df.schema.fields}

    def operand(name: str, form_name: str) -> Column:
        found = names[name.lower()]
        c = F.col(found.name)
        if time_resolution and found.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            c = F.date_trunc(time_resolution, c)
        return form(form_name, c)

    items = [[operand(c, f) for c, f in item] for item in spec.fingerprint]
    values = [concat_text(i) for i in items] if mode == "collapse" else [v for i in items for v in i]
    # Lengths keep the values apart; a NULL is not an empty value.
    texts = [v.cast("string") for v in values]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]))


def prepare(
    snapshot: DataFrame, spec: MergeSpec, mode: str = "collapse", key_collation: str | None = None,
    time_resolution: str | None = None,
) -> DataFrame:
    """``snapshot`` with its match keys and its print, for ``merge(..., stored_print=True, stored_keys=True)``."""
    key = collated_key(norm_key(F.col(spec.key), spec.key_mode), key_collation)
    return snapshot.withColumns(
        {KEYS[0]: tenant_key(spec.tenant), KEYS[1]: key, PRINT: row_print(snapshot, spec, mode, time_resolution)}
    )


def write_bucketed(prepared: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Save a prepared snapshot as a Spark table bucketed and sorted by its match keys.

    Use as many buckets as there are shuffle partitions at least: with fewer Spark
    rather deals both sides anew.
    """
    writer = prepared.write.mode("overwrite").bucketBy(buckets, *KEYS).sortBy(*KEYS).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def open_bucketed(spark: SparkSession, table: str, path: str, like: DataFrame, buckets: int) -> DataFrame:
    """A table that another session wrote to ``path`` with :func:`write_bucketed`, under a name of this session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
    by = ", ".join(KEYS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def match_keys(spec: MergeSpec, key_of: Callable[[str], Column], stored: bool) -> list[Column]:
    """The target's ``_i`` and ``_k``: read as they are stored, or computed."""
    if stored:
        return [F.col(KEYS[0]).alias("_i"), F.col(KEYS[1]).alias("_k")]
    return [tenant_key(spec.tenant).alias("_i"), key_of(spec.key).alias("_k")]


def changed_rows(
    target: DataFrame, source: DataFrame, spec: MergeSpec, mode: str, stored_keys: bool, key_collation: str | None,
    collation: str | None, time_resolution: str | None,
) -> DataFrame:
    """The batch rows of keys that are new to the target or differ from a stored print there.

    The first phase of a merge: it reads the target's keys and prints.  All rows
    of such a key are kept, so the second phase decides (and fails) as it would
    on the whole batch; rows of other keys change nothing and insert nothing.
    """
    if collation:
        raise ValueError("a stored print compares exactly; a collation needs the values")

    def key_of(column: str) -> Column:
        return collated_key(norm_key(F.col(column), spec.key_mode), key_collation)

    named = {"_i": tenant_key(spec.tenant), "_k": key_of(spec.source_key)}
    own = source.withColumns({**named, "_p": row_print(source, spec, mode, time_resolution)})
    stored = target.select(*match_keys(spec, key_of, stored_keys), F.col(PRINT).alias("_stored"))
    # A key's prints in the batch, two at most: more of them differ from any stored one.
    keys = own.select("_i", "_k", "_p").filter(F.col("_i").isNotNull() & F.col("_k").isNotNull()).distinct()
    keys = keys.groupBy("_i", "_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_p").alias("_p"))
    same = (F.col("_n") == 1) & F.col("_p").eqNullSafe(F.col("_stored"))
    # Of keys that are there, those all of whose stored rows have the batch's print are done with.
    done = stored.join(keys, ["_i", "_k"]).groupBy("_i", "_k").agg(F.min(same).alias("_same")).filter("_same")
    # Written: the second phase reads them several times.
    return written_once(own.join(done.select("_i", "_k"), ["_i", "_k"], "left_anti").drop("_i", "_k", "_p"), "changed")
