"""Availability-slot operators: three-way snapshot diff and physical delete by id.

``snapshot_diff(current, previous)`` emits every row of ``current`` whose key is
absent from ``previous`` (action 1), every ``current`` row whose key is present
but whose fingerprint differs (action 2, current values) and every ``previous``
row whose key is absent from ``current`` (action 3, old values).

The reference runs three statements (anti join, inner join, anti join).  Here
both generations are tagged and looked at together, in one of two plan shapes.

Rows beyond the broadcast bound meet once, by key::

    both     = current UNION ALL previous, dealt by key and sorted by key and fingerprint
    per key  = rows on either side; per key and fingerprint: previous rows

A current row comes out once when its key has no previous row, and else once for each
previous row of its key with another fingerprint (all of them less those with its own);
a previous row when its key has no current row.  Every wide row moves once, and no
hash does: hashes do not pack, and would weigh as much as the rows.  Keys that a sketch
finds hot are left to the other shape, which does not bring a key's rows together::

    keys     = per key: rows on either side, lowest and highest fingerprint of either side
    open     = the keys whose two sides are not one and the same fingerprint

A current row is new when its key has no previous row, and else comes out once
for each previous row of its key with another fingerprint: a number, so no pair
is ever built.  It follows from the open key, unless previous rows of the key
differ among themselves; these are counted per fingerprint.  The counted rows are
hashes (128 bits of key, 128 of fingerprint) and the counts partial aggregations,
so a key that holds a third of the rows is a row per task; the wide rows join the
open keys, one row each, and stay where they are when these are few.  Rows with a NULL in
the key match nothing: they are new, or deleted, as in the reference.

String key columns are compared with trailing blanks removed (the T-SQL ``=``
rule); the tenant is compared as is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import collated_key, concat_text, form, tenant_key
from tessera.operators.broadcast import bound, broadcast_if_small
from tessera.operators.merge import DELETE, INSERT, UPDATE, MergeResult, _shuffle_partitions, clock, hot_keys
from tessera.operators.staged import written_once
from tessera.plans.specs import TENANT

SLOT_COLUMNS = (
    "PmsInstanceId", "PmsLocationId", "PmsProviderId", "PmsResourceId", "PmsAltLocationId",
    "StartDateTime", "Length", "SlotType", "SwimLanes", "SlotInfo",
    "PmsCreatedDate", "PmsLastModifiedDate", "UtcCreatedDate", "UtcLastModifiedDate",
)
SLOT_KEY = ("PmsInstanceId", "PmsLocationId", "PmsProviderId", "StartDateTime", "Length", "SwimLanes")
SLOT_DELETE_KEY = ("PmsInstanceId", "PmsLocationId", "PmsProviderId", "Length", "SwimLanes")
SLOT_FINGERPRINT = (
    "PmsLocationId", "PmsProviderId", "PmsResourceId", "PmsAltLocationId", "StartDateTime",
    "Length", "SlotType", "SwimLanes", "SlotInfo",
)
# Columns the tenant purge copies into the cleared-slot archive.
SLOT_ARCHIVE_COLUMNS = SLOT_COLUMNS[:10]
_STRING_KEYS = ("PmsLocationId", "PmsProviderId")


def _key_expr(c: str, collation: str | None = None) -> Column:
    return collated_key(F.rtrim(F.col(c)), collation) if c in _STRING_KEYS else tenant_key(c) if c == TENANT else F.col(c)


def _hashes(name: str, values: list[Column]) -> list[Column]:
    """128 bits over the values, in order, a NULL being a value of its own."""
    values = [*values, *[v.isNull() for v in values]]
    return [F.xxhash64(*values).alias(f"{name}1"), F.xxhash64(F.lit(name), *values).alias(f"{name}2")]


_KEY, _PRINT = ["_k1", "_k2"], ["_f1", "_f2"]


def snapshot_diff(
    current: DataFrame,
    previous: DataFrame,
    key: tuple[str, ...] = SLOT_KEY,
    compare: tuple[str, ...] = SLOT_FINGERPRINT,
    columns: tuple[str, ...] = SLOT_COLUMNS,
    mode: str = "collapse",
    key_collation: str | None = None,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Insert / modify / delete feed between two snapshot generations."""
    keyed = [_key_expr(c, key_collation) for c in key]
    texts = [form("ttext", F.col(c)) for c in compare]
    if mode not in ("collapse", "null_safe"):
        raise ValueError(f"unknown fingerprint mode {mode!r}")
    prints = [concat_text(texts)] if mode == "collapse" else texts
    null_key = F.greatest(*[k.isNull() for k in keyed])
    counts = dict(keyed=keyed, prints=prints, columns=columns, max_broadcast_rows=max_broadcast_rows)
    named, named_before = current.filter(~null_key), previous.filter(~null_key)
    if _few_rows(current, previous, bound(max_broadcast_rows)):
        met = _diff_by_counts(named, named_before, **counts)
    else:
        keys = [df.select(*[h.alias(n) for h, n in zip(_hashes("_k", keyed), ("_i", "_k"), strict=True)]) for df in (named, named_before)]
        hot = hot_keys(keys[0].unionByName(keys[1]), _shuffle_partitions(current))
        one, met = F.xxhash64(*_hashes("_k", keyed)), None
        if hot is not None:
            is_hot = one.isin([r["_h"] for r in hot.collect()])
            met = _diff_by_counts(named.filter(is_hot), named_before.filter(is_hot), **counts)
            named, named_before = named.filter(~is_hot), named_before.filter(~is_hot)
        rest = _diff_by_key(named, named_before, keyed, compare, prints, columns)
        met = rest if met is None else rest.unionByName(met)
    # Rows with a NULL in the key match nothing.
    return met.unionByName(current.filter(null_key).select(*columns, F.lit(INSERT).alias("ActionPerformed"))).unionByName(
        previous.filter(null_key).select(*columns, F.lit(DELETE).alias("ActionPerformed"))
    )


def _few_rows(current: DataFrame, previous: DataFrame, most: int) -> bool:
    return most > 0 and current.count() <= most and previous.count() <= most


def _diff_by_key(
    current: DataFrame, previous: DataFrame, keyed: list[Column], compare: tuple[str, ...], prints: list[Column], columns: tuple[str, ...]
) -> DataFrame:
    """The diff of rows without a NULL in their key, which meet by key in one exchange."""
    named = [*columns, *[c for c in compare if c not in columns]]

    def own(df: DataFrame, side: int) -> DataFrame:
        return df.select(*named, F.lit(side).alias("_before"))

    # Key and print are computed behind the exchange, which carries the rows alone.
    key = [f"_w{n}" for n in range(len(keyed))]
    both = own(current, 0).unionByName(own(previous, 1)).repartition(*keyed)
    both = both.select("*", *[k.alias(w) for k, w in zip(keyed, key, strict=True)], *_hashes("_f", prints))
    by_key, by_print = Window.partitionBy(*key), Window.partitionBy(*key, *_PRINT)
    before, rows = F.col("_before"), both.withColumn("_same", F.sum("_before").over(by_print))
    rows = rows.withColumns({"_ps": F.sum("_before").over(by_key), "_cs": F.sum(1 - before).over(by_key)})
    times = F.when(before == 1, (F.col("_cs") == 0).cast("int")).when(F.col("_ps") == 0, 1).otherwise(F.col("_ps") - F.col("_same"))
    action = F.when(before == 1, F.lit(DELETE)).when(F.col("_ps") == 0, F.lit(INSERT)).otherwise(F.lit(UPDATE))
    out = rows.select(*columns, times.cast("int").alias("_times"), action.alias("_action")).filter("_times > 0")
    return out.select(*columns, F.explode(F.array_repeat("_action", F.col("_times"))).alias("ActionPerformed"))


def _diff_by_counts(
    current: DataFrame, previous: DataFrame, keyed: list[Column], prints: list[Column], columns: tuple[str, ...], max_broadcast_rows: int | None
) -> DataFrame:
    """The diff of rows without a NULL in their key, from a count of hashes; a key's rows stay where they are."""

    def marked(df: DataFrame) -> DataFrame:
        return df.select(*columns, *_hashes("_k", keyed), *_hashes("_f", prints))

    cur, prev = marked(current), marked(previous)

    def counted(df: DataFrame, side: int) -> DataFrame:
        one = [F.lit(int(side == n)).cast("long").alias(c) for n, c in enumerate(("_c", "_p"))]
        return df.select(*_KEY, *_PRINT, *one)

    both = counted(cur, 0).unionByName(counted(prev, 1))
    ends = [f(F.when(side > 0, F.col(c))).alias(f"{s}{c}{n}") for s, side in (("_c", F.col("_c")), ("_p", F.col("_p")))
            for c in _PRINT for n, f in (("a", F.min), ("z", F.max))]
    by_key = both.groupBy(*_KEY).agg(F.sum("_c").alias("_cs"), F.sum("_p").alias("_ps"), *ends)

    def one(side: str) -> Column:
        return (F.col(f"{side}_f1a") == F.col(f"{side}_f1z")) & (F.col(f"{side}_f2a") == F.col(f"{side}_f2z"))

    # A key of one fingerprint on both sides is unchanged; that is nearly every key.
    unchanged = one("_c") & one("_p") & (F.col("_c_f1a") == F.col("_p_f1a")) & (F.col("_c_f2a") == F.col("_p_f2a"))
    open_keys = by_key.filter(~F.coalesce(unchanged, F.lit(False))).select(
        *_KEY, "_cs", "_ps", F.col("_p_f1a").alias("_q1"), F.col("_p_f2a").alias("_q2"), (~one("_p")).alias("_mixed")
    )
    open_keys = written_once(open_keys, "diff")
    here, several = F.col("_cs") > 0, F.col("_mixed") & (F.col("_cs") > 0)
    size = open_keys.agg(F.count_if(here).alias("here"), F.count_if(~here).alias("lost"), F.count_if(several).alias("several")).first()
    keys, lost = open_keys.filter(here), open_keys.filter(~here).select(*_KEY)
    # Rows of a few numbers: their count bounds their bytes.
    keys = F.broadcast(keys) if size["here"] <= bound(max_broadcast_rows) else keys
    lost = F.broadcast(lost) if size["lost"] <= bound(max_broadcast_rows) else lost

    come = cur.join(keys, _KEY)
    # The key's previous rows with another fingerprint: all or none, unless these have several.
    other = F.when((F.col("_f1") == F.col("_q1")) & (F.col("_f2") == F.col("_q2")), 0).otherwise(F.col("_ps"))
    if size["several"]:
        same = counted(prev, 1).join(open_keys.filter(several).select(*_KEY), _KEY, "left_semi").groupBy(*_KEY, *_PRINT).agg(F.count(F.lit(1)).alias("_same"))
        come = come.join(same, [*_KEY, *_PRINT], "left")
        other = F.when(F.col("_mixed"), F.col("_ps") - F.coalesce("_same", F.lit(0))).otherwise(other)
    times = F.when(F.col("_ps") == 0, 1).otherwise(other).cast("int")
    action = F.when(F.col("_ps") == 0, F.lit(INSERT)).otherwise(F.lit(UPDATE))
    come = come.select(*columns, F.explode(F.array_repeat(action, times)).alias("ActionPerformed"))
    gone = prev.join(lost, _KEY, "left_semi")
    return come.unionByName(gone.select(*columns, F.lit(DELETE).alias("ActionPerformed")))


def slot_mark_deleted(
    slots: DataFrame,
    ids: DataFrame,
    as_of: dt.datetime | None = None,
    max_broadcast_rows: int | None = None,
) -> MergeResult:
    """Physical delete of every slot matching an id row on the 5-column key.

    ``StartDateTime`` is not part of the match, so all times of a key go; an id
    listed twice yields two delta rows per slot row (the reference captures the
    join rows).  Snapshot = slots that match no id.
    """
    now = clock(as_of)
    keyed = slots.select("*", *[_key_expr(c).alias(f"_k{i}") for i, c in enumerate(SLOT_DELETE_KEY)])
    idk = ids.select(*[_key_expr(c).alias(f"_k{i}") for i, c in enumerate(SLOT_DELETE_KEY)])
    idk_b, _ = broadcast_if_small(idk, max_broadcast_rows)
    on = [f"_k{i}" for i in range(len(SLOT_DELETE_KEY))]
    captured = keyed.join(idk_b, on, "inner")
    snapshot = keyed.join(idk_b, on, "left_anti").select(*slots.columns)
    delta = captured.select(
        F.col(TENANT),
        F.trim(F.col("PmsLocationId")).alias("PmsLocationId"),
        F.trim(F.col("PmsProviderId")).alias("PmsProviderId"),
        F.col("StartDateTime"),
        F.col("Length"),
        F.col("SwimLanes"),
        now.alias("UtcCreatedDate"),
        F.lit(DELETE).alias("ActionPerformed"),
    )
    return MergeResult(snapshot=snapshot, delta=delta, classified=captured)
