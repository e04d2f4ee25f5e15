"""Upsert with change feed (MERGE ... OUTPUT), as one Spark plan.

Every batch row gets an action: 1 (insert: no target row), 2 (update:
fingerprint changed) or 0 (unchanged).  One target row may be updated by at
most one batch row (``raise_error`` otherwise, the MERGE rule), and a target
row hit by several batch rows is kept once.

First the batch ``S`` is collapsed to ``K``, one row per (tenant, key): how many
distinct change fingerprints it has, and two of them with their multiplicity and
a row each.  That is all a target row needs: rows with equal fingerprints act
alike, so of three distinct ones two at least update it.  Both aggregations are
partial, so a key that holds a third of the batch never forms one large group;
and since a target row meets one row of ``K``, action and MERGE rule are
expressions on the joined row - no window, no row number, nothing that has to
stay together.  Two plan shapes, chosen by one size check of the batch:

Small batch (under the broadcast bound) - the target is never shuffled::

    matched   = (T  SEMI JOIN  broadcast(keys S))  JOIN  K  + action
    inserts   = S  ANTI JOIN  keys(matched targets)
    snapshot  = (T  ANTI JOIN  broadcast(keys S))  UNION ALL  project(matched)  UNION ALL  project(inserts)
    delta     = project(matched where action = 2)  UNION ALL  project(inserts)

Large batch - the target's rows are shuffled once, its key columns twice::

    whole     = T  LEFT JOIN  K   on (tenant, key) + action
    matched   = T  INNER JOIN  K, likewise
    inserts   = S  ANTI JOIN  distinct keys(T)
    snapshot  = project(whole)  UNION ALL  project(inserts)
    delta     = project(matched where action = 2)  UNION ALL  project(inserts)

The tenant never partitions alone: the business key is always in the join key,
so one huge tenant spreads over all partitions.  A hot business key of the
target is found by a sketch of the target's keys; its rows are dealt by a salt
and its row of ``K`` is copied for every salt.

``settle=True`` writes the matched and inserted rows (as many as the batch hits)
once and projects snapshot and delta from them: for callers that need both.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import collated_key, concat_text, differs, fingerprint_changed, form, norm_key, tenant_key
from tessera.operators import prepared, replay
from tessera.operators.broadcast import keys_are_small
from tessera.operators.staged import written_once
from tessera.plans.specs import DeltaField, Field, MergeSpec

S, T = "s__", "t__"
INSERT, UPDATE, UNCHANGED, DELETE = 1, 2, 0, 3
#: Keys that the sketch reports as the most frequent, and keys that it tracks.
HOT_KEYS, TRACKED_KEYS = 1_000, 100_000
#: Salts per shuffle partition's share of the rows: the more, the more evenly they fall.
SALTS_PER_SHARE = 8


@dataclass
class MergeResult:
    snapshot: DataFrame
    delta: DataFrame
    classified: DataFrame
    conflicts: DataFrame | None = None
    changes: DataFrame | None = None


class LazyMergeResult(MergeResult):
    """A merge's outputs, each built when it is asked for: a wide entity has hundreds of expressions in each."""

    def __init__(self, **build):
        self._build = build

    snapshot = cached_property(lambda self: self._build["snapshot"]())
    delta = cached_property(lambda self: self._build["delta"]())
    classified = cached_property(lambda self: self._build["classified"]())
    conflicts = cached_property(lambda self: self._build["conflicts"]())
    changes = cached_property(lambda self: self._build["changes"]())


def clock(as_of: dt.datetime | None) -> Column:
    """The call's single clock (``GETUTCDATE()`` read once per call)."""
    if as_of is None:
        as_of = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(as_of).cast("timestamp")


class _Sides:
    """Case-insensitive access to the prefixed source and target columns.

    ``cmp_s`` / ``cmp_t`` give the value as the change tests see it: with
    ``time_resolution`` (e.g. ``"minute"``) timestamps are truncated first (the
    reference's default datetime-to-text conversion has minute resolution); the
    text form is then compared under ``collation`` when one is given (e.g.
    ``UTF8_LCASE_RTRIM``: case and trailing blanks do not count).
    """

    def __init__(self, source: DataFrame, target: DataFrame, collation=None, time_resolution=None, inside: str = ""):
        self._s = {c.lower(): inside + S + c for c in source.columns}
        self._t = {c.lower(): T + c for c in target.columns}
        self._ts = {f.name.lower(): f.dataType.typeName() for f in source.schema.fields}
        self._tt = {f.name.lower(): f.dataType.typeName() for f in target.schema.fields}
        self.collation = collation
        self.time_resolution = time_resolution
        self._cache: dict = {}

    # Column objects are built once per name / form and reused: every Column call
    # is a round trip to the JVM, and the wide specs reuse each column many times.
    def s(self, name: str) -> Column:
        return self._memo(("s", name.lower()), lambda: F.col(self._s[name.lower()]))

    def t(self, name: str) -> Column:
        return self._memo(("t", name.lower()), lambda: F.col(self._t[name.lower()]))

    def fs(self, form_name: str, name: str) -> Column:
        """Source column ``name`` in a value form."""
        return self._memo(("fs", form_name, name.lower()), lambda: form(form_name, self.s(name)))

    def ft(self, form_name: str, name: str) -> Column:
        """Target column ``name`` in a value form."""
        return self._memo(("ft", form_name, name.lower()), lambda: form(form_name, self.t(name)))

    def _memo(self, key, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def _cmp(self, c: Column, type_name: str | None, form_name: str) -> Column:
        if self.time_resolution and type_name in ("timestamp", "timestamp_ntz"):
            c = F.date_trunc(self.time_resolution, c)
        v = form(form_name, c)
        if self.collation and (type_name == "string" or form_name in ("text", "ttext")):
            v = F.collate(v.cast("string"), self.collation)
        return v

    def cmp_s(self, name: str, form_name: str) -> Column:
        return self._memo(
            ("cs", form_name, name.lower()), lambda: self._cmp(self.s(name), self._ts.get(name.lower()), form_name)
        )

    def cmp_t(self, name: str, form_name: str) -> Column:
        return self._memo(
            ("ct", form_name, name.lower()), lambda: self._cmp(self.t(name), self._tt.get(name.lower()), form_name)
        )


def _update_value(f: Field, x: _Sides, now: Column) -> Column:
    rule = f.update
    if rule == "keep":
        return x.t(f.name)
    if rule == "clock":
        return now
    if rule == "later":
        s, t = x.s(f.source), x.t(f.name)
        return F.when(s > t, s).otherwise(t)
    if rule.startswith("cw:"):
        _, test, new, old = rule.split(":")
        changed = differs(x.cmp_s(f.source, test), x.cmp_t(f.name, test))
        return F.when(changed, x.fs(new, f.source)).otherwise(x.ft(old, f.name))
    return x.fs(rule, f.source)


def _insert_value(f: Field, x: _Sides, now: Column) -> Column:
    return now if f.insert == "clock" else x.fs(f.insert, f.source)


def _delta_value(
    d: DeltaField, x: _Sides, now: Column, action: Column, is_insert: Column, is_update: Column
) -> Column:
    if d.rule == "clock":
        return now
    if d.rule == "action":
        return action
    if d.rule.startswith("sp:"):
        _, ins, test, upd = d.rule.split(":")
        changed = differs(x.cmp_s(d.source, test), x.cmp_t(d.source, test))
        return F.when(is_insert, x.fs(ins, d.source)).when(is_update & changed, x.fs(upd, d.source))
    return x.fs(d.rule, d.source)


def hot_keys(keys: DataFrame, partitions: int) -> DataFrame | None:
    """``_h, _copies``: keys with more than a shuffle partition's share of the rows, and into how many salts to deal them.

    One pass over ``_i, _k`` with a sketch per task; None when no key is hot.  At
    most HOT_KEYS rows, so the result may be broadcast.
    """
    found = keys.select(F.xxhash64("_i", "_k").alias("_h")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(_h, {HOT_KEYS}, {TRACKED_KEYS})").alias("top")
    )
    row = found.first()
    share = row["n"] / partitions
    hot = [(r[0], math.ceil(SALTS_PER_SHARE * r[1] / share)) for r in row["top"] or [] if r[1] > share / 2 and r[1] > 1]
    return keys.sparkSession.createDataFrame(hot, "_h long, _copies int") if hot else None


def _salted(df: DataFrame, hot: DataFrame | None, copy: bool) -> DataFrame:
    """``df`` with ``_salt``: a hot key's rows dealt over its salts, or copied for each of them."""
    if hot is None:
        return df.withColumn("_salt", F.lit(0))
    h = df.withColumn("_h", F.xxhash64("_i", "_k")).join(F.broadcast(hot), "_h", "left")
    if copy:
        salts = F.when(F.col("_copies").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_copies") - 1))
        return h.withColumn("_salt", F.explode(salts)).drop("_h", "_copies")
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_copies")).cast("int")
    return h.withColumn("_salt", F.coalesce(dealt, F.lit(0))).drop("_h", "_copies")


def merge(
    target: DataFrame,
    source: DataFrame,
    spec: MergeSpec,
    as_of: dt.datetime | None = None,
    mode: str = "collapse",
    batch_small: bool | None = None,
    batch_keys: DataFrame | None = None,
    max_broadcast_rows: int | None = None,
    collation: str | None = None,
    time_resolution: str | None = None,
    key_collation: str | None = None,
    settle: bool = False,
    split_hot_keys: bool | None = None,
    on_conflict: str = "raise",
    stored_print: bool = False,
    stored_keys: bool = False,
    changed_columns: bool = False,
) -> MergeResult:
    """Merge a staged batch into a snapshot; return new snapshot, delta and the classified rows.

    ``mode`` picks the fingerprint comparison: ``collapse`` (reference-faithful
    NULL handling) or ``null_safe`` (every operand compared on its own).
    ``batch_small`` is the caller's size check of the batch (taken on the raw
    input, before staging); when ``None`` the staged keys are measured here.
    ``batch_keys`` is the raw batch before staging: staging keeps every input row
    and its key, so its keys are the staged keys, without re-running the lookups
    for the target probe and the anti join.
    ``collation`` / ``time_resolution`` change what counts as a change (see
    ``_Sides``), ``key_collation`` which keys are equal; the default compares
    full values exactly.
    ``settle`` writes matched and inserted rows once (see above).
    ``split_hot_keys``: look for hot keys of the target; by default in the
    large shape, where the target is shuffled.
    ``on_conflict``: a target row that several batch rows would update fails the
    call (``"raise"``), or stays as it is (``"report"``); ``conflicts`` lists the batch
    rows of all such keys either way.
    ``stored_print`` / ``stored_keys``: the target carries its row fingerprint or its
    match keys (:mod:`tessera.operators.prepared`), and so does the new snapshot.
    With a stored print the match reads keys and print alone, and only batch rows
    whose key is new or changed meet the wide rows.
    ``changed_columns``: also return ``changes``, a feed that can be replayed
    (:mod:`tessera.operators.replay`).
    """
    if on_conflict not in ("raise", "report"):
        raise ValueError(f"unknown conflict rule {on_conflict!r}")
    now = clock(as_of)
    tenant = spec.tenant
    if stored_print:
        same = dict(collation=collation, time_resolution=time_resolution)
        source = prepared.changed_rows(target, source, spec, mode, stored_keys, key_collation, **same)
        batch_small, batch_keys = None, None  # what is left of the batch decides
    x = _Sides(source, target, collation, time_resolution)
    tschema = {f.name.lower(): f.dataType for f in target.schema.fields}

    def key_of(column: str) -> Column:
        return collated_key(norm_key(F.col(column), spec.key_mode), key_collation)

    s = source.select(
        *[F.col(c).alias(S + c) for c in source.columns],
        tenant_key(tenant).alias("_i"),
        key_of(spec.source_key).alias("_k"),
        F.lit(True).alias("_s"),
    )
    t = target.select(
        *[F.col(c).alias(T + c) for c in target.columns],
        *prepared.match_keys(spec, key_of, stored_keys),
        F.lit(True).alias("_t"),
    )
    if batch_keys is not None:
        keys = batch_keys.select(tenant_key(tenant).alias("_i"), key_of(spec.source_key).alias("_k"))
    else:
        keys = s.select("_i", "_k")
    small = batch_small if batch_small is not None else keys_are_small(keys, max_broadcast_rows)

    def typed(name: str, c: Column) -> Column:
        return c.cast(tschema[name.lower()]).alias(name)

    # Each projection is built once, when an output asks for it.
    act = F.col("_action")
    is_insert, is_update = act == INSERT, act == UPDATE
    is_change = act.isin(INSERT, UPDATE)

    @cache
    def snapshot_cols() -> list[Column]:
        return [
            typed(
                f.name,
                F.when(is_insert, _insert_value(f, x, now))
                .when(is_update, _update_value(f, x, now))
                .otherwise(x.t(f.name)),
            )
            for f in spec.fields
        ]

    @cache
    def delta_cols() -> list[Column]:
        return [_delta_value(d, x, now, act, is_insert, is_update).alias(d.name) for d in spec.delta]

    def delta_rows(df: DataFrame) -> DataFrame:
        return df.filter(is_change).select(*delta_cols())

    # Columns that the snapshot carries besides the entity's own.
    carried = [prepared.PRINT] * stored_print + list(prepared.KEYS) * stored_keys
    keep = [x.t(c).alias(c) for c in carried]

    def snapshot_rows(df: DataFrame) -> DataFrame:
        if not carried:
            return df.select(*snapshot_cols())
        keys_now = [F.col(c).alias(name) for c, name in zip(("_i", "_k"), prepared.KEYS, strict=True)] * stored_keys
        prints = [x.t(prepared.PRINT).alias(prepared.PRINT)] * stored_print
        out = df.select(*snapshot_cols(), *prints, *keys_now, is_change.alias("_new"))
        if stored_print:
            fresh = prepared.row_print(out, spec, mode, time_resolution)
            out = out.withColumn(prepared.PRINT, F.when(F.col("_new"), fresh).otherwise(F.col(prepared.PRINT)))
        return out.drop("_new")

    # K: the batch collapsed to one row per distinct change fingerprint with its
    # multiplicity, then to one row per key with two of these (they differ when
    # there are two).  Inserts use the raw batch.
    if mode == "collapse":
        fp = [concat_text([x.cmp_s(c, f) for c, f in item]) for item in spec.fingerprint]
    else:
        fp = [x.cmp_s(c, f) for item in spec.fingerprint for c, f in item]
    payload = [c for c in s.columns if c not in ("_i", "_k")]
    matchable = s.filter(F.col("_i").isNotNull() & F.col("_k").isNotNull())
    by_print = matchable.groupBy("_i", "_k", *[e.alias(f"_f{n}") for n, e in enumerate(fp)]).agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.first(F.struct(*payload)).alias("row")).alias("_c")
    )
    k = by_print.groupBy("_i", "_k").agg(
        F.count(F.lit(1)).alias("_prints"), F.first("_c").alias("_c1"), F.last("_c").alias("_c2")
    )

    # Classified: a target row beside the one batch row that may update it.
    sides = [_Sides(source, target, collation, time_resolution, inside=f"_c{n}.row.") for n in (1, 2)]
    prints, in_k = F.col("_prints"), F.col("_prints").isNotNull()
    changed = [
        fingerprint_changed([[(y.cmp_s(c, f), x.cmp_t(c, f)) for c, f in item] for item in spec.fingerprint], mode)
        for y in sides
    ]
    second = (prints > 1) & F.col("_ch2")
    updates = (
        F.when(F.col("_ch1"), F.col("_c1.n")).otherwise(0)
        + F.when(second, F.col("_c2.n")).otherwise(0)
        + F.when(prints > 2, F.lit(2)).otherwise(0)
    )

    def classified_rows(joined: DataFrame) -> DataFrame:
        tested = joined.withColumns({"_ch1": changed[0], "_ch2": F.when(prints > 1, changed[1]).otherwise(F.lit(False))})
        counted = tested.withColumn("_n_upd", F.when(in_k, updates))
        action = F.when(in_k, F.when(F.col("_n_upd") > 0, F.lit(UPDATE)).otherwise(F.lit(UNCHANGED)))
        row = F.when(second & ~F.col("_ch1"), F.col("_c2.row")).otherwise(F.col("_c1.row"))
        kept = [c for c in joined.columns if c not in ("_c1", "_c2", "_prints", "_salt")]
        return counted.select(*kept, "_n_upd", action.alias("_action"), row.alias("_row")).select(
            *kept, "_n_upd", "_action", "_row.*"
        )

    def ruled(df: DataFrame) -> DataFrame:
        """The MERGE rule on classified rows."""
        if on_conflict == "report":
            return df.withColumn("_action", F.when(F.col("_n_upd") > 1, F.lit(UNCHANGED)).otherwise(act))
        several = F.concat(
            F.lit(f"{spec.entity}: several source rows update one target row, key="),
            F.coalesce(x.t(spec.key).cast("string"), F.lit("NULL")),
        )
        return df.filter(F.when(F.col("_n_upd") > 1, F.raise_error(several)).otherwise(F.lit(True)))

    def with_null_target(df: DataFrame) -> DataFrame:
        return df.select(
            "*",
            *[F.lit(None).cast(f.dataType).alias(T + f.name) for f in target.schema.fields],
            F.lit(None).cast("boolean").alias("_t"),
            F.lit(0).cast("long").alias("_n_upd"),
            F.lit(INSERT).alias("_action"),
        )

    if small:
        # Batch keys broadcast: the target is scanned and probed, never shuffled.
        kb = F.broadcast(keys.distinct())
        probed = t.join(kb, ["_i", "_k"], "left_semi")
        present = probed.select("_i", "_k")
        rest = t.join(kb, ["_i", "_k"], "left_anti")
    else:
        probed, present, rest = t, t.select("_i", "_k").distinct(), None
    split = not small if split_hot_keys is None else split_hot_keys
    hot = hot_keys(probed.select("_i", "_k"), _shuffle_partitions(target)) if split else None
    on = ["_i", "_k"] if hot is None else ["_i", "_k", "_salt"]
    hit = matchable.select("_i", "_k").distinct()  # the keys of K, without its prints and rows
    if hot is not None:
        probed, k, hit = _salted(probed, hot, copy=False), _salted(k, hot, copy=True), _salted(hit, hot, copy=True)
    pairs = classified_rows(probed.join(k, on, "inner"))
    inserts = with_null_target(s.join(present, ["_i", "_k"], "left_anti"))
    matched = ruled(pairs)
    if settle:
        settled = written_once(matched.unionByName(inserts), "settled")
        matched, inserts = settled.filter(act != INSERT), settled.filter(act == INSERT)

    def snapshot() -> DataFrame:
        if small or settle:
            others = probed.join(hit, on, "left_anti") if rest is None else rest
            untouched = others.select(*[x.t(f.name).alias(f.name) for f in spec.fields], *keep)
            return untouched.unionByName(snapshot_rows(matched)).unionByName(snapshot_rows(inserts))
        # Target rows that no batch row touches come from the same join, from its left side.
        whole = ruled(classified_rows(probed.join(k, on, "left")))
        return snapshot_rows(whole).unionByName(snapshot_rows(inserts))

    def changes() -> DataFrame | None:
        if not changed_columns:
            return None
        both = matched.unionByName(inserts, allowMissingColumns=True).filter(is_change)
        return replay.changes_of(both, spec, snapshot_cols(), {f.name: x.t(f.name) for f in spec.fields}, act)

    return LazyMergeResult(
        snapshot=snapshot,
        delta=lambda: delta_rows(matched).unionByName(delta_rows(inserts)),
        classified=lambda: matched.unionByName(inserts, allowMissingColumns=True),
        conflicts=lambda: _conflicts(pairs, s, source),
        changes=changes,
    )


def _conflicts(pairs: DataFrame, s: DataFrame, source: DataFrame) -> DataFrame:
    """The batch rows of every key with a target row that several of them would update.

    Columns: the batch's own, and ``n_targets``, how many target rows they leave undecided.
    """
    undecided = pairs.filter(F.col("_n_upd") > 1).groupBy("_i", "_k").agg(F.count(F.lit(1)).alias("n_targets"))
    return s.join(undecided, ["_i", "_k"]).select(*[F.col(S + c).alias(c) for c in source.columns], "n_targets")


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
