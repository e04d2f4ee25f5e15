"""SQL text for the DuckDB oracle, rendered from the same specs.

The Spark side builds DataFrame plans; this module writes the *SQL* meaning of
the same operation (LEFT JOIN + CASE + NOT EXISTS + UNION ALL), so the driver can
check the two against each other on the fixture tables.  Nothing here runs on
Spark.
"""

from __future__ import annotations

from tessera.functions.exprs import (
    differs_sql,
    fingerprint_changed_sql,
    form_sql,
    is_blank_sql,
    norm_key_sql,
)
from tessera.plans.specs import DeltaField, Field, MergeSpec

AS_OF_SQL = "TIMESTAMP '2024-01-01 00:00:00'"


def _s(c: str) -> str:
    return f"s__{c.lower()}"


def _t(c: str) -> str:
    return f"t__{c.lower()}"


def _update_sql(f: Field) -> str:
    rule = f.update
    if rule == "keep":
        return _t(f.name)
    if rule == "clock":
        return AS_OF_SQL
    if rule == "later":
        s, t = _s(f.source), _t(f.name)
        return f"CASE WHEN {s} > {t} THEN {s} ELSE {t} END"
    if rule.startswith("cw:"):
        _, test, new, old = rule.split(":")
        s, t = _s(f.source), _t(f.name)
        return (
            f"CASE WHEN {differs_sql(form_sql(test, s), form_sql(test, t))} "
            f"THEN {form_sql(new, s)} ELSE {form_sql(old, t)} END"
        )
    return form_sql(rule, _s(f.source))


def _insert_sql(f: Field) -> str:
    return AS_OF_SQL if f.insert == "clock" else form_sql(f.insert, _s(f.source))


def _delta_sql(d: DeltaField) -> str:
    if d.rule == "clock":
        return AS_OF_SQL
    if d.rule == "action":
        return "_action"
    if d.rule.startswith("sp:"):
        _, ins, test, upd = d.rule.split(":")
        s, t = _s(d.source), _t(d.source)
        return (
            f"CASE WHEN _action = 1 THEN {form_sql(ins, s)} "
            f"WHEN _action = 2 AND {differs_sql(form_sql(test, s), form_sql(test, t))} "
            f"THEN {form_sql(upd, s)} ELSE NULL END"
        )
    return form_sql(d.rule, _s(d.source))


def _source_columns(spec: MergeSpec) -> list[str]:
    cols: dict[str, str] = {}

    def add(c: str) -> None:
        cols.setdefault(c.lower(), c)

    add(spec.tenant)
    add(spec.source_key)
    for f in spec.fields:
        if f.insert != "clock" or f.update not in ("keep", "clock"):
            add(f.source)
    for item in spec.fingerprint:
        for c, _ in item:
            add(c)
    for d in spec.delta:
        if d.rule not in ("clock", "action"):
            add(d.source)
    return list(cols.values())


def merge_ctes(spec: MergeSpec, target: str, source_sql: str, mode: str = "collapse") -> str:
    """CTEs ``src, s, t, j, c`` (comma-led, to follow a fixture ``WITH``)."""
    k = spec.key_mode
    scols = _source_columns(spec)
    sel = ", ".join([f"s.{c} AS {_s(c)}" for c in scols] + [f"t.{f.name} AS {_t(f.name)}" for f in spec.fields])
    items = [[(form_sql(f, _s(c)), form_sql(f, _t(c))) for c, f in item] for item in spec.fingerprint]
    return (
        f",\nsrc AS ({source_sql})"
        f",\ns AS (SELECT *, {spec.tenant} AS _i, {norm_key_sql(spec.source_key, k)} AS _k FROM src)"
        f",\nt AS (SELECT *, {spec.tenant} AS _i, {norm_key_sql(spec.key, k)} AS _k FROM {target})"
        f",\nj AS (SELECT {sel}, t._i IS NOT NULL AS _m FROM s LEFT JOIN t ON s._i = t._i AND s._k = t._k)"
        f",\nc AS (SELECT *, CASE WHEN NOT _m THEN 1 WHEN {fingerprint_changed_sql(items, mode)} THEN 2 "
        f"ELSE 0 END AS _action FROM j)\n"
    )


def merge_snapshot_sql(prefix: str, spec: MergeSpec, target: str, source_sql: str, mode: str = "collapse") -> str:
    names = [f.name for f in spec.fields]
    untouched = ", ".join(f"t.{n} AS {n}" for n in names)
    kept = ", ".join(
        f"CASE WHEN _action = 2 THEN {_update_sql(f)} ELSE {_t(f.name)} END AS {f.name}" for f in spec.fields
    )
    ins = ", ".join(f"{_insert_sql(f)} AS {f.name}" for f in spec.fields)
    return (
        prefix
        + merge_ctes(spec, target, source_sql, mode)
        + f"SELECT {untouched} FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s._i = t._i AND s._k = t._k)\n"
        + f"UNION ALL SELECT {kept} FROM c WHERE _m\n"
        + f"UNION ALL SELECT {ins} FROM c WHERE _action = 1"
    )


def merge_delta_sql(prefix: str, spec: MergeSpec, target: str, source_sql: str, mode: str = "collapse") -> str:
    cols = ", ".join(f"{_delta_sql(d)} AS {d.name}" for d in spec.delta)
    return prefix + merge_ctes(spec, target, source_sql, mode) + f"SELECT {cols} FROM c WHERE _action IN (1, 2)"


def blank_sql(c: str) -> str:
    return is_blank_sql(c)
