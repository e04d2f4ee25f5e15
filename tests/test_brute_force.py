"""Merge vs a brute-force Python model of the same rules, on random small batches."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.merge import merge
from tessera.plans import specs
from tests.util import AS_OF, rows

OLD = dt.datetime(1995, 1, 1)
KEYS = st.sampled_from(["1", "1 ", " 1", "2", "3", "22", None])
TEXT = st.sampled_from(["a", "a ", " a", "b", "ab", "", None])
TENANTS = st.sampled_from(["T0", "T1"])


def _py_form(name, v):
    if name == "raw":
        return v
    if name in ("trim", "ttext"):
        return None if v is None else v.strip(" ")
    if name == "text":
        return v
    raise AssertionError(name)


def _norm_key(v, mode):
    if v is None:
        return None
    return v.strip(" ") if mode == "trim" else v.rstrip(" ") if mode == "rtrim" else v


def model(target, source, spec, mode="collapse"):
    """Snapshot and delta of a thin merge, computed row by row in Python."""
    names = [f.name for f in spec.fields]
    t_rows = [dict(zip(names, r)) for r in target]
    snapshot, delta = [], []
    matched_targets = set()
    for s in source:
        k = _norm_key(s[spec.source_key], spec.key_mode)
        hits = [i for i, t in enumerate(t_rows)
                if k is not None and t[spec.tenant] == s[spec.tenant] and _norm_key(t[spec.key], spec.key_mode) == k]
        if not hits:
            snapshot.append(tuple(AS_OF if f.insert == "clock" else _py_form(f.insert, s[f.source]) for f in spec.fields))
            delta.append((s[spec.tenant], _py_form("trim", s[spec.source_key]), AS_OF, 1))
            continue
        for i in hits:
            t = t_rows[i]
            matched_targets.add(i)
            changed = False
            for item in spec.fingerprint:
                sv = [_py_form(f, s[c]) for c, f in item]
                tv = [_py_form(f, t[c]) for c, f in item]
                if mode == "collapse":
                    a = None if any(v is None for v in sv) else "".join(sv)
                    b = None if any(v is None for v in tv) else "".join(tv)
                    changed |= a != b
                else:
                    changed |= any(x != y for x, y in zip(sv, tv))
            if changed:
                new = {}
                for f in spec.fields:
                    new[f.name] = (t[f.name] if f.update == "keep" else AS_OF if f.update == "clock"
                                   else _py_form(f.update, s[f.source]))
                t_rows[i] = new
                delta.append((s[spec.tenant], _py_form("trim", s[spec.source_key]), AS_OF, 2))
    snapshot.extend(tuple(t[n] for n in names) for t in t_rows)
    return sorted(snapshot, key=str), sorted(delta, key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.lists(st.tuples(TENANTS, KEYS, TEXT, TEXT), max_size=6, unique_by=lambda r: (r[0], r[1])),
    source=st.lists(st.tuples(TENANTS, KEYS, TEXT, TEXT), max_size=6, unique_by=lambda r: (r[0], (r[1] or "").strip())),
    mode=st.sampled_from(["collapse", "null_safe"]),
)
def test_location_merge_matches_model(spark, target, source, mode):
    spec = specs.LOCATION
    t_full = [(i, k, n, z, OLD, OLD) for i, k, n, z in target
              if k is None or sum(1 for j, kk, *_ in target if j == i and kk is not None and kk.rstrip() == k.rstrip()) == 1]
    tdf = spark.createDataFrame(
        t_full, "PmsInstanceId string, PmsLocationId string, LocationName string, TimeZone string, "
        "UtcCreatedDate timestamp, UtcLastModifiedDate timestamp")
    sdf = spark.createDataFrame(source, "PmsInstanceId string, PmsLocationId string, LocationName string, TimeZone string")
    src_dicts = [dict(zip(["PmsInstanceId", "PmsLocationId", "LocationName", "TimeZone"], r)) for r in source]
    want_snap, want_delta = model(t_full, src_dicts, spec, mode)
    r = merge(tdf, sdf, spec, AS_OF, mode=mode)
    got_snap = sorted(rows(r.snapshot, *[f.name for f in spec.fields]), key=str)
    got_delta = sorted(rows(r.delta, "PmsInstanceId", "PmsLocationId", "UtcCreatedDate", "ActionPerformed"), key=str)
    assert got_snap == want_snap
    assert got_delta == want_delta
