"""Reference resolution for staging (left lookups, scalar lookups, fallbacks).

* :func:`lookup` - ``LEFT OUTER JOIN dim ON dim.I = in.I AND key(dim.id) = key(in.id)``;
  returns the *stored* dim id.  Duplicate dim keys fan out rows, as the SQL join does.
* :func:`scalar_lookup` - a correlated ``(SELECT id FROM dim WHERE ...)``: at most one
  row per input row, an error when the subquery would return several.  Written as
  an aggregate of the dim by its match key (count + value), then a left join;
  the aggregate makes the right side unique, so no input row is multiplied.

Plan shape:

* reference lists (locations, providers, reasons, insurers) are per-tenant
  lists: a plain left join, which Spark broadcasts when the list's estimated
  size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles
  on ``(tenant, key)`` (AQE splits skewed keys);
* a lookup into a table that grows with the data (the patient snapshot) can be
  given ``probe``: the batch's own keys, already checked to be under the
  broadcast bound by the caller.  The dim is first cut down to those keys by a
  semi join against the *broadcast keys* - a scan plus a hash probe, the dim is
  never shuffled - and only the matching dim rows move.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import collated_key, norm_key, tenant_key
from tessera.plans.specs import TENANT

_seq = itertools.count()


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    dim_key: str,
    take: dict[str, str],
    key_mode: str = "trim",
    tenant: str = TENANT,
    probe: DataFrame | None = None,
    key_collation: str | None = None,
) -> DataFrame:
    """Left-join ``dim`` on ``(tenant, key_mode(df[on]) = key_mode(dim[dim_key]))``.

    ``take`` maps dim columns to new column names on the result (the caller
    decides how to use them: default, fallback, ...).
    """
    n = next(_seq)
    li, lk = f"_l{n}_i", f"_l{n}_k"
    d = dim.select(
        tenant_key(tenant).alias(li),
        collated_key(norm_key(F.col(dim_key), key_mode), key_collation).alias(lk),
        *[F.col(c).alias(alias) for c, alias in take.items()],
    )
    if probe is not None:
        keys = probe.select(
            tenant_key(tenant).alias(li), collated_key(norm_key(F.col(on), key_mode), key_collation).alias(lk)
        )
        d = d.join(F.broadcast(keys.distinct()), [li, lk], "left_semi")
    key = collated_key(norm_key(F.col(on), key_mode), key_collation)
    cond = (tenant_key(tenant) == F.col(li)) & (key == F.col(lk))
    return df.join(d, cond, "left").drop(li, lk)



def scalar_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Column,
    dim_match: str,
    dim_value: str,
    out: str,
    tenant: str = TENANT,
    key_collation: str | None = None,
) -> DataFrame:
    """Add ``out`` (the matching ``dim_value``) and ``out + '_n'`` (how many dim rows match).

    Matching is ``trim(dim_match) = trim(on)`` within the tenant.  Wrap the pair
    with :func:`one_row` where the value is used, so the error is raised only on
    the branch a ``CASE`` actually takes (as the correlated subquery would).
    """
    n = next(_seq)
    li, lk = f"_s{n}_i", f"_s{n}_k"
    d = dim.select(tenant_key(tenant).alias(li), collated_key(F.trim(F.col(dim_match)), key_collation).alias(lk), F.col(dim_value).alias(out))
    d = d.groupBy(li, lk).agg(F.count(F.lit(1)).alias(out + "_n"), F.min(out).alias(out))
    cond = (tenant_key(tenant) == F.col(li)) & (collated_key(F.trim(on), key_collation) == F.col(lk))
    return df.join(d, cond, "left").drop(li, lk)


def one_row(out: str, what: str = "scalar lookup") -> Column:
    """The value of a :func:`scalar_lookup`, or an error when it matched several rows."""
    return F.when(
        F.col(out + "_n") > 1, F.raise_error(F.lit(f"{what} returned more than one row"))
    ).otherwise(F.col(out))
