"""Table sources: the driver's parquet tables and the fixture views built on them."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.fixtures_sql import FIXTURE_VIEWS

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Base tables the fixture views read.  Only these are registered, so a query
# never opens a file it does not need.
FIXTURE_BASE_TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of one driver table; filters and projections push down."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_registered: dict[int, str] = {}

# The fixture text replicates rows per tenant with ``CROSS JOIN tenant t`` (a
# 3-row constant).  Spark gets the same rows from a generator instead of a join
# operator: ``LATERAL VIEW explode(array(<tenants>))``.  DuckDB keeps the text.
_TENANTS = re.findall(r"'([^']+)'", FIXTURE_VIEWS["tenant"])
_CROSS_TENANT = re.compile(r"CROSS JOIN tenant t\b")
_EXPLODE_TENANT = (
    "LATERAL VIEW explode(array(" + ", ".join(f"'{t}'" for t in _TENANTS) + ")) t AS PmsInstanceId"
)


def spark_body(name: str) -> str:
    """A fixture body as Spark runs it (tenant replication as a generator)."""
    return _CROSS_TENANT.sub(_EXPLODE_TENANT, FIXTURE_VIEWS[name])


def register_fixtures(spark: SparkSession, sf_dir: str) -> None:
    """Register base tables and every fixture view as session temp views.

    Views are lazy: nothing is read until a query runs, and Catalyst prunes the
    columns and pushes the filters of each view body into the parquet scans.
    Registering for another ``sf_dir`` replaces the views; DataFrames built
    earlier keep the plan they were analysed with.  Registering the same
    ``sf_dir`` again in the same session is a no-op (unless a view went missing).
    """
    key = id(spark._jsparkSession)
    if _registered.get(key) == sf_dir and spark.catalog.tableExists(list(FIXTURE_VIEWS)[-1]):
        return
    for name in FIXTURE_BASE_TABLES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
    for name in FIXTURE_VIEWS:
        spark.sql(spark_body(name)).createOrReplaceTempView(name)
    _registered[key] = sf_dir


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a DataFrame (registers all views for ``sf_dir``)."""
    register_fixtures(spark, sf_dir)
    return spark.table(name)


def oracle_with(*names: str) -> str:
    """``WITH`` prefix that defines the named fixture views (and what they read).

    DuckDB sees the driver tables as views already; the fixture views are
    defined inline so the oracle text is self-contained.
    """
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in needed:
            return
        body = FIXTURE_VIEWS[name]
        for dep in FIXTURE_VIEWS:
            if dep != name and _reads(body, dep):
                visit(dep)
        needed.append(name)

    for n in names:
        visit(n)
    order = [n for n in FIXTURE_VIEWS if n in needed]
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURE_VIEWS[n]})" for n in order)


def _reads(body: str, view: str) -> bool:
    return re.search(rf"\b(FROM|JOIN)\s+{view}\b", body) is not None
