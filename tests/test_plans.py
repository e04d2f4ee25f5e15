"""Physical plan checks: no Python in the hot path, no cartesian products, the
small-batch merge never shuffles the target."""

import datetime as dt

from tessera.operators.merge import merge
from tessera.plans import specs
from tests.util import AS_OF

OLD = dt.datetime(1995, 1, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _frames(spark, n_target=2000, n_source=200):
    t = spark.range(n_target).selectExpr(
        "'T' || CAST(id % 3 AS STRING) AS PmsInstanceId", "CAST(id AS STRING) AS PmsResourceId",
        "'r' || CAST(id AS STRING) AS ResourceName",
        "TIMESTAMP '1995-01-01 00:00:00' AS UtcCreatedDate", "TIMESTAMP '1995-01-01 00:00:00' AS UtcLastModifiedDate",
    )
    s = spark.range(n_source).selectExpr(
        "'T' || CAST(id % 3 AS STRING) AS PmsInstanceId", "CAST(id * 7 AS STRING) AS PmsResourceId",
        "'r' || CAST(id AS STRING) AS ResourceName",
    )
    return t, s


def test_no_python_no_cartesian(spark):
    t, s = _frames(spark)
    r = merge(t, s, specs.RESOURCE, AS_OF)
    for df in (r.snapshot, r.delta):
        p = df._jdf.queryExecution().executedPlan().toString()
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p


def test_small_batch_probes_target_by_broadcast(spark):
    t, s = _frames(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = merge(t, s, specs.RESOURCE, AS_OF, batch_small=True)
        plan = r.snapshot._jdf.queryExecution().executedPlan().toString()
        # Every shuffle whose input contains the target scan (Range 0..2000) has the
        # broadcast semi join on the batch keys below it: only target rows whose
        # key is in the batch are ever shuffled.
        lines = plan.splitlines()

        def subtree(i):
            depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
            out = [lines[i]]
            for ln in lines[i + 1:]:
                if len(ln) - len(ln.lstrip(" :+-")) <= depth:
                    break
                out.append(ln)
            return "\n".join(out)

        exchanges = [subtree(i) for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
        over_target = [e for e in exchanges if "Range (0, 2000" in e]
        assert all("LeftSemi" in e and "BroadcastHashJoin" in e for e in over_target)
        assert any("LeftAnti, BuildRight" in ln and "BroadcastHashJoin" in ln for ln in lines)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_batch_uses_shuffle_joins(spark):
    t, s = _frames(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = merge(t, s, specs.RESOURCE, AS_OF, batch_small=False)
        plan = r.snapshot._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rollup_aggregates_map_side_before_the_shuffle(spark):
    from tessera.operators.rollup import patient_facts

    # One patient holds a third of all visits: the partial aggregate collapses it
    # to one row per map task before any exchange.
    staged = spark.range(30000).selectExpr(
        "'T0' AS PmsInstanceId",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS PmsPatientId",
        "CASE WHEN id % 2 = 0 THEN 'Contact Lenses' ELSE 'Frames' END AS ProductType",
        "'Exam' AS VisitType",
        "TIMESTAMP '2000-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 400 AS INT)) AS VisitDate",
    )
    facts = patient_facts(staged)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    hot = facts.filter("_k = 'hot'").collect()
    assert len(hot) == 1 and hot[0]["_lens"] is True
