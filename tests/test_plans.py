"""Physical-plan expectations, the driver contract, and a property test."""

from __future__ import annotations

import math

from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from strata.operators import marts as M
from strata.operators.vault import build_vault
from strata.plans import vault_queries as VQ

SF = "/root/testdata/sf0.001"
LOAD = "2024-01-01T00:00:00"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_mart_plan_broadcasts_bounded_hubs_and_aggregates_partially(spark):
    v = VQ.vault_tables(spark, SF)
    mart = M.build_marts(v)["mart_sensor_analysis"]
    text = formatted(mart)
    assert "BroadcastHashJoin" in text
    assert "partial_count" in text and "partial_sum" in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    # column pruning: of eleven columns the readings scan asks for the five that the mart needs
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_extendedprice:double,l_returnflag:string>" in text


def readings_scans(df) -> int:
    """Scans of the readings table in a plan (its columns begin with ``l_``)."""
    return formatted(df).count("ReadSchema: struct<l_")


def method_sizes(df) -> list[int]:
    """Bytes of the largest method of each generated class of a plan (made without AQE, which generates code only as it runs)."""
    debug = getattr(getattr(df.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]


def test_satellite_code_is_short_enough_to_be_compiled(spark):
    """The JVM never compiles a method of more than 8,000 bytes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = VQ.q_sat_seismic(spark, SF)
        sizes = method_sizes(df)
        assert sizes and max(sizes) < 6000
        assert plan(df).count("LOG2(") == plan(df).count("POWER(") == 2  # one each for depth and amplitude
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_each_mart_scans_the_readings_once(spark):
    from strata.sources import analog

    facts = M.facts_from_inputs(**analog.inputs(spark, SF))
    for name, mart in M.marts_from_facts(facts).items():
        assert readings_scans(mart) == 1, name
    summary = formatted(M.marts_from_facts(facts)["mart_survey_summary"])
    assert summary.count("Exchange hashpartitioning") <= 6 or summary.count("Arguments: hashpartitioning") <= 6


def test_yearly_batches_push_their_range(spark):
    from strata.plans.stream_queries import yearly_batches
    from strata.sources import analog

    date, rows = yearly_batches(analog.readings(spark, SF))[0]
    text = formatted(rows)
    assert f"GreaterThanOrEqual(l_shipdate,{date}-01-01T00:00)" in text and "LessThan(l_shipdate," in text


def test_anti_join_and_top_k(spark):
    from strata.operators import checks as C

    v = VQ.vault_tables(spark, SF)
    orphans = C.orphans(v["link_survey_well"], "hub_well_key", v["hub_well"])
    assert "LeftAnti" in formatted(orphans)
    mart = M.build_marts(v)["mart_well_performance"]
    top = M.mart_preview(mart, ["well_id", "source_format"], 20)
    assert "TakeOrderedAndProject" in formatted(top)
    assert top.count() == 20


def test_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F

    from strata.sources import analog

    r = analog.readings(spark, SF).where(F.col("survey_id") == 3).select("well_id")
    text = formatted(r)
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,3)]" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in text


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["survey_type", "total_readings", "avg_amplitude", "data_quality_rate"]
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


readings_st = st.lists(st.tuples(st.integers(1, 3), st.integers(1, 4),
                                 st.one_of(st.none(), st.floats(-100, 100)),
                                 st.one_of(st.none(), st.floats(-1e4, 1e4)),
                                 st.one_of(st.none(), st.integers(0, 2))),
                       min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, phases=(Phase.explicit, Phase.reuse, Phase.generate))
@given(readings_st)
def test_preaggregate_equals_direct_form(spark, rows):
    surveys = spark.createDataFrame([(1, "A", "csv"), (2, "B", "csv"), (2, "B", "sgx"), (3, "C", None)],
                                    "survey_type_id bigint, survey_type string, source_format string")
    wells = spark.createDataFrame([(w, f"W{w}", None, None, "op") for w in (1, 2, 3)],
                                  "well_id bigint, well_name string, location_lat double, "
                                  "location_long double, operator string")
    r = spark.createDataFrame([(*x, None) for x in rows],
                              "survey_id bigint, well_id bigint, depth double, amplitude double, "
                              "quality_flag bigint, ingest_timestamp timestamp_ntz")
    v = build_vault(surveys, wells, r, LOAD)
    pre, direct = M.build_marts(v, preaggregate=True), M.build_marts(v, preaggregate=False)
    for name in M.MART_NAMES:
        for x, y in zip(*(sorted(map(tuple, m[name].collect()), key=str) for m in (pre, direct)), strict=True):
            assert all(p == q or isinstance(p, float) and math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-9) for p, q in zip(x, y)), name
