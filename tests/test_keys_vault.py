"""Keys, hubs, links, satellites and the pandas/Spark decisions D1-D12."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from strata.functions.keys import change_hash, md5_key, number_text, sha256_key, with_change_hash, with_number_texts
from strata.operators import marts as M
from strata.operators.vault import build_vault, pick_column, survey_sat

LOAD = "2024-01-01T00:00:00"


def md5(s: str) -> str:
    return hashlib.md5(s.encode()).hexdigest()


def test_md5_key_matches_python_text(spark):
    df = spark.createDataFrame([(101, 7), (205, 12)], "a bigint, b bigint")
    got = df.select(md5_key("a").alias("h"), md5_key("a", "b").alias("l")).collect()
    assert [(r.h, r.l) for r in got] == [(md5("101"), md5("101_7")), (md5("205"), md5("205_12"))]


def test_null_key_gives_null_hash_not_text_of_null(spark):
    df = spark.createDataFrame([(None, 7)], "a bigint, b bigint")
    r = df.select(md5_key("a").alias("h"), md5_key("a", "b").alias("l")).first()
    assert r.h is None and r.l is None  # never md5("nan") / md5("None_7")


def test_sha256_key_normalises_text(spark):
    df = spark.createDataFrame([("  well a ",), ("WELL A",)], "k string")
    hs = {r.h for r in df.select(sha256_key("k").alias("h")).collect()}
    assert hs == {hashlib.sha256(b"WELL A").hexdigest()}


def exact_text(x):
    """Sign, 53-bit integer, p, exponent of two."""
    m, e = math.frexp(abs(x))
    return f"{'-' if x < 0 else ''}{int(m * 2**53)}p{e - 53}"


def test_change_hash_is_of_exact_values(spark):
    values = [3.5, 4e-7, 3e-7, -0.1, 1e300, 5e-324, 2.0**-900, 1.0, math.nextafter(1.0, 0.0), math.nextafter(2.0**60, 0), 123456.78]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(number_text("v")).collect()] == [exact_text(v) for v in values]
    odd = [0.0, -0.0, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in odd], "v double")
    assert [r[0] for r in df.select(number_text("v")).collect()] == ["0", "0", "inf", "-inf", "nan", None]
    df = spark.createDataFrame([(1e-05, 2.5, 1), (None, 2.5, None)], "depth double, amplitude double, quality_flag bigint")
    got = [r.h for r in df.select(change_hash(df, ["depth", "amplitude", "quality_flag"]).alias("h")).collect()]
    assert got == [md5(f"{exact_text(1e-05)}_{exact_text(2.5)}_1"), md5(f"null_{exact_text(2.5)}_null")]


def test_staged_change_hash_equals_the_expression(spark):
    values = [3.5, 4e-7, -0.1, 1e300, 5e-324, 2.0**-900, math.nextafter(2.0**-900, 0), 2.0**1023, 1.7976931348623157e308, math.nextafter(2.0**60, 0),
              0.0, -0.0, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v, 1.0 / 3, i) for i, v in enumerate(values)], "`v.x` double, w float, i int")
    rows = with_number_texts(df, ["v.x", "w"]).select("i", F.col("`__text_v.x`").alias("got"), number_text("`v.x`").alias("want")).collect()
    assert all(r.got == r.want for r in rows)
    assert [r.got for r in rows[:10]] == [exact_text(v) for v in values[:10]]
    two = df.withColumnRenamed("v.x", "v")
    both = with_change_hash(two, ["v", "w", "i"], "staged").withColumn("one", change_hash(two, ["v", "w", "i"]))
    assert both.columns == ["v", "w", "i", "staged", "one"] and both.filter("staged != one").count() == 0


def test_composite_sha256_trims_each_part(spark):
    df = spark.createDataFrame([(" a ", "b "), ("A", "B")], "x string, y string")
    assert len({r.h for r in df.select(sha256_key("x", "y").alias("h")).collect()}) == 1


def test_means_of_tiny_and_infinite_values(spark):
    s, w, _ = _fixture(spark)
    schema = ("survey_id bigint, well_id bigint, depth double, amplitude double, quality_flag bigint, ingest_timestamp timestamp_ntz")
    def mean(values):
        r = spark.createDataFrame([(101, 1, 1.0, v, 1, None) for v in values], schema)
        direct = M.build_marts(build_vault(s, w, r, LOAD))["mart_sensor_analysis"].first().avg_amplitude
        facts = M.marts_from_facts(M.facts_from_inputs(s, w, r))["mart_sensor_analysis"].first().avg_amplitude
        assert direct == facts or math.isnan(direct)
        return direct
    assert math.isclose(mean([4e-7, 3e-7]), 3.5e-7)
    assert mean([float("inf"), 4.0]) == float("inf") and math.isnan(mean([float("inf"), float("-inf")]))


def test_csv_is_bound_by_name(spark, tmp):
    from strata.sources.files import read_csv_by_name

    with open(f"{tmp}/w.csv", "w") as f:
        f.write("operator,extra,well_id\nop,z,7\n")
    r = read_csv_by_name(spark, f"{tmp}/w.csv", "well_id bigint, well_name string, operator string").first()
    assert (r.well_id, r.well_name, r.operator, r.extra) == (7, None, "op", "z")
    with pytest.raises(ValueError, match="well_name"):
        read_csv_by_name(spark, f"{tmp}/w.csv", "well_id bigint, well_name string", ("well_name",))


def test_marts_from_inputs_equal_those_of_the_vault(spark):
    s, w, r = _fixture(spark)
    a, b = M.build_marts(build_vault(s, w, r, LOAD, keep_source_timestamp=True)), M.marts_from_facts(M.facts_from_inputs(s, w, r))
    for name in M.MART_NAMES:
        assert sorted(map(tuple, a[name].collect()), key=str) == sorted(map(tuple, b[name].collect()), key=str)


def test_pick_column_order_and_default(spark):
    base = spark.createDataFrame([(1, "x", "a", "b", "c")],
                                 "survey_type_id bigint, survey_type string, source_format string, "
                                 "file_format string, format string")
    assert survey_sat(base, LOAD).first().source_format == "a"
    assert survey_sat(base.drop("source_format"), LOAD).first().source_format == "b"
    assert survey_sat(base.drop("source_format", "file_format"), LOAD).first().source_format == "c"
    none = base.drop("source_format", "file_format", "format")
    assert survey_sat(none, LOAD).first().source_format == "csv"
    assert str(pick_column(none, ["format"], "csv")) == str(F.lit("csv"))


def _fixture(spark):
    surveys = spark.createDataFrame(
        [(101, "2D", "csv"), (102, "3D", "csv"), (102, "3D", "sgx"), (None, "orphan", "csv")],
        "survey_type_id bigint, survey_type string, source_format string")
    wells = spark.createDataFrame(
        [(1, "W1", None, None, "op"), (2, "W2", None, None, "op"), (2, "W2", None, None, "op")],
        "well_id bigint, well_name string, location_lat double, location_long double, operator string")
    readings = spark.createDataFrame([
        (101, 1, 10.0, 1.5, 1, None),
        (101, 1, float("nan"), 2.5, 0, None),
        (101, 2, -3.0, None, 2, None),
        (102, 1, 0.0, 4.0, 1, None),
        (102, 9, 5.0, 1.0, 1, None),     # well 9 missing from the master: orphan
        (103, 1, 5.0, 1.0, 1, None),     # survey 103 has no master row
        (None, 1, 5.0, 1.0, 1, None),    # NULL key: rejected
        (101, 2, None, None, None, None),
    ], "survey_id bigint, well_id bigint, depth double, amplitude double, quality_flag bigint, "
       "ingest_timestamp timestamp_ntz")
    from strata.sources.readings import clean_readings
    return surveys, wells, clean_readings(readings)


def test_vault_tables_and_rejects(spark):
    s, w, r = _fixture(spark)
    v = build_vault(s, w, r, LOAD)
    assert v["hub_survey"].count() == 2                     # distinct, NULL key rejected
    assert v["hub_well"].count() == 2
    assert v["sat_survey_details"].count() == 3             # satellites keep what arrived
    assert v["link_survey_well"].count() == 5               # distinct pairs with both keys
    assert v["sat_seismic_data"].count() == 7
    rej = {r.target_table: r for r in v["rejects"].collect()}
    assert set(rej) == {"hub_survey", "link_survey_well"}
    assert v["hub_survey"].where(F.col("load_date") != LOAD).count() == 0


def test_marts_semantics(spark):
    s, w, r = _fixture(spark)
    v = build_vault(s, w, r, LOAD)
    for pre in (True, False):
        marts = M.build_marts(v, preaggregate=pre)
        sensor = {x.survey_type: x for x in marts["mart_sensor_analysis"].collect()}
        # 103 (no master row) and well 9 (orphan) drop out; 102 fans out over two formats.
        assert set(sensor) == {"2D", "3D"}
        d2 = sensor["2D"]
        # survey 101: depths 10, NaN->NULL, -3, NULL -> 2 counted; amplitudes 1.5, 2.5 -> mean 2.0
        assert d2.total_readings == 2
        assert d2.avg_amplitude == 2.0
        assert d2.data_quality_rate == 0.5
        d3 = sensor["3D"]
        assert d3.total_readings == 2 and d3.avg_amplitude == 4.0 and d3.data_quality_rate == 1.0
        well = {(x.well_id, x.source_format): x for x in marts["mart_well_performance"].collect()}
        assert set(well) == {(1, "csv"), (2, "csv"), (1, "sgx")}
        w2 = well[(2, "csv")]
        assert w2.total_readings == 1 and w2.avg_amplitude is None and w2.data_quality_rate == 0.0
        summary = {(x.survey_type, x.source_format): x for x in marts["mart_survey_summary"].collect()}
        assert summary[("2D", "csv")].wells_surveyed_count == 2
        assert summary[("3D", "sgx")].wells_surveyed_count == 2   # link keeps the orphan well


def test_all_null_depth_group_rate_is_null(spark):
    s, w, _ = _fixture(spark)
    r = spark.createDataFrame([(101, 1, None, None, 1, None)],
                              "survey_id bigint, well_id bigint, depth double, amplitude double, "
                              "quality_flag bigint, ingest_timestamp timestamp_ntz")
    m = M.build_marts(build_vault(s, w, r, LOAD))["mart_sensor_analysis"].first()
    assert m.total_readings == 0 and m.avg_amplitude is None and m.data_quality_rate is None


def test_mean_does_not_depend_on_partitions(spark):
    vals = [0.1 * i + 1e-3 for i in range(2000)]
    df = spark.createDataFrame([(101, 1, 1.0, v, 1, None) for v in vals],
                               "survey_id bigint, well_id bigint, depth double, amplitude double, "
                               "quality_flag bigint, ingest_timestamp timestamp_ntz")
    s, w, _ = _fixture(spark)
    for n in (1, 3, 7):
        mart = M.build_marts(build_vault(s, w, df.repartition(n), LOAD))["mart_sensor_analysis"]
        assert math.isclose(mart.first().avg_amplitude, math.fsum(vals) / len(vals), rel_tol=1e-12)


def test_sha256_vault_gives_same_marts(spark):
    s, w, r = _fixture(spark)
    md5_v, sha_v = build_vault(s, w, r, LOAD), build_vault(s, w, r, LOAD, key_hash="sha256")
    k = sha_v["hub_survey"].where(F.col("survey_type_id") == 101).first().hub_survey_key
    assert k == hashlib.sha256(b"101").hexdigest()
    link = sha_v["link_survey_well"].first().link_survey_well_key
    assert len(link) == 64
    for name in M.MART_NAMES:
        a = sorted(map(tuple, M.build_marts(md5_v)[name].collect()), key=str)
        b = sorted(map(tuple, M.build_marts(sha_v)[name].collect()), key=str)
        assert a == b
