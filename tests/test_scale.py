"""Skewed keys, the broadcast bound, the stream and the end-to-end load."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from strata.operators import marts as M
from strata.operators.vault import build_vault
from strata.plans import joins
from strata.plans.flow import run_load
from strata.streaming.incremental_stream import load_readings_stream

LOAD = "2024-01-01T00:00:00"
RSCHEMA = ("survey_id bigint, well_id bigint, depth double, amplitude double, quality_flag bigint, "
           "ingest_timestamp timestamp_ntz")


def masters(spark):
    surveys = spark.createDataFrame([(s, f"T{s % 3}", "csv") for s in range(1, 11)],
                                    "survey_type_id bigint, survey_type string, source_format string")
    wells = spark.createDataFrame([(w, f"W{w}", None, None, "op") for w in range(1, 51)],
                                  "well_id bigint, well_name string, location_lat double, "
                                  "location_long double, operator string")
    return surveys, wells


def skewed_rows(n=3000):
    rows = []
    for i in range(n):
        if i % 3 == 0:                       # a third of all rows on one link
            s, w = 1, 1
        else:
            s, w = 1 + i % 10, 1 + i % 50
        rows.append((s, w, float(i % 17), round((i % 101) * 0.37, 2), i % 2, None))
    return rows


def brute_sensor(rows):
    df = pd.DataFrame(rows, columns=["survey_id", "well_id", "depth", "amplitude", "quality_flag", "ts"])
    df["survey_type"] = df.survey_id.map(lambda s: f"T{s % 3}")
    g = df.groupby("survey_type")
    out = pd.DataFrame({"total_readings": g.depth.count(), "avg_amplitude": g.amplitude.mean(),
                        "n_flags": g.quality_flag.apply(lambda x: (x == 1).sum())})
    out["data_quality_rate"] = out["n_flags"] / out["total_readings"]
    return out


def test_hot_link_marts_match_brute_force(spark):
    rows = skewed_rows()
    s, w = masters(spark)
    r = spark.createDataFrame(rows, RSCHEMA).repartition(6)
    v = build_vault(s, w, r, LOAD)
    exp = brute_sensor(rows)
    for pre in (True, False):
        got = {x.survey_type: x for x in M.build_marts(v, preaggregate=pre)["mart_sensor_analysis"].collect()}
        assert set(got) == set(exp.index)
        for k, e in exp.iterrows():
            assert got[k].total_readings == e.total_readings
            assert abs(got[k].avg_amplitude - e.avg_amplitude) < 1e-9
            assert abs(got[k].data_quality_rate - e.data_quality_rate) < 1e-12


def test_link_facts_aggregates_before_the_shuffle(spark):
    s, w = masters(spark)
    v = build_vault(s, w, spark.createDataFrame(skewed_rows(300), RSCHEMA), LOAD)
    text = M.link_facts(v)._jdf.queryExecution().executedPlan().toString()
    # the partial aggregate sits below (before) the exchange on the link key
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(link_survey_well_key")


def test_broadcast_only_under_the_bound(spark):
    s, w = masters(spark)
    v = build_vault(s, w, spark.createDataFrame(skewed_rows(300), RSCHEMA), LOAD)
    hub = v["hub_well"].select("hub_well_key", "well_id")
    small = joins.maybe_broadcast(hub, max_bytes=100_000, bound_source=w)
    big = joins.maybe_broadcast(hub, max_bytes=1000, bound_source=w)
    link = v["link_survey_well"]
    plan_small = link.join(small, "hub_well_key")._jdf.queryExecution().optimizedPlan().toString()
    plan_big = link.join(big, "hub_well_key")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan_small
    assert "strategy=broadcast" not in plan_big


def test_stream_loads_each_file_once(spark, tmp):
    rows = skewed_rows(400)
    r = spark.createDataFrame(rows, RSCHEMA)
    inbox, vault, ckpt = f"{tmp}/in", f"{tmp}/vault", f"{tmp}/ckpt"
    r.where(F.col("survey_id") <= 5).write.parquet(inbox)
    first = load_readings_stream(spark, inbox, r.schema, vault, ckpt, LOAD)
    again = load_readings_stream(spark, inbox, r.schema, vault, ckpt, LOAD)
    assert first["batches"] >= 1 and again["batches"] == 0
    r.where(F.col("survey_id") > 5).write.mode("append").parquet(inbox)
    third = load_readings_stream(spark, inbox, r.schema, vault, ckpt, LOAD)
    assert third["batches"] >= 1
    links = spark.read.parquet(f"{vault}/link_survey_well").count()
    assert links == len({(x[0], x[1]) for x in rows})
    r.limit(1).withColumn("well_id", F.lit(None).cast("bigint")).write.mode("append").parquet(inbox)
    assert load_readings_stream(spark, inbox, r.schema, vault, ckpt, LOAD)["rejects"] == 1
    assert spark.read.parquet(f"{vault}/rejects").count() == 1


def test_batches_do_not_decide_what_is_stored(spark, tmp):
    from strata.operators.incremental import IncrementalVault

    rows = skewed_rows(60) + [(1, 1, 0.0, 0.0, 0, None)] * 3 + [(None, 4, 1.0, 1.0, 0, None)]
    s, w = masters(spark)
    stored = []
    for n in (1, 3):
        vault = IncrementalVault(f"{tmp}/{n}")
        for i in range(n):
            vault.load(spark, build_vault(s, w, spark.createDataFrame(rows[i::n], RSCHEMA), LOAD))
        tables = ("hub_survey", "hub_well", "link_survey_well", "sat_seismic_data", "sat_survey_details", "sat_well_details", "rejects")
        stored.append({t: sorted(map(str, vault.table(spark, t).collect())) for t in tables})
    assert stored[0] == stored[1] and len(stored[0]["rejects"]) == 1


def test_of_equal_readings_the_earliest_stays(spark):
    from strata.operators.incremental import new_sat_rows

    df = spark.createDataFrame([("p", "h", 3, "c"), ("p", "h", None, "a"), ("p", "h", 2, "b"), ("q", "h", None, "d")],
                               "link_survey_well_key string, source_hash string, ingest_timestamp int, x string")
    out = {r.link_survey_well_key: (r.ingest_timestamp, r.x) for r in new_sat_rows(df, None, "link_survey_well_key").collect()}
    assert out == {"p": (2, "b"), "q": (None, "d")}

def test_run_load_end_to_end(spark, tmp):
    rows = skewed_rows(600)
    s, w = masters(spark)
    r = spark.createDataFrame(rows, RSCHEMA)
    res = run_load(spark, s, w, r, tmp, LOAD)
    assert {x.check_name: x.status for x in res["checks"].collect()} == {
        "unique:hub_survey.hub_survey_key": "PASS",
        "references:link_survey_well.hub_well_key->hub_well.hub_well_key": "PASS",
        "at_least:sat_seismic_data.depth>=0": "PASS"}
    direct = M.build_marts(build_vault(s, w, r, LOAD))
    for name in M.MART_NAMES:
        a = sorted(map(tuple, rounded(res[name]).collect()), key=str)
        b = sorted(map(tuple, rounded(direct[name]).collect()), key=str)
        assert a == b
    report = res["report"].collect()
    assert {x.sink for x in report} == {"parquet"} and set(M.MART_NAMES) <= {x.table_name for x in report}


def rounded(mart):
    return mart.withColumn("avg_amplitude", M.round_sig("avg_amplitude"))


def test_failed_database_copy_of_a_mart_is_reported(spark, tmp):
    from strata.sources.jdbc import JdbcSettings

    s, w = masters(spark)
    res = run_load(spark, s, w, spark.createDataFrame(skewed_rows(60), RSCHEMA), tmp, LOAD,
                   jdbc=JdbcSettings(url="jdbc:nothing:here", driver=None))
    bad = [x for x in res["report"].collect() if x.sink == "jdbc"]
    assert {x.status for x in bad} == {"error"} and set(M.MART_NAMES) <= {x.table_name for x in bad}
    assert res["mart_sensor_analysis"].count() == 3


def test_salted_core_join_equals_plain(spark):
    rows = skewed_rows(900)
    s, w = masters(spark)
    v = build_vault(s, w, spark.createDataFrame(rows, RSCHEMA), LOAD)
    plain = sorted(map(tuple, M.core_join(v, salts=1).collect()), key=str)
    salted_df = M.core_join(v, salts=8)
    assert "_salt" in salted_df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, salted_df.collect()), key=str) == plain


def test_run_from_dir_with_csv_masters_and_reconstructed_files(spark, tmp):
    import os

    from strata.plans.flow import inputs_from_dir, run_from_dir
    from strata.sinks.files import write_parquet_groups

    data = f"{tmp}/data"
    os.makedirs(f"{data}/deep")
    with open(f"{data}/master_surveys.csv", "w") as f:
        f.write("survey_type_id,survey_type,file_format\n1,A2D,sgx\n2,A3D,sgx\n")
    with open(f"{data}/master_wells.csv", "w") as f:
        f.write("well_id,well_name,location_lat,location_long,operator,spud_date\n")
        f.writelines(f"{w},W{w},41.5,50.2,op,1994-07-18\n" for w in range(1, 51))
    r = spark.createDataFrame(skewed_rows(300), RSCHEMA)
    write_parquet_groups(r, f"{data}/deep").collect()
    inp = inputs_from_dir(spark, data)
    assert inp["readings"].count() == 300 and inp["wells"].count() == 50
    res = run_from_dir(spark, data, f"{tmp}/out", LOAD)
    formats = {x.source_format for x in res["mart_well_performance"].collect()}
    assert formats == {"sgx"}                     # taken from the file_format column
    empty = f"{tmp}/empty"
    os.makedirs(empty)
    none = inputs_from_dir(spark, empty)
    assert none == {"surveys": None, "wells": None, "readings": None}


def test_broadcast_bound_counts_bytes(spark):
    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(10)], "k bigint, t string")
    rows, longest = joins.measured(wide)
    assert (rows, longest) == (10, {"t": 1000}) and joins.byte_bound(wide) >= 10_080
    plan = wide.agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in plan            # rows are counted by partial aggregates, none are moved


def test_parallelism_guard_only_for_one_small_file(spark, tmp):
    from strata.plans.parallelism import ensure_parallelism

    spark.range(0, 1000).coalesce(1).write.parquet(f"{tmp}/one")
    narrow = spark.read.parquet(f"{tmp}/one")
    assert "RoundRobinPartitioning" in ensure_parallelism(narrow)._jdf.queryExecution().executedPlan().toString()
    assert ensure_parallelism(narrow, max_bytes=10) is narrow
    spark.range(0, 1000, numPartitions=2).write.parquet(f"{tmp}/two")
    several = spark.read.parquet(f"{tmp}/two")
    assert ensure_parallelism(several) is several               # no shuffle of raw rows


def test_salt_splits_equal_rows(spark):
    rows = spark.createDataFrame([(1, 2.5)] * 1000, "k bigint, v double").coalesce(1)
    small = spark.createDataFrame([(1, "a")], "k bigint, name string")
    out = joins.salted_join(rows, small, "k", 8)
    assert out.count() == 1000
    salts = rows.withColumn("s", F.pmod(F.monotonically_increasing_id(), F.lit(8))).groupBy("s").count().collect()
    assert len(salts) == 8 and {r["count"] for r in salts} == {125}


def test_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    import pytest

    from strata import session

    assert session.is_private("local[4]") and session.is_private("local")
    assert not session.is_private("yarn") and not session.is_private("local-cluster[2,1,1024]")

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_named_file_writer_is_idempotent_on_rerun(spark, tmp):
    import os

    from strata.sinks.files import write_parquet_groups

    df = spark.createDataFrame(skewed_rows(200), RSCHEMA).repartition(3)
    first = sorted(r.path for r in write_parquet_groups(df, tmp).collect())
    again = sorted(r.path for r in write_parquet_groups(df, tmp).collect())   # a re-run or retried job
    assert first == again
    names = sorted(os.listdir(tmp))
    assert len(names) == len(first) and not any(n.endswith(".tmp") for n in names)
    assert spark.read.parquet(tmp).count() == 200


def test_run_load_can_stop_on_failed_checks(spark, tmp):
    import pytest

    from strata.operators.checks import CheckFailed

    rows = skewed_rows(60) + [(1, 1, -5.0, 1.0, 1, None)]          # a negative depth
    s, w = masters(spark)
    r = spark.createDataFrame(rows, RSCHEMA)
    res = run_load(spark, s, w, r, f"{tmp}/a", LOAD)              # reported, marts still built
    assert {x.status for x in res["checks"].collect()} == {"PASS", "FAIL"}
    assert "mart_sensor_analysis" in res
    with pytest.raises(CheckFailed):
        run_load(spark, s, w, r, f"{tmp}/b", LOAD, enforce_checks=True)


def test_converted_trace_lake_feeds_the_load(spark, tmp):
    from strata.operators.convert import convert_lake
    from strata.sinks.fixedwidth import encode

    rows = [(s, w, d, a, q) for (s, w, d, a, q, _) in skewed_rows(300)]
    rows.append((2, 3, float("nan"), 1.0, 1))                    # NaN depth: not counted
    df = spark.createDataFrame(rows, "survey_id bigint, well_id bigint, depth double, amplitude double, "
                                     "quality_flag bigint")
    encode(df, f"{tmp}/lake").collect()
    conv = convert_lake(spark, f"{tmp}/lake", f"{tmp}/readings", LOAD)
    s, w = masters(spark)
    res = run_load(spark, s, w, conv["readings"], f"{tmp}/out", LOAD)
    total = sum(x.total_readings for x in res["mart_sensor_analysis"].collect())
    assert total == 300
    assert {x.status for x in conv["report"].collect()} == {"ok"}
