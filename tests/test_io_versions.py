"""Sources, sinks, versions, commit log, incremental loads and checks."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import checks as C
from strata.operators import incremental as INC
from strata.operators.vault import build_vault, seismic_sat
from strata.sinks import files as SF
from strata.sinks import tables as ST
from strata.sinks import versions as SV
from strata.sources import deltalog as L
from strata.sources import files as FS
from strata.sources import jdbc as J
from strata.sources.readings import MissingColumnsError, NoInputError, scan_reconstructed

LOAD = "2024-01-01T00:00:00"
RSCHEMA = ("survey_id bigint, well_id bigint, depth double, amplitude double, quality_flag bigint, "
           "ingest_timestamp timestamp_ntz")


def readings(spark, rows):
    return spark.createDataFrame(rows, RSCHEMA)


def test_versions_overwrite_as_of_and_empty_refusal(spark, tmp):
    root = f"{tmp}/mart"
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k bigint, v string")
    b = spark.createDataFrame([(3, "z")], "k bigint, v string")
    assert SV.publish(spark, a, root) == 0
    assert SV.publish(spark, b, root) == 1
    with pytest.raises(SV.EmptyPublishError):
        SV.publish(spark, b.limit(0), root)
    assert SV.publish(spark, b.limit(0), root, allow_empty=True) == 2
    assert SV.publish(spark, a, root, mode="append") == 3
    as_of = {v: sorted(r.k for r in SV.read_as_of(spark, root, v).collect()) for v in range(4)}
    assert as_of == {0: [1, 2], 1: [3], 2: [], 3: [1, 2]}
    h = {r.version: r for r in SV.history(spark, root).collect()}
    assert [(h[v].num_added_rows, h[v].mode) for v in range(4)] == [(2, "Overwrite"), (1, "Overwrite"), (0, "Overwrite"), (2, "Append")]
    b.write.parquet(f"{root}/version=7")          # data without a manifest row, as a failed publish leaves it
    assert sorted(r.k for r in SV.read_as_of(spark, root).collect()) == [1, 2]
    with pytest.raises(ValueError):
        SV.read_as_of(spark, root, 9)


def test_delta_shaped_log_is_read(spark, tmp):
    log = f"{tmp}/t/_delta_log"
    os.makedirs(log)
    commits = [
        [{"protocol": {"minReaderVersion": 1}},
         {"add": {"path": "p0.parquet", "size": 10, "stats": json.dumps({"numRecords": 8})}},
         {"commitInfo": {"timestamp": 1, "operation": "WRITE",
                         "operationParameters": {"mode": "Overwrite"}}}],
        [{"remove": {"path": "p0.parquet", "size": 10}},
         {"add": {"path": "p1.parquet", "size": 11, "stats": json.dumps({"numRecords": 8})}},
         {"commitInfo": {"timestamp": 2, "operation": "WRITE", "operationParameters": {"mode": "Overwrite"}}}],
        [{"remove": {"path": "p1.parquet", "size": 11}},
         {"commitInfo": {"timestamp": 3, "operation": "WRITE", "operationParameters": {"mode": "Overwrite"}}}],
    ]
    for i, acts in enumerate(commits):
        with open(f"{log}/{i:020d}.json", "w") as f:
            f.write("\n".join(json.dumps(a) for a in acts))
    root = f"{tmp}/t"
    assert [r.version for r in L.history(spark, root).orderBy("version").collect()] == [0, 1, 2]
    assert [(r.path, r.num_records) for r in L.active_files(spark, root, 0).collect()] == [("p0.parquet", 8)]
    assert [r.path for r in L.active_files(spark, root, 1).collect()] == ["p1.parquet"]
    assert L.active_files(spark, root, 2).count() == 0


def test_log_with_checkpoint_and_stray_names(spark, tmp):
    import pyarrow as pa
    import pyarrow.parquet as pq

    log = f"{tmp}/t/_delta_log"
    os.makedirs(log)

    def commit(v, *acts):
        with open(f"{log}/{v:020d}.json", "w") as f:
            f.write("\n".join(json.dumps(a) for a in acts))

    def add(path, n):
        return {"add": {"path": path, "size": 1, "stats": json.dumps({"numRecords": n})}}

    commit(3, add("d", 4), {"remove": {"path": "b", "size": 1}})
    commit(4, add("e", 5))
    for stray in ("notes.json", "3x.json", "_last_checkpoint"):
        with open(f"{log}/{stray}", "w") as f:
            f.write("{}")
    root = f"{tmp}/t"
    with pytest.raises(L.IncompleteLogError):
        L.active_files(spark, root, 4)
    table = pa.table({"add": [add("a", 1)["add"], add("b", 2)["add"], None], "protocol": [None, None, {"minReaderVersion": 1}]})
    pq.write_table(table, f"{log}/{2:020d}.checkpoint.parquet")
    state = {r.path: (r.num_records, r.added_in_version) for r in L.active_files(spark, root, 3).collect()}
    assert state == {"a": (1, 2), "d": (4, 3)}
    seen = {r.version: (r.active_files, r.active_rows, r.active_versions) for r in L.activity(spark, root).collect()}
    assert seen == {2: (2, 3, 1), 3: (2, 5, 2), 4: (3, 10, 3)}


def test_one_failing_check_is_a_row(spark):
    t = {"a": spark.createDataFrame([("x", 1)], "s string, n int")}
    rows = C.run_checks(spark, t, [C.at_least("a", "n", 0), C.at_least("a", "s", 0), C.unique_key("b", "k")]).collect()
    assert [r.status for r in rows] == ["PASS", "ERROR", "ERROR"]


def test_mixed_numeric_widths_are_read_in_the_widest(spark, tmp):
    spark.createDataFrame([(1, 2, 1.5, 0.25, 1)], "survey_id int, well_id int, depth float, amplitude float, quality_flag int") \
        .write.parquet(f"{tmp}/a/x_reconstructed.parquet")
    spark.createDataFrame([(3, 4, 2.5, 1e-9, 0, "y")], "survey_id bigint, well_id bigint, depth double, amplitude double, quality_flag bigint, note string") \
        .write.parquet(f"{tmp}/b/y_reconstructed.parquet")
    df = scan_reconstructed(spark, tmp, glob="part-*.parquet")
    assert sorted(map(tuple, df.drop("source_file").collect())) == [(1, 2, 1.5, 0.25, 1, None), (3, 4, 2.5, 1e-9, 0, "y")]


def test_glob_union_missing_and_extra_columns(spark, tmp):
    r = readings(spark, [(1, 1, 1.0, 2.0, 1, None), (1, 2, 3.0, 4.0, 0, None)])
    SF.write_parquet_groups(r.withColumn("g", F.col("quality_flag").cast("string")), tmp, group_col="g",
                            drop_cols_when={"0": ["ingest_timestamp"]}).collect()
    SF.write_parquet_groups(r, f"{tmp}/x", suffix=".parquet").collect()          # not matched
    df = scan_reconstructed(spark, tmp)
    assert df.count() == 2 and "source_file" in df.columns
    with pytest.raises(MissingColumnsError):
        scan_reconstructed(spark, tmp, required=("survey_id", "nope"))
    with pytest.raises(NoInputError):
        scan_reconstructed(spark, f"{tmp}/empty")


def test_optional_csv_and_schema(spark, tmp):
    spark.createDataFrame([(101, "A")], "survey_type_id bigint, survey_type string") \
        .write.option("header", True).csv(f"{tmp}/s.csv")
    schema = "survey_type_id bigint, survey_type string"
    assert FS.read_csv_optional(spark, f"{tmp}/s.csv", schema).first().survey_type_id == 101
    missing = FS.read_csv_optional(spark, f"{tmp}/absent.csv", schema)
    assert missing.count() == 0 and missing.columns == ["survey_type_id", "survey_type"]


def test_jdbc_round_trip_and_dual_sink(spark, tmp):
    settings = J.probe(spark, J.JdbcSettings())
    assert settings is not None
    df = spark.createDataFrame([(i, f"k{i}") for i in range(100)], "well_id bigint, hub_well_key string")
    rep = ST.write_table(spark, df, "hub_test_dual", tmp, settings).collect()
    assert {(r.sink, r.status, r.row_count) for r in rep} == {("parquet", "ok", 100), ("jdbc", "ok", 100)}
    back = J.read_table(spark, settings, "hub_test_dual", partition_column="well_id", num_partitions=3)
    assert back.rdd.getNumPartitions() == 3 and back.count() == 100
    bad = ST.write_table(spark, df, "t2", tmp, J.JdbcSettings(url="jdbc:derby:memory:x;create=false"))
    assert {r.sink: r.status for r in bad.collect()} == {"parquet": "ok", "jdbc": "error"}
    assert J.probe(spark, J.JdbcSettings(url="jdbc:nosuchdb://h/x", driver=None)) is None


def test_checks_report_violations(spark):
    t = {
        "hub_survey": spark.createDataFrame([("a",), ("a",), ("b",)], "hub_survey_key string"),
        "hub_well": spark.createDataFrame([("w1",)], "hub_well_key string"),
        "link_survey_well": spark.createDataFrame([("w1",), ("w2",), ("w2",), (None,)], "hub_well_key string"),
        "sat_seismic_data": spark.createDataFrame([(-1.0,), (0.0,), (None,), (2.0,)], "depth double"),
    }
    res = {r.check_name: r for r in C.run_checks(spark, t).collect()}
    assert res["unique:hub_survey.hub_survey_key"].bad_rows == 1
    assert res["references:link_survey_well.hub_well_key->hub_well.hub_well_key"].bad_rows == 2
    assert res["at_least:sat_seismic_data.depth>=0"].bad_rows == 1          # zero passes
    assert {r.status for r in res.values()} == {"FAIL"}
    with pytest.raises(C.CheckFailed):
        C.run_checks(spark, t, enforce=True)
    err = C.run_checks(spark, {}, [C.unique_key("missing", "k")]).first()
    assert err.status == "ERROR"
    assert C.orphans(t["link_survey_well"], "hub_well_key", t["hub_well"]).count() == 3


def test_incremental_twice_equals_once(spark, tmp):
    rows = [(1, 1, 1.0, 2.0, 1, None), (1, 1, 1.0, 2.0, 1, None), (1, 2, 1.0, 2.0, 1, None),
            (2, 1, 5.0, 5.0, 0, None)]
    batch = readings(spark, rows)
    v = INC.IncrementalVault(tmp)
    first = v.load(spark, {"sat_seismic_data": seismic_sat(batch, LOAD)})
    again = v.load(spark, {"sat_seismic_data": seismic_sat(batch, LOAD)})
    assert first["sat_seismic_data"] == 3          # repeat within a link kept once; two links kept
    assert again["sat_seismic_data"] == 0
    changed = readings(spark, [(1, 1, 1.5, 2.0, 1, None)])
    assert v.load(spark, {"sat_seismic_data": seismic_sat(changed, LOAD)})["sat_seismic_data"] == 1
    keys = build_vault(None, None, batch, LOAD)["link_survey_well"]
    assert v.load(spark, {"link_survey_well": keys})["link_survey_well"] == 3
    assert v.load(spark, {"link_survey_well": keys})["link_survey_well"] == 0


def test_schema_drift_report_and_align(spark):
    a = readings(spark, [(1, 1, 1.0, 2.0, 1, None)])
    b = a.drop("ingest_timestamp").withColumn("quality_flag", F.col("quality_flag").cast("int")) \
         .withColumn("extra", F.lit("x"))
    rep = {r.column_name: r.change for r in INC.schema_drift(spark, a.schema, b.schema).collect()}
    assert rep == {"extra": "added", "ingest_timestamp": "removed", "quality_flag": "type_changed"}
    al = INC.align_to(b, a.schema)
    assert al.columns == a.columns + ["extra"]
    assert dict(al.dtypes)["quality_flag"] == "bigint"


def test_load_audit_counts_while_writing(spark, tmp):
    df = spark.range(0, 1234)
    assert ST.write_parquet(df, f"{tmp}/x") == 1234


def test_checks_during_the_write_equal_checks_after_it(spark, tmp):
    sat = spark.createDataFrame([(-1.0, "a"), (2.0, None), (None, "b")], "depth double, ingest_source string")
    hub = spark.createDataFrame([("x",), ("x",), (None,)], "hub_survey_key string")
    tables = {"sat": sat, "hub": hub, "empty": sat.limit(0)}
    checks = [C.unique_key("hub", "hub_survey_key"), C.at_least("sat", "depth", 0), C.not_null("sat", "depth"), C.at_least("empty", "depth"),
              C.at_least("sat", "ingest_source", 0), C.at_least("sat", "no_column", 0), C.not_null("none", "depth"), C.not_null("sat", "ingest_source")]
    assert [c.in_flight(tables) for c in checks] == [False, True, True, True, False, False, False, False]
    report, during = C.write_checked(spark, tables, tmp, checks)

    def rows(df):
        return [(r.check_name, r.status, r.bad_rows, r.total_rows, r.detail if r.status != "ERROR" else None) for r in df.collect()]

    assert rows(during) == rows(C.run_checks(spark, tables, checks))
    assert {r.table_name: r.row_count for r in report.collect()} == {"sat": 3, "hub": 3, "empty": 0}
    with pytest.raises(C.CheckFailed):
        C.write_checked(spark, tables, tmp, checks[:2], enforce=True)


def test_checked_write_does_not_read_the_satellite_again(spark, tmp, monkeypatch):
    sat = spark.range(100).select(F.col("id").cast("double").alias("depth"))
    hub = spark.range(5).select(F.col("id").cast("string").alias("hub_survey_key"))
    plans = []
    build = C._evaluate
    monkeypatch.setattr(C, "_evaluate", lambda tables, checks: (plans.extend(c.name for c in checks), build(tables, checks))[1])
    _, out = C.write_checked(spark, {"sat": sat, "hub": hub}, tmp, [C.unique_key("hub", "hub_survey_key"), C.at_least("sat", "depth")])
    assert plans == ["unique:hub.hub_survey_key"] and [r.status for r in out.collect()] == ["PASS", "PASS"]


def test_balanced_predicates_meet_every_row_once(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 3 = 0 THEN 7 WHEN i % 50 = 1 THEN NULL ELSE i * i - 90 END AS k, "
                "CASE WHEN i % 11 = 0 THEN NULL ELSE 40 - i END AS tie FROM range(3000) r(i)")
    for cuts in ([], [7], [-5, 7, 7, 7, 900], [7, 7], [1.5, 1.5, 2.25]):
        for tie in ("tie", None):
            found = J.balanced_predicates(cuts, "k", tie)
            hits = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in found)
            assert con.execute(f"SELECT min({hits}), max({hits}) FROM t").fetchone() == (1, 1)


def test_balanced_read_of_a_skewed_key(spark):
    import statistics

    settings = J.JdbcSettings(url="jdbc:derby:memory:balanced;create=true")
    rows = [(1 if i % 3 == 0 else i**2, i if i % 7 else None) for i in range(6000)] + [(None, 1)]
    df = spark.createDataFrame(rows, "k bigint, tie bigint")
    assert J.replace_table(df, settings, "skewed") == len(rows)
    back = J.read_balanced(spark, settings, "skewed", "k", 12, tie="tie")
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, rows))
    sizes = [r["count"] for r in back.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * statistics.median(sizes)
    equal_width = J.read_table(spark, settings, "skewed", partition_column="k", num_partitions=12)
    wide = [r["count"] for r in equal_width.groupBy(F.spark_partition_id()).count().collect()]
    assert max(wide) > 2 * statistics.median(wide)                # what the quantiles are for
    J.replace_table(df.limit(0), settings, "skewed")
    assert J.read_balanced(spark, settings, "skewed", "k", 12).count() == 0
    J.replace_table(df.select(F.col("k").cast("string")), settings, "texts")
    with pytest.raises(Exception):
        J.read_balanced(spark, settings, "texts", "k").count()


def test_failed_replace_leaves_the_old_table(spark, monkeypatch):
    settings = J.JdbcSettings(url="jdbc:derby:memory:swap;create=true")

    def held():
        return sorted(r[0] for r in J.read_table(spark, settings, "t").collect())

    def tables():
        return J.run_query(spark, settings, "select tablename from sys.systables where tabletype = 'T'").count()

    assert J.replace_table(spark.range(5), settings, "t") == 5
    bad = spark.range(0, 40, 1, 4).select(F.when(F.col("id") == 33, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        J.replace_table(bad, settings, "t")
    assert held() == [0, 1, 2, 3, 4] and tables() == 1            # and no staging table is left
    query = J.run_query
    monkeypatch.setattr(J, "run_query", lambda s, st, sql: query(s, st, "select 3 as n from sysibm.sysdummy1"))
    with pytest.raises(J.LoadMismatch):
        J.replace_table(spark.range(7), settings, "t")
    monkeypatch.undo()
    assert held() == [0, 1, 2, 3, 4] and tables() == 1
    assert J.replace_table(spark.range(7), settings, "t") == 7 and held() == list(range(7))
