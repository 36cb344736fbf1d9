"""What the findings of the third round ask for: the loads' shuffles and copies, and the files of a trace lake."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T
from strata.functions.keys import packed, unpacked
from strata.operators import history as H
from strata.operators import incremental as INC
from strata.operators import marts as M
from strata.operators.bucketed import BucketedSat
from strata.operators.vault import build_hub, build_link, build_vault, seismic_sat
from strata.plans import joins, registry
from strata.session import ensure_checkpoint_dir
from strata.sinks import fixedwidth as FWE
from strata.sources import analog
from strata.sources import fixedwidth as FW

READINGS = "survey_id bigint, well_id bigint, depth double, amplitude double, quality_flag bigint, ingest_timestamp timestamp_ntz"
MAY = dt.datetime(2024, 5, 1)


def some(spark, n, start=0):
    rows = [(i % 7, i % 5 if i % 11 else None, i / 4, -i / 8 if i % 3 else None, i % 2, MAY + dt.timedelta(hours=i % 13)) for i in range(start, n)]
    return spark.createDataFrame(rows + rows[::3], READINGS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_packed_texts_come_back(spark):
    digest = "0123456789abcdef" * 2
    texts = [None, "", "a", "x" * 16, "x" * 32, digest, digest.upper(), digest[:30], digest + digest, "ä" * 16, "\0" * 17]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed(F.col("t")).alias("b"))
    got = df.select("t", "b", unpacked(F.col("b")).alias("back")).collect()
    assert [r.back for r in got] == texts and len({bytes(r.b) for r in got if r.b is not None}) == len(texts) - 1
    assert [len(r.b) for r in got if r.t == digest] == [16]


@pytest.mark.parametrize("most", [0, 30, 10_000])
def test_unseen_by_every_way(spark, monkeypatch, most):
    """Hashes alone, hashes and the doubted rows, and broadcast keys give the same rows; a shared hash loses none."""
    monkeypatch.setattr(INC, "KEYS_BYTES", most)
    rows = spark.createDataFrame([(f"k{i}" if i else None, "h", i) for i in range(40)], "a_key string, source_hash string, v int")
    for stored, want in (([("k1", "h")], 39), ([(f"k{i}", "h") for i in range(30)], 11), ([("k1", "other")], 40), ([(None, "h")], 40)):
        old = spark.createDataFrame(stored, "a_key string, source_hash string")
        got = INC._unseen(rows, old, ["a_key", "source_hash"]).collect()
        assert len(got) == want and {r.a_key for r in got}.isdisjoint({s[0] for s in stored if s[1] == "h" and s[0]})
        monkeypatch.setattr(INC.F, "xxhash64", lambda *c: F.length(F.col(c[0])).cast("bigint") * 0 + 1)
        assert len(INC._unseen(rows, old, ["a_key", "source_hash"]).collect()) == want
        monkeypatch.undo()
        monkeypatch.setattr(INC, "KEYS_BYTES", most)


def test_equal_readings_meet_as_numbers(spark):
    r = some(spark, 60)
    once = seismic_sat(r, "1", keep_source_timestamp=True, once=True)
    rows = INC.new_sat_rows(once, None, "link_survey_well_key")
    assert "SortAggregate" not in plan(rows) and plan(rows).count("Exchange hashpartitioning") == 1
    plain = INC.new_sat_rows(seismic_sat(r, "1", keep_source_timestamp=True), None, "link_survey_well_key")
    assert sorted(map(str, rows.collect())) == sorted(map(str, plain.select(*rows.columns).collect()))
    text = r.withColumn("depth", F.col("depth").cast("string"))
    assert not INC.is_unique(seismic_sat(text, "1", once=True), ["link_survey_well_key", "source_hash"])


def test_hubs_and_links_are_made_distinct_once(spark):
    r = some(spark, 60)
    for batch, key in ((build_hub(r, "well_id", "hub_well_key", "1", "x"), "hub_well_key"),
                       (build_link(r, "survey_id", "well_id", "1"), "link_survey_well_key")):
        assert plan(INC.new_keys(batch, None, key)).count("Exchange hashpartitioning") == 1


def test_a_load_leaves_no_copies(spark, tmp, monkeypatch):
    """Copies of the batches go once their rows are stored, whichever way the stored keys are compared."""
    monkeypatch.setattr(INC, "KEYS_BYTES", 0)
    base = ensure_checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/strata-scratch"

    def files():
        return {f for d, _, names in os.walk(base) for f in names if f.startswith("part-")}

    before, vault = files(), INC.IncrementalVault(f"{tmp}/vault")
    masters = (spark.createDataFrame([(i, f"t{i}", "csv") for i in range(7)], "survey_type_id bigint, survey_type string, source_format string"),
               spark.createDataFrame([(i, f"w{i}", "o", 0.0, 0.0) for i in range(5)], "well_id bigint, well_name string, operator string, location_lat double, location_long double"))
    counts = [vault.load(spark, build_vault(*masters, some(spark, n), str(n), keep_source_timestamp=True, once=True)) for n in (40, 60, 60)]
    assert files() == before
    assert counts[0]["sat_seismic_data"] == 36 and counts[1]["sat_seismic_data"] == 18 and not any(counts[2].values())
    assert counts[0]["rejects"] == 4 and counts[1]["rejects"] == 2


def test_bucketed_rows_move_once(spark, tmp):
    sat = BucketedSat("sat_moves_once", f"{tmp}/sat", buckets=4)
    first, more = (seismic_sat(some(spark, n), str(n), keep_source_timestamp=True, once=True) for n in (40, 60))
    assert [sat.load(first), sat.load(more), sat.load(more)] == [36, 18, 0]
    assert sat.table(spark).count() == 54
    out = sat.unseen(more).repartition(4, *sat.keys)
    assert plan(out).count("Exchange hashpartitioning(link_survey_well_key") == 1
    spark.sql("DROP TABLE sat_moves_once")


def test_as_of_moves_no_column_twice(spark):
    parent = spark.createDataFrame([("p", "1")], "a_key string, load_date string")
    sat = spark.createDataFrame([("p", "1", 1, "x"), ("p", "2", 5, "y"), ("p", "2", 7, None)], "a_key string, load_date string, n int, t string")
    out = H.as_of(parent, sat, "a_key", ("0", "1", "3"), ("n",))
    assert [tuple(r) for r in out.orderBy("as_of").collect()] == [("p", "1", "1", 1, "x"), ("p", "3", "2", 7, None)]
    assert isinstance(out.schema["a_key"].dataType, T.StringType) and "rank" not in plan(out)


def test_a_lake_has_about_as_many_files_as_surveys(spark, tmp):
    rows = [(i % 50, i, 1.0, 2.0, 0) for i in range(5000)]
    df = spark.createDataFrame(rows, "survey_id bigint, well_id bigint, depth double, amplitude double, quality_flag bigint").repartition(16)
    done = FWE.written(FWE.encode(df, f"{tmp}/lake"))
    assert done["rows"] == 5000 and 50 <= done["files"] <= 50 + 16
    assert sorted((r.survey_id, r.well_id) for r in FW.read(spark, f"{tmp}/lake").collect()) == sorted(r[:2] for r in rows)


def test_a_hot_survey_lies_in_many_files_and_a_task_holds_few_records(spark, tmp, monkeypatch):
    df = spark.range(4000).selectExpr("3L as survey_id", "1L as well_id", "1D as depth", "2D as amplitude", "0L as quality_flag").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert FWE.written(FWE.encode(df, f"{tmp}/hot"))["files"] == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    monkeypatch.setattr(FWE, "HELD_BYTES", 13)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        done = FWE.written(FWE.encode(df, f"{tmp}/few"))
        assert done["rows"] == 4000 and done["files"] >= 40 and FW.read(spark, f"{tmp}/few").count() == 4000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def small_tables(spark, folder):
    """The tables that the marts read: two formats for a survey, a survey without one, wells twice, missing and NULL."""
    rows = {"region": [(0, "r0"), (1, "r1")], "nation": [(i, f"n{i}", i % 2) for i in range(4)],
            "supplier": [(i, f"s{i}", i % 4, 0.0) for i in range(6)] + [(1, "again", 2, 0.0), (2, "again", 2, 0.0), (6, "lost", None, 0.0), (None, "none", 1, 0.0)],
            "part": [(i, f"p{i}", "b", "t", 1, 1.0) for i in (0, 1, 2, 3, 4, 4, None)],
            "lineitem": [(i, i % 7 if i % 13 else None, i % 8 if i % 17 else None, 1, float(i) if i % 5 else None, (i / 3 if i % 6 != 3 else None) if i % 7 != 2 else float("inf"),
                          0.0, 0.0, "RA"[i % 2], "O", MAY) for i in range(300)]}
    for name, data in rows.items():
        spark.createDataFrame(data, analog.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("query", ["mart_well_performance", "mart_preview", "mart_tiny_values"])
def test_the_well_mart_holds_one_table_of_groups(spark, tmp, query):
    """No task holds the partials of its links beside the groups of its wells."""
    small_tables(spark, tmp)
    df = registry.queries()[query](spark, tmp)
    keys = [line.split("keys=[")[1].split("]")[0] for line in plan(df).splitlines() if "Aggregate(keys=[" in line]
    by_well = [k for k in keys if "well_id" in k]
    assert len(by_well) == 2 and not any("survey_id" in k for k in by_well)


@pytest.mark.parametrize("most", [1, 1 << 20])
def test_the_well_mart_is_that_of_the_links(spark, tmp, monkeypatch, most):
    monkeypatch.setattr(joins, "max_broadcast_bytes", lambda _: most)
    small_tables(spark, tmp)
    inp = analog.inputs(spark, tmp)
    got, links = M.well_performance_from_inputs(**inp), M.marts_from_facts(M.facts_from_inputs(**inp))["mart_well_performance"]
    shown = [sorted(map(str, df.withColumn("avg_amplitude", M.round_sig("avg_amplitude")).collect())) for df in (got, links)]
    assert shown[0] == shown[1] and got.columns == links.columns and len(shown[0]) == 10
    assert {r.well_id for r in got.collect()} == {0, 1, 2, 3, 4}
