"""What the findings of the fourth round ask for: copies made by the salted join, and the files of trace writes and streams."""

from __future__ import annotations

import os

import pytest

from pyspark.sql import functions as F
from strata.operators import incremental as INC
from strata.operators import marts as M
from strata.operators.convert import convert_lake
from strata.operators.vault import build_vault
from strata.plans import joins
from strata.plans.flow import inputs_from_dir
from strata.sinks import fixedwidth as FWE
from strata.sinks import trace_writer as TW
from strata.sources import fixedwidth as FW
from strata.streaming import trace_stream as TS

READING = "survey_id bigint, well_id bigint, depth double, amplitude double, quality_flag bigint"


@pytest.fixture()
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def output_rows(df, kind):
    """Rows that the operators of one name gave, after the frame was run without AQE."""
    def walk(node):
        found = [node.metrics().apply("numOutputRows").value()] if node.nodeName() == kind else []
        children = node.children()
        return found + [n for i in range(children.size()) for n in walk(children.apply(i))]
    return walk(df._jdf.queryExecution().executedPlan())


def test_a_salted_join_copies_rows_of_hot_keys_only(spark, no_aqe):
    big = spark.range(1500).selectExpr("CASE WHEN id < 1000 THEN 0L WHEN id % 7 > 0 THEN id END AS k", "id AS v").repartition(3)
    small = spark.range(3000).selectExpr("id AS k", "id * 2 AS w")
    for how in ("inner", "left"):
        out = joins.salted_join(big, small, "k", 8, how)
        want = big.join(small, "k", how).select(*out.columns)
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
        assert output_rows(out, "Generate") == [3000 + 7]


def test_the_hottest_keys_are_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_KEYS", 2)
    df = spark.createDataFrame([(k,) for k, n in ((1, 5), (2, 30), (3, 10), (None, 20)) for _ in range(n)], "k bigint")
    hashes = {r.h: r.k for r in df.select("k", F.xxhash64("k").alias("h")).collect()}
    assert [hashes[h] for h in joins.hot_keys(df, "k", 8)] == [2, None] and joins.hot_keys(df, "k", 31) == []


def test_a_salted_join_of_keys_of_two_types_loses_nothing(spark):
    big = spark.createDataFrame([(i % 3, i) for i in range(90)], "k int, v int")
    small = spark.createDataFrame([(i, f"{i}") for i in range(5)], "k bigint, t string")
    assert joins.salted_join(big, small, "k", 8).count() == 90


def test_digests_are_moved_as_bytes(spark):
    texts = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "", "x", None]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "hub_well_key string, n int")
    short = M._short_keys(df)
    assert sorted(len(r.hub_well_key) for r in short.collect()) == [16, 17, 18, 17 + 32]
    assert [r.hub_well_key for r in M._text_keys(short).orderBy("n").collect()] == texts[:4]


def test_a_written_lake_has_about_as_many_files_as_surveys(spark, tmp):
    rows = [(i % 50, i, 1.0, 2.0, 0) for i in range(5000)]
    df = spark.createDataFrame(rows, READING).repartition(16)
    for mode in ("append", "overwrite"):
        TW.write(df, f"{tmp}/lake", mode=mode)
        files = [f for _, _, names in os.walk(f"{tmp}/lake") for f in names if f.endswith(".sgx")]
        assert 50 <= len(files) <= 50 + int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert sorted((r.survey_id, r.well_id) for r in FW.read(spark, f"{tmp}/lake").collect()) == sorted(r[:2] for r in rows)


def test_a_stream_writes_fewer_files_than_surveys(spark, tmp):
    """Converted readings lie in blocks of surveys, each row once, over two drops."""
    rows = [(i * 9 % 2500, i, float(i), 2.0, i % 2) for i in range(5000)]
    df = spark.createDataFrame(rows, READING)
    for flag, announced in ((0, 1), (1, 1), (2, 0)):
        TW.write(df.where(F.col("quality_flag") == flag), f"{tmp}/lake")
        added = TS.convert_arrivals(spark, f"{tmp}/lake", f"{tmp}/log", f"{tmp}/out", f"{tmp}/ckpt", entry_bytes=400 << 20)
        assert bool(added) == bool(announced)
    out = spark.read.parquet(f"{tmp}/out")
    assert sorted((r.survey_id, r.well_id, r.depth) for r in out.collect()) == sorted(r[:3] for r in rows)
    assert out.where(F.col("survey_block") != F.floor(F.col("survey_id") / 1000)).isEmpty()
    assert len(out.inputFiles()) <= 2 * 3 * 4 < len({r[0] for r in rows})


def test_a_log_file_names_neighbouring_paths(spark, tmp):
    TW.write(spark.range(400).selectExpr("id AS survey_id", "1L AS well_id", "1D AS depth", "2D AS amplitude", "0L AS quality_flag"), f"{tmp}/lake")
    assert TS.announce(spark, f"{tmp}/lake", f"{tmp}/log", entry_bytes=100 << 20) == 400
    ends = sorted(tuple(r)[1:] for r in spark.read.parquet(f"{tmp}/log").groupBy(F.input_file_name()).agg(F.min("path"), F.max("path")).collect())
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_a_batch_as_large_as_the_store_is_not_copied(spark, tmp, monkeypatch):
    """A whole input that comes again is joined with the store at once; a small batch still is not."""
    monkeypatch.setattr(INC, "KEYS_BYTES", 0)
    rows = [(i % 7, i % 5 if i % 11 else None, i / 4, -i / 8 if i % 3 else None, i % 2) for i in range(80)]
    df, copied, vault = spark.createDataFrame(rows + rows[::3], READING), [], INC.IncrementalVault(f"{tmp}/vault")
    staged = INC._staged
    monkeypatch.setattr(INC, "_staged", lambda *a: copied.append(a) or staged(*a))

    def load(part, date):
        tables = build_vault(None, None, part, f"2024-01-0{date}", once=True)
        return list(vault.load(spark, {k: tables[k] for k in ("link_survey_well", "sat_seismic_data")}).values())

    links, readings = len({r[:2] for r in rows if r[1] is not None}), len({r for r in rows if r[1] is not None})
    assert load(df.where("depth < 15"), "1") != [links, readings]
    load(df, "2")
    assert load(df, "3") == [0, 0] and copied == []
    assert load(df.where("depth < 5"), "4") == [0, 0] and copied
    assert vault.table(spark, "link_survey_well").count() == links and vault.table(spark, "sat_seismic_data").count() == readings


def test_decoded_traces_lie_in_blocks_of_surveys(spark, tmp):
    rows = [(i * 9 % 2500, i, float(i), 2.0, i % 2) for i in range(1500)]
    FWE.written(FWE.encode(spark.createDataFrame(rows, READING), f"{tmp}/lake"))
    os.makedirs(f"{tmp}/in")
    got = inputs_from_dir(spark, f"{tmp}/in", traces_dir=f"{tmp}/lake", work_dir=f"{tmp}/work")["readings"]
    assert sorted(tuple(r)[:5] for r in got.select(*READING.replace(" bigint", "").replace(" double", "").split(", ")).collect()) == sorted(rows)
    folders = [d for d in os.listdir(f"{tmp}/work/decoded") if "=" in d]
    assert sorted(folders) == ["survey_block=0", "survey_block=1", "survey_block=2"]
    by_survey = convert_lake(spark, f"{tmp}/lake", f"{tmp}/other", "2024-01-01")["readings"]
    assert by_survey.count() == 1500 and sum("survey_id=" in d for d in os.listdir(f"{tmp}/other")) == len({r[0] for r in rows})
