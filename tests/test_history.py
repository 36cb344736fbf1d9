"""Reads as of a date, validity intervals, bucketed satellites and incremental marts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import history as H
from strata.operators import incremental_marts as IM
from strata.operators import marts as M
from strata.operators.bucketed import BucketedSat
from strata.operators.incremental import IncrementalVault
from strata.operators.vault import build_vault, seismic_sat
from strata.sinks import versions as SV

READING = "survey_id bigint, well_id bigint, depth double, amplitude double, quality_flag bigint, ingest_timestamp timestamp_ntz"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def readings(spark, rows):
    import datetime as dt

    return spark.createDataFrame([(s, w, float(d), a, q, dt.datetime(2020, 1, 1 + day)) for s, w, d, a, q, day in rows], READING)


# --- as of -------------------------------------------------------------------------

def test_as_of_with_ties_and_parents_without_rows(spark):
    parent = spark.createDataFrame([("a", "2"), ("b", "1"), ("c", "3"), (None, "1")], "k string, load_date string")
    sat = spark.createDataFrame([("a", "2", 5, "x"), ("a", "2", 7, "w"), ("a", "4", 1, "y"), ("c", "3", None, "z"), ("c", "3", 0, None), ("gone", "1", 1, "q")],
                                "k string, load_date string, n int, v string")
    got = {(r.k, r.as_of): (r.valid_from, r.n, r.v) for r in H.as_of(parent, sat, "k", ["1", "2", "3", "9"], ["n"]).collect()}
    none = (None, None, None)
    assert got == {("a", "2"): ("2", 7, "w"), ("a", "3"): ("2", 7, "w"), ("a", "9"): ("4", 1, "y"),
                   ("b", "1"): none, ("b", "2"): none, ("b", "3"): none, ("b", "9"): none, ("c", "3"): ("3", 0, None), ("c", "9"): ("3", 0, None)}


def test_as_of_is_one_shuffle_and_combines_first(spark, tmp):
    for name, df in (("p", spark.range(50).selectExpr("cast(id as string) k", "'1' load_date")),
                     ("s", spark.range(900).selectExpr("cast(if(id % 3 = 0, 0, id % 50) as string) k", "cast(id % 9 as string) load_date", "id n"))):
        df.write.parquet(f"{tmp}/{name}")
    parent, sat = spark.read.parquet(f"{tmp}/p"), spark.read.parquet(f"{tmp}/s")
    text = plan(H.as_of(parent, sat, "k", ["3", "5"], ["n"]))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_max" in text and "Join" not in text
    best = max((r for r in sat.collect() if r.k == "0" and r.load_date <= "5"), key=lambda r: (r.load_date, r.n))
    assert H.as_of(parent, sat, "k", ["5"], ["n"]).where("k = '0'").first().n == best.n


def test_vault_as_of_feeds_the_marts(spark, tmp):
    surveys = spark.createDataFrame([(1, "sonic"), (2, "radar")], "survey_type_id bigint, survey_type string")
    wells = spark.createDataFrame([(i, f"w{i}", 0.0, 0.0, "op") for i in range(5)], "well_id bigint, well_name string, location_lat double, location_long double, operator string")
    vault = IncrementalVault(f"{tmp}/v")
    batches = {"2024-01": readings(spark, [(1, 1, 1, 2.0, 1, 0), (1, 2, 1, 4.0, 0, 1)]), "2024-02": readings(spark, [(2, 1, 3, 6.0, 1, 2), (1, 1, 9, 8.0, 1, 3)])}
    for date, rows in batches.items():
        vault.load(spark, build_vault(surveys, wells, rows, date, keep_source_timestamp=True))
        if date == "2024-01":
            early = {r.survey_type: tuple(r) for r in M.build_marts({n: vault.table(spark, n) for n in IM.DIMENSIONS + (IM.SAT,)})["mart_sensor_analysis"].collect()}
    tables = {n: vault.table(spark, n) for n in (*IM.DIMENSIONS, IM.SAT, "sat_well_details")}
    now = H.vault_as_of(tables, "2024-01")
    assert {r.survey_type: tuple(r) for r in M.build_marts(now)["mart_sensor_analysis"].collect()} == early and len(early) == 1
    assert H.vault_as_of(tables, "2023")["hub_well"].count() == 0


# --- intervals ---------------------------------------------------------------------

ATTRS = "k string, x string, y double, load_date string"


def brute_intervals(batches):
    """Replay of the rule on plain lists: state per key is a list of (date, content)."""
    state = {}
    for rows in batches:
        for k in {r[0] for r in rows if r[0] is not None}:
            have = {d: c for d, c in state.get(k, [])}
            for r in rows:
                if r[0] == k and r[3] is not None:
                    c = (r[1], r[2])
                    have[r[3]] = c if r[3] not in have else max(have[r[3]], c, key=lambda c: brute_digest(c))
            out = []
            for d in sorted(have):
                if not out or out[-1][1] != have[d]:
                    out.append((d, have[d]))
            state[k] = out
    rows = set()
    for k, out in state.items():
        for i, (d, c) in enumerate(out):
            rows.add((k, *c, d, out[i + 1][0] if i + 1 < len(out) else None))
    return rows


def brute_digest(c):
    import hashlib
    import math

    def number(v):
        if v is None:
            return "null"
        m, e = math.frexp(abs(v))
        return "0" if v == 0 else f"{'-' if v < 0 else ''}{int(m * 2**53)}p{e - 53}"
    return hashlib.md5(f"{'null' if c[0] is None else c[0]}_{number(c[1])}".encode()).hexdigest()


def intervals(spark, sat):
    return {(r.k, r.x, r.y, r.load_date, r.valid_to) for r in sat.table(spark).collect()}


def test_intervals_against_a_replay(spark, tmp):
    rng = random.Random(2)
    batches = []
    for _ in range(5):
        date = str(rng.randrange(1, 6))
        batches.append([(rng.choice(["a", "b", "c", "d", None]), rng.choice(["p", "q", None]), rng.choice([1.5, None]), rng.choice([date, date, "3", None])) for _ in range(6)])
    sat = H.EffectivitySat(f"{tmp}/sat", ["k"])
    for rows in batches:
        sat.load(spark.createDataFrame(rows, ATTRS))
    assert intervals(spark, sat) == brute_intervals(batches)
    keys = [r.sat_hash_key for r in sat.table(spark).collect()]
    assert len(set(keys)) == len(keys)
    before = intervals(spark, sat)
    sat.compact(spark)
    assert intervals(spark, sat) == before and "Window" not in plan(sat.table(spark))
    for date in "0135":
        assert {(r.k, r.x) for r in sat.valid_at(spark, date).collect()} == {(k, x) for k, x, _, a, b in before if a <= date and (b is None or date < b)}


def test_a_load_publishes_touched_parents_only(spark, tmp):
    sat = H.EffectivitySat(f"{tmp}/sat", ["k"])
    first = spark.createDataFrame([(str(i), "p", 1.0, "1") for i in range(20)], ATTRS)
    assert sat.load(first) == 20
    assert sat.load(first) == 0 and len(SV.live_versions(spark, sat.root)) == 1  # the same batch again: no version
    assert sat.load(spark.createDataFrame([("3", "q", 1.0, "2"), ("4", "p", 1.0, "2")], ATTRS)) == 2  # both rows of parent 3
    assert sat.load(spark.createDataFrame([("3", "q", 1.0, "2")] * 3, ATTRS)) == 0
    assert {r for r in intervals(spark, sat) if r[0] == "3"} == {("3", "p", 1.0, "1", "2"), ("3", "q", 1.0, "2", None)}
    with pytest.raises(FileNotFoundError):
        H.EffectivitySat(f"{tmp}/none", ["k"]).table(spark)
    assert H.EffectivitySat(f"{tmp}/none", ["k"]).load(first.limit(0)) == 0


def test_only_live_version_folders_are_read(spark, tmp):
    for i in range(4):
        SV.publish(spark, spark.range(i + 1), f"{tmp}/t", "append" if i % 2 else "overwrite")
    assert SV.live_versions(spark, f"{tmp}/t") == [2, 3] and SV.live_versions(spark, f"{tmp}/t", 1) == [0, 1]
    spark.range(99).selectExpr("cast(id as string) as id").write.parquet(f"{tmp}/t/version=9")  # without a manifest row, and of another type
    assert SV.read_as_of(spark, f"{tmp}/t").count() == 7 and SV.read_as_of(spark, f"{tmp}/t", 0).count() == 1
    files = SV.read_as_of(spark, f"{tmp}/t").inputFiles()
    assert files and all("version=2" in f or "version=3" in f for f in files)


# --- buckets -----------------------------------------------------------------------

def test_bucketed_loads_never_shuffle_stored_rows(spark, tmp):
    rows = [(1, w % 7, w, w / 2, w % 2, w % 20) for w in range(300)]
    sat = BucketedSat("sat_bucket_test", f"{tmp}/b", buckets=8)
    try:
        first = seismic_sat(readings(spark, rows[:200]), "1", keep_source_timestamp=True)
        assert sat.load(first) == 200 and sat.load(first) == 0
        second = seismic_sat(readings(spark, rows), "2", keep_source_timestamp=True)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        text = plan(sat.unseen(second))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        lines = text[text.index("LeftAnti"):].splitlines()
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        batch = next(i for i, line in enumerate(lines) if "Exchange" in line)
        assert batch < scan  # the batch is hashed into the buckets; between it and the stored scan,
        side = max(i for i in range(scan) if lines[i].lstrip(" :").startswith("+- *") and "Sort" in lines[i])
        assert not any("Exchange" in line for line in lines[side : scan + 1]), text  # nothing but sort, filter and scan
        assert sat.load(second) == 100 and sat.table(spark).count() == 300
        want = {(r.link_survey_well_key, r.source_hash) for r in second.collect()}
        assert {(r.link_survey_well_key, r.source_hash) for r in sat.table(spark).collect()} == want
        spark.sql("DROP TABLE sat_bucket_test")  # another session: the files get their entry back
        assert sat.load(second) == 0 and sat.table(spark).count() == 300
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql("DROP TABLE IF EXISTS sat_bucket_test")


# --- incremental marts ---------------------------------------------------------------

def inputs(spark):
    surveys = spark.createDataFrame([(s, f"type {s % 2}") for s in range(4)], "survey_type_id bigint, survey_type string")
    wells = spark.createDataFrame([(i, f"w{i}", 0.0, 0.0, "op") for i in range(6)], "well_id bigint, well_name string, location_lat double, location_long double, operator string")
    rng = random.Random(4)
    batches = [[(rng.randrange(5), rng.randrange(7), rng.randrange(40), rng.choice([None, 1.0, 2.5]), rng.randrange(2), 5 * k + rng.randrange(5)) for _ in range(80)] for k in range(3)]
    return surveys, wells, batches


def mart_rows(marts):
    return {k: sorted(map(str, df.collect())) for k, df in marts.items()}


def test_incremental_marts_equal_the_full_ones(spark, tmp):
    surveys, wells, batches = inputs(spark)
    store, vault = IM.IncrementalMarts(f"{tmp}/a"), IncrementalVault(f"{tmp}/b")
    for i, rows in enumerate([*batches, batches[1]]):
        load = f"2024-0{min(i, 2) + 1}"
        first = i == 0
        tables = build_vault(surveys if first else None, wells if first else None, readings(spark, rows), load, keep_source_timestamp=True)
        tables.pop("rejects")
        store.load(spark, tables, f"load-{i}")
        vault.load(spark, tables)
    full = {n: vault.table(spark, n) for n in (*IM.DIMENSIONS, IM.SAT)}
    assert mart_rows(store.marts(spark)) == mart_rows(M.build_marts(full))
    assert store.merged(spark).count() == full["sat_seismic_data"].select("link_survey_well_key").distinct().count()
    for mart in store.marts(spark).values():
        assert not any("sat_seismic_data" in f for f in mart.inputFiles())
    with pytest.raises(ValueError):
        store.load(spark, {}, "../x")


def test_a_load_that_failed_is_counted_once(spark, tmp, monkeypatch):
    surveys, wells, batches = inputs(spark)
    plain = IncrementalVault(f"{tmp}/plain")
    for point in ("before", "after"):
        store = IM.IncrementalMarts(f"{tmp}/{point}")
        write = IM.write_parquet
        for i, rows in enumerate(batches[:2]):
            tables = build_vault(None if i else surveys, None if i else wells, readings(spark, rows), f"2024-0{i + 1}", keep_source_timestamp=True)
            tables.pop("rejects")
            if i == 1:
                def failing(df, path, mode="overwrite"):
                    if "sat_seismic_data" not in path:
                        return write(df, path, mode=mode)
                    if point == "after":
                        write(df, path, mode=mode)
                    raise OSError("lost")
                monkeypatch.setattr(IM, "write_parquet", failing)
                with pytest.raises(OSError):
                    store.load(spark, tables, f"load-{i}")
                monkeypatch.setattr(IM, "write_parquet", write)
                uncommitted = store.partials(spark).count()
                assert uncommitted == store.partials(spark).select("link_survey_well_key").distinct().count()
            store.load(spark, tables, f"load-{i}")
            if point == "before":
                plain.load(spark, tables)
        full = {n: plain.table(spark, n) for n in (*IM.DIMENSIONS, IM.SAT)}
        assert mart_rows(store.marts(spark)) == mart_rows(M.build_marts(full)), point


def test_partials_of_a_hot_link_combine_in_the_tasks(spark, tmp):
    store = IM.IncrementalMarts(f"{tmp}/h")
    surveys, wells, _ = inputs(spark)
    rows = spark.range(600).select(F.lit(1).cast("bigint").alias("survey_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 6).cast("bigint").alias("well_id"),
                                   F.col("id").cast("double").alias("depth"), F.lit(1.0).alias("amplitude"), F.lit(1).cast("bigint").alias("quality_flag"),
                                   F.lit("2020-01-01").cast("timestamp_ntz").alias("ingest_timestamp"))
    store.load(spark, build_vault(surveys, wells, rows, "2024-01", keep_source_timestamp=True), "one")
    got = {r.well_id: r.total_readings for r in store.marts(spark)["mart_well_performance"].collect()}
    assert sum(got.values()) == 600 and got[1] == 300


def test_sketches_of_loads_merge_within_the_stated_error(spark):
    links = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("hub_survey_key"),
                                       F.md5(F.col("id").cast("string")).alias("hub_well_key"))
    loads = [links.where("hub_well_key < '6'"), links.where("hub_well_key >= '4'"), links.where("hub_well_key < '6'")]  # overlapping, one repeated
    assert "partial_hll_sketch_agg" in plan(IM.survey_sketches(links))
    sketches = IM.survey_sketches(loads[0]).unionByName(IM.survey_sketches(loads[1])).unionByName(IM.survey_sketches(loads[2]))
    got = {r.hub_survey_key: r.wells_estimate for r in IM.estimated_wells(sketches).collect()}
    want = {r.hub_survey_key: r["count"] for r in links.groupBy("hub_survey_key").count().collect()}
    assert got.keys() == want.keys() and want["hot"] == 20_000
    assert all(abs(got[k] / want[k] - 1) <= IM.SKETCH_ERROR for k in want) and IM.SKETCH_ERROR < 0.05
