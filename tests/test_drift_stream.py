"""A file stream whose columns change while it runs."""

from __future__ import annotations

import os

import pytest

from strata.streaming import drift_stream as DS


def drop(spark, tmp, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp}/inbox/{name}")


def load(spark, tmp, **kw):
    DS.load_drifting(spark, f"{tmp}/inbox", f"{tmp}/table", f"{tmp}/ckpt", **kw)


def got(spark, tmp, *columns):
    return sorted(map(tuple, DS.read(spark, f"{tmp}/table").select(*columns).collect()), key=str)


def test_columns_come_go_and_widen(spark, tmp):
    drop(spark, tmp, "a", [(1, 5), (2, None)], "id int, v bigint")
    load(spark, tmp)
    assert DS.read(spark, f"{tmp}/table").dtypes == [("id", "int"), ("v", "bigint")]
    drop(spark, tmp, "b", [(2**40, 0.5, "x")], "id bigint, v double, note string")      # wider, and one more
    drop(spark, tmp, "c", [("only",)], "note string")                                     # lacks two
    load(spark, tmp)
    load(spark, tmp)                                                                      # nothing new
    table = DS.read(spark, f"{tmp}/table")
    assert table.dtypes == [("id", "bigint"), ("v", "double"), ("note", "string")]
    want = [(1, 5.0, None), (2, None, None), (2**40, 0.5, "x"), (None, None, "only")]
    assert got(spark, tmp, "id", "v", "note") == sorted(want, key=str)
    assert sorted(DS.drift_events(spark, f"{tmp}/table")) == [
        (1, "id", "type_changed", "int", "bigint"), (1, "note", "added", None, "string"), (1, "v", "type_changed", "bigint", "double")]
    drop(spark, tmp, "d", [(7,)], "id int")                                               # an old, narrow file again
    load(spark, tmp)
    assert len(DS.versions(spark, f"{tmp}/table")) == 2
    assert (7, None, None) in got(spark, tmp, "id", "v", "note")


def test_batch_run_again_counts_once(spark, tmp):
    drop(spark, tmp, "a", [(1,), (2,)], "id int")
    files = spark.createDataFrame([(f"{tmp}/inbox/a/{f}",) for f in os.listdir(f"{tmp}/inbox/a") if f.endswith(".parquet")], "path string")
    for _ in range(2):
        DS.store_files(files, f"{tmp}/table", 0)
    assert got(spark, tmp, "id") == [(1,), (2,)]
    assert len(DS.versions(spark, f"{tmp}/table")) == 1
    DS.store_files(files.limit(0), f"{tmp}/table", 1)                                     # an empty batch
    assert got(spark, tmp, "id") == [(1,), (2,)]


def test_types_that_no_type_holds_stop_the_stream(spark, tmp):
    drop(spark, tmp, "a", [(1,)], "id int")
    load(spark, tmp)
    drop(spark, tmp, "b", [("x",)], "id string")
    with pytest.raises(Exception, match="no single type holds"):
        load(spark, tmp)
    assert got(spark, tmp, "id") == [(1,)]
    with pytest.raises(ValueError, match="no batch"):
        DS.read(spark, f"{tmp}/none")
