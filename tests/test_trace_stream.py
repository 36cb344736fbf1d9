"""Trace files as a write format and as a stream."""

from __future__ import annotations

import os
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyspark
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.incremental import IncrementalVault
from strata.sinks import trace_writer as TW
from strata.sources import fixedwidth as FW
from strata.streaming import trace_stream as TS
from tests.test_fixedwidth import decoded, write_file

READING = "survey_id bigint, well_id bigint, depth double, amplitude double, quality_flag bigint"


def files_below(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if not f.endswith(".crc"))


def readings(spark, n=3000):
    rows = [(1, i, i / 3, -i / 7, i % 3) for i in range(n)] + [(s, 5, 1.0, 2.0, 1) for s in range(2, 40)]
    return rows, spark.createDataFrame(rows, READING).repartition(5)


def stored(rows):
    return sorted((s, w, float(np.float32(d)), float(np.float32(a)), q) for s, w, d, a, q in rows)


def test_write_reads_back_in_every_mode(spark, tmp):
    rows, df = readings(spark)
    TW.write(df.withColumn("note", F.lit("ignored")), f"{tmp}/lake")
    assert decoded(spark, f"{tmp}/lake") == stored(rows)
    TW.write(df.limit(0), f"{tmp}/lake")                                   # nothing to write: nothing changes
    TW.write(df, f"{tmp}/lake")
    assert decoded(spark, f"{tmp}/lake") == stored(rows + rows)
    TW.write(df, f"{tmp}/lake", mode="overwrite")
    assert decoded(spark, f"{tmp}/lake") == stored(rows)
    assert not any(FW.STAGING in f for f in files_below(tmp))


def test_failed_task_leaves_no_file(spark, tmp):
    rows, df = readings(spark)
    bad = df.withColumn("well_id", F.when((F.col("survey_id") == 39), F.lit(-1)).otherwise(F.col("well_id")))
    TW.write(df, f"{tmp}/lake")
    before = files_below(f"{tmp}/lake")
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="cannot store"):
            TW.write(bad, f"{tmp}/lake", mode=mode)
        assert files_below(f"{tmp}/lake") == before
    TW.write(bad, f"{tmp}/other", skipNotEncodable=True)
    assert decoded(spark, f"{tmp}/other") == stored([r for r in rows if r[0] != 39])
    with pytest.raises(Exception, match="trace files need depth"):
        TW.write(df.drop("depth"), f"{tmp}/lake")


def test_task_that_outlives_its_failed_job_leaves_no_file(tmp, monkeypatch):
    """The job is given up before one of its tasks writes: the task finds no folder and makes none."""
    schema = T.StructType.fromDDL(READING)
    batch = pa.table({"survey_id": [1, 2], "well_id": [1, 1], "depth": [1.0, 2.0], "amplitude": [1.0, 2.0], "quality_flag": [0, 1]}).to_batches()
    monkeypatch.setattr(pyspark.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0, taskAttemptId=lambda: 7))
    writer = TW.TraceFiles({"path": f"{tmp}/lake"}).writer(schema, False)
    writer.abort([])
    with pytest.raises(OSError):
        writer.write(iter(batch))
    assert os.listdir(f"{tmp}/lake") == []
    writer = TW.TraceFiles({"path": f"{tmp}/lake"}).writer(schema, False)
    writer.commit([writer.write(iter(batch))])
    assert len(files_below(f"{tmp}/lake")) == 2
    writer = TW.TraceFiles({"path": f"{tmp}/lake"}).writer(schema, False)
    writer.commit([writer.write(iter([]))])
    assert len(os.listdir(f"{tmp}/lake")) == 1


def test_unfinished_write_is_not_seen(spark, tmp):
    write_file(f"{tmp}/lake/{FW.STAGING}x/part-0/a.sgx", [(1, 1.0, 1.0, 1)])
    write_file(f"{tmp}/lake/b.sgx", [(2, 1.0, 1.0, 1)])
    assert [r[1] for r in decoded(spark, f"{tmp}/lake")] == [2]
    assert TS.announce(spark, f"{tmp}/lake", f"{tmp}/log") == 1


def test_buffers_stay_bounded_with_a_hot_survey():
    out = []
    buffers = TW.SurveyBuffers(1000, lambda survey, chunks: out.append((survey, sum(map(len, chunks)))))
    for i in range(5000):
        buffers.add(0 if i % 3 else i, b"x" * 13)
    buffers.release(0)
    assert buffers.most <= 1000 + 13
    assert sum(n for _, n in out) == 5000 * 13
    assert max(n for s, n in out if s == 0) <= 1000 + 13


def test_hot_survey_becomes_many_files(spark, tmp):
    rows, df = readings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        TW.write(df.coalesce(1), tmp, bufferBytes=4000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    hot = [f for f in files_below(tmp) if "survey-1-" in f]
    assert len(hot) > 5
    assert decoded(spark, tmp) == stored(rows)


def test_null_values_become_nan(spark, tmp):
    TW.write(spark.createDataFrame([(1, 1, None, 2.0, 1)], READING), tmp)
    assert np.isnan(FW.read(spark, tmp).first().depth)


def test_stream_takes_each_file_once_and_restarts(spark, tmp):
    lake, log, out, ckpt = (f"{tmp}/{d}" for d in ("lake", "log", "out", "ckpt"))
    sizes = dict(entry_bytes=2 << 20, max_bytes=2 << 20, range_records=2)

    def run():
        return TS.convert_arrivals(spark, lake, log, out, ckpt, **sizes)

    def got():
        return sorted((r.well_id, r.depth) for r in spark.read.parquet(out).collect())

    write_file(f"{lake}/a/one.sgx", [(i, float(i), 1.0, 1) for i in range(7)])
    write_file(f"{lake}/a/empty.sgx", [])
    write_file(f"{lake}/bad.sgx", [(9, 1.0, 1.0, 1)], magic=b"XXXXXXXX")
    write_file(f"{lake}/over.sgx", [(50, 1.0, 1.0, 1)], count=10, tail=b"\x01" * 5)
    assert run() == 4 + 1 + 1 + 1
    first = [(i, float(i)) for i in range(7)] + [(50, 1.0)]
    assert got() == sorted(first)
    batches = len(os.listdir(f"{ckpt}/commits"))
    assert batches > 1                                                      # admitted by bytes, not all at once
    assert run() == 0 and got() == sorted(first)                            # nothing new
    write_file(f"{lake}/b/one.sgx", [(100, 2.0, 1.0, 1)])
    assert run() == 1
    assert got() == sorted([*first, (100, 2.0)])


def test_stream_of_an_empty_lake(spark, tmp):
    os.makedirs(f"{tmp}/lake")
    assert TS.convert_arrivals(spark, f"{tmp}/lake", f"{tmp}/log", f"{tmp}/out", f"{tmp}/ckpt") == 0
    assert TS.load_arrivals(spark, f"{tmp}/lake", f"{tmp}/log", f"{tmp}/v", f"{tmp}/c", "1") == {"batches": 0}


def test_file_that_cannot_be_opened_is_tried_again(spark, tmp):
    lake, log, out, ckpt = (f"{tmp}/{d}" for d in ("lake", "log", "out", "ckpt"))
    write_file(f"{lake}/a.sgx", [(1, 1.0, 1.0, 1)])
    assert TS.announce(spark, lake, log) == 1
    os.rename(f"{lake}/a.sgx", f"{lake}/a.away")
    with pytest.raises(Exception):
        TS.convert_arrivals(spark, lake, log, out, ckpt)
    os.rename(f"{lake}/a.away", f"{lake}/a.sgx")
    TS.convert_arrivals(spark, lake, log, out, ckpt)
    assert [r.well_id for r in spark.read.parquet(out).collect()] == [1]


def test_stream_into_the_vault(spark, tmp):
    rows, df = readings(spark, 100)
    TW.write(df, f"{tmp}/lake")
    args = (spark, f"{tmp}/lake", f"{tmp}/log", f"{tmp}/vault", f"{tmp}/ckpt", "2024-01-01")
    added = TS.load_arrivals(*args)
    assert added["link_survey_well"] == len({(s, w) for s, w, *_ in rows})
    sat = IncrementalVault(f"{tmp}/vault").table(spark, "sat_seismic_data").count()
    assert added["sat_seismic_data"] == sat == len(set(stored(rows)))
    assert TS.load_arrivals(*args)["sat_seismic_data"] == 0
