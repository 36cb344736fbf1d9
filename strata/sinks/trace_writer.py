"""Trace files as a Spark write format: ``df.write.format("tracefiles").mode("append").save(folder)``.

Tasks write into a staging folder of the job and report where, in a commit
message; the driver moves the staging folder into place once every task has
finished, in one rename.  A failed job removes its staging folder, so it leaves
no file: the folder is made before any task runs and never by a task, so one
that is yet to be stopped then cannot write.  What a retried or speculative
task wrote beside the attempt that counts is removed before the rename.
Readers of this package pass staging folders by.

A file's header holds its record count, so a file is written when its records
are known.  Memory is bounded all the same: a task holds at most
``bufferBytes`` (64 MB) of records, and when they are more it writes its
largest surveys out as files of their own and goes on.  A survey with a third
of all rows thus becomes many files by many tasks, none of them held whole.
``write`` deals the rows to tasks by ranges of survey first, so that a lake has
about as many files as surveys and tasks together, and not one for each pair of
them: a file takes a block of the disk however few records it holds.

``mode("overwrite")`` removes what the folder held once the new files are in
place.  Rows whose ids or flag are NULL or do not fit the format's unsigned
fields fail the write (``NotEncodable``); with ``skipNotEncodable`` they are
left out.  Columns beyond the five are ignored; a missing one is an error
before any task runs.  An empty frame writes no file.
"""

from __future__ import annotations

import struct
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

from strata.session import ship_package
from strata.sinks.fixedwidth import NotEncodable, dealt
from strata.sources.fixedwidth import HEADER_FORMAT, MAGIC, STAGING, FixedWidthDataSource, record_dtype
from strata.sources.fsys import resolve

FORMAT = "tracefiles"
COLUMNS = ("survey_id", "well_id", "depth", "amplitude", "quality_flag")
DEFAULT_BUFFER_BYTES = 64 << 20
#: How often, and after how many seconds, a failed job's folder is removed again if a task adds a file meanwhile.
REMOVALS, REMOVAL_PAUSE = 50, 0.1


class PartWritten(WriterCommitMessage):
    """What one task wrote: its folder below the staging folder (None without a file) and counts."""

    def __init__(self, folder: str | None, files: int, rows: int, most_held: int):
        self.folder, self.files, self.rows, self.most_held = folder, files, rows, most_held


class SurveyBuffers:
    """Records by survey, at most about ``limit`` bytes of them; ``emit(survey, chunks)`` takes what is over."""

    def __init__(self, limit: int, emit):
        self.limit, self.emit = limit, emit
        self.chunks: dict[int, list[bytes]] = {}
        self.sizes: dict[int, int] = {}
        self.held = self.most = 0

    def add(self, survey: int, records: bytes) -> None:
        self.chunks.setdefault(survey, []).append(records)
        self.sizes[survey] = self.sizes.get(survey, 0) + len(records)
        self.held += len(records)
        self.most = max(self.most, self.held)
        if self.held > self.limit:
            self.release(self.limit // 2)

    def release(self, down_to: int) -> None:
        """Emit the largest surveys until no more than ``down_to`` bytes are held."""
        for survey in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if self.held <= down_to:
                break
            self.held -= self.sizes.pop(survey)
            self.emit(survey, self.chunks.pop(survey))


class TraceWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema, overwrite: bool):
        lacking = sorted(set(COLUMNS) - set(schema.names))
        if lacking:
            raise ValueError(f"trace files need {', '.join(lacking)}; the frame has {schema.names}")
        self.path, self.overwrite = options.get("path"), overwrite
        self.limit = int(options.get("bufferBytes", DEFAULT_BUFFER_BYTES))
        self.suffix = options.get("suffix", ".sgx")
        self.skip = options.get("skipNotEncodable", "false").lower() == "true"
        self.job = uuid.uuid4().hex

    def _staging(self):
        fs, root = resolve(self.path)
        return fs, root.rstrip("/"), f"{root.rstrip('/')}/{STAGING}{self.job}"

    def prepare(self) -> None:
        fs, _, staging = self._staging()
        fs.create_dir(staging, recursive=True)

    def write(self, iterator):
        from pyspark import TaskContext

        fs, _, staging = self._staging()
        task = TaskContext.get()
        folder = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        files = rows = 0

        def emit(survey, chunks):
            nonlocal files
            if not files:
                fs.create_dir(f"{staging}/{folder}", recursive=False)
            with fs.open_output_stream(f"{staging}/{folder}/survey-{survey}-{files:05d}{self.suffix}") as f:
                f.write(struct.pack(HEADER_FORMAT, MAGIC, survey, sum(map(len, chunks)) // record_dtype().itemsize))
                for c in chunks:
                    f.write(c)
            files += 1

        buffers = SurveyBuffers(self.limit, emit)
        for batch in iterator:
            for survey, records in self._by_survey(batch):
                rows += len(records)
                buffers.add(survey, records.tobytes())
        buffers.release(0)
        return PartWritten(folder if files else None, files, rows, buffers.most)

    def _by_survey(self, batch):
        """(survey id, its records in the format's layout) of one Arrow batch, in the batch's order."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        whole = {c: batch.column(c).cast(pa.int64()) for c in ("survey_id", "well_id", "quality_flag")}
        ok = np.ones(batch.num_rows, dtype=bool)
        for c, bits in (("survey_id", 32), ("well_id", 32), ("quality_flag", 8)):
            fits = pc.and_(pc.greater_equal(whole[c], 0), pc.less(whole[c], 2**bits))
            ok &= pc.fill_null(fits, False).to_numpy(zero_copy_only=False)
        if not (self.skip or ok.all()):
            raise NotEncodable(f"{int((~ok).sum())} rows of a batch hold ids or flags that the format cannot store")
        values = {c: pc.fill_null(v, 0).to_numpy(zero_copy_only=False)[ok] for c, v in whole.items()}
        records = np.empty(int(ok.sum()), dtype=record_dtype())
        for c in ("well_id", "quality_flag"):
            records[c] = values[c]
        for c in ("depth", "amplitude"):  # the format has no NULL: it becomes NaN, and NULL again at ingest
            records[c] = pc.fill_null(batch.column(c).cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)[ok]
        order = np.argsort(values["survey_id"], kind="stable")
        surveys, starts = np.unique(values["survey_id"][order], return_index=True)
        for survey, rows in zip(surveys.tolist(), np.split(order, starts[1:])):
            yield survey, records[rows]

    def commit(self, messages):
        import pyarrow.fs as pafs

        fs, root, staging = self._staging()
        fs.create_dir(root, recursive=True)
        before = [f for f in fs.get_file_info(pafs.FileSelector(root)) if not f.base_name.startswith(STAGING)]
        counted = {m.folder for m in messages if m is not None and m.folder}
        if counted:
            for f in fs.get_file_info(pafs.FileSelector(staging)):
                if f.base_name not in counted:
                    fs.delete_dir(f.path)
            fs.move(staging, f"{root}/load-{self.job}")
        else:
            self._remove(fs, staging)
        if self.overwrite:
            for f in before:
                fs.delete_dir(f.path) if f.type == pafs.FileType.Directory else fs.delete_file(f.path)

    def abort(self, messages):
        fs, _, staging = self._staging()
        self._remove(fs, staging)

    def _remove(self, fs, staging):
        import pyarrow.fs as pafs

        for left in reversed(range(REMOVALS)):
            if fs.get_file_info(staging).type != pafs.FileType.Directory:
                return
            try:
                return fs.delete_dir(staging)
            except OSError:
                if not left:
                    raise
                time.sleep(REMOVAL_PAUSE)


class TraceFiles(FixedWidthDataSource):
    """The fixed-width format, readable and writable."""

    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        writer = TraceWriter(self.options, schema, overwrite)
        writer.prepare()
        return writer


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(TraceFiles)


def write(df: DataFrame, folder: str, mode: str = "append", **options) -> None:
    """``df``'s readings as trace files below ``folder``, all of them or none."""
    register(df.sparkSession)
    if set(COLUMNS) <= set(df.columns):  # else the writer says what is missing
        df = dealt(df.select(*COLUMNS))
    df.write.format(FORMAT).mode(mode).options(**{k: str(v) for k, v in options.items()}).save(folder)
