"""Incremental vault loading as a bounded file stream.

``readStream`` over the folder where reading files land, ``foreachBatch``
builds the link, satellite and reject rows of each micro-batch and appends
only what is new (``strata.operators.incremental``).  The stream's checkpoint (under
the shared checkpoint folder) remembers which files were processed, so a
re-run with ``availableNow`` picks up only files that arrived since; a batch
replayed after a failure finds its rows already stored and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators.incremental import IncrementalVault
from strata.operators.vault import build_link, rejects, seismic_sat
from strata.sources.readings import clean_readings


def load_readings_stream(spark: SparkSession, input_dir: str, schema: T.StructType | str,
                         vault_root: str, checkpoint: str, load_ts: str,
                         max_files_per_trigger: int = 1000, keep_source_timestamp: bool = True) -> dict:
    """Process every file not yet seen under ``input_dir``; returns progress info."""
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(input_dir))
    return load_stream(stream, vault_root, checkpoint, load_ts, keep_source_timestamp)


def load_stream(stream: DataFrame, vault_root: str, checkpoint: str, load_ts: str,
                keep_source_timestamp: bool = True) -> dict:
    """Load what a stream of readings holds now into the vault, and stop; rows added per table."""
    vault = IncrementalVault(vault_root)
    added = {"batches": 0, "link_survey_well": 0, "sat_seismic_data": 0, "rejects": 0}

    def process(batch: DataFrame, batch_id: int) -> None:
        readings = clean_readings(batch)
        tables = {
            "link_survey_well": build_link(readings, "survey_id", "well_id", load_ts),
            "sat_seismic_data": seismic_sat(readings, load_ts,
                                            keep_source_timestamp=keep_source_timestamp, once=True),
            "rejects": rejects(readings, ["survey_id", "well_id"], "link_survey_well"),
        }
        res = vault.load(batch.sparkSession, tables)
        added["batches"] += 1
        for k, v in res.items():
            added[k] += v

    q = (stream.writeStream.foreachBatch(process)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return added
