"""Streaming ingest of raw event files into the day-partitioned staging table.

A parquet file stream (declared schema, no inference) brings the names of new
files; ``foreachBatch`` reads those files with the declared schema and applies
``merge_increment`` — the batch dedup decides which copy of an event survives, across batches and against rows already staged. The stream's
checkpoint gives exactly-once batch ids; the merge itself is idempotent, so a
replayed batch after a failure leaves the table unchanged.

Every file's footer is held against the contract in the micro-batch that brings
it, whenever it arrives. With a quarantine folder, a drifted file is set aside
there (its path and what is wrong, a row a column) and the other files of the
batch are staged; without one, it stops the stream before anything of the batch
is staged. Footers are read on the driver, one a file: ``maxFilesPerTrigger``
bounds them.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cohortflow.plans.warehouse import Warehouse
from cohortflow.sources.loads import (SchemaDriftError, Target, as_table, contract_drift, footer_schema, merge_increment,
                                      require_contract, write_table)
from cohortflow.sources.schema import RAW_EVENTS

#: Files a micro-batch takes where the caller names no number.
MAX_FILES = 1000
FOOTER_READERS = 8
FILE = "_source_file"
QUARANTINE = "source_file string, column_name string, problem string, epoch_id long"


def raw_event_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None,
                     check_start: bool = True) -> DataFrame:
    """Stream of the source's files; those there at the start must have the contract's columns (``check_start``)."""
    if check_start:
        require_contract(spark, source_dir)
    reader = spark.readStream.schema(RAW_EVENTS).option("maxFilesPerTrigger", str(max_files_per_trigger or MAX_FILES))
    return reader.parquet(source_dir)


def _path(spark: SparkSession, uri: str) -> str:
    """The path of a file's (escaped) URI."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def gate_files(spark: SparkSession, files: list[str]) -> tuple[list[str], list[tuple[str, str, str]]]:
    """Files that have the contract's columns, and (file, column, problem) of the others."""
    def drift(file: str) -> list[tuple[str, str, str]]:
        return [(file, name, what) for name, what in contract_drift(footer_schema(spark, file))]

    with ThreadPoolExecutor(FOOTER_READERS) as pool:
        found = list(pool.map(drift, files))
    return [f for f, bad in zip(files, found) if not bad], [row for bad in found for row in bad]


def start_ingest(spark: SparkSession, source_dir: str, target: Target | Warehouse, checkpoint_location: str,
                 max_files_per_trigger: int | None = None, available_now: bool = True,
                 processing_time: str | None = None, quarantine_path: str | None = None) -> StreamingQuery:
    """Start the ingest; ``available_now`` drains what is there and stops.

    Into a folder or a stored table the staging rows are merged; a ``Warehouse`` takes the batch through all its tables.
    """
    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        files = sorted(_path(spark, r[0]) for r in batch.select(FILE).distinct().collect())
        good, bad = gate_files(spark, files)
        if bad and not quarantine_path:
            raise SchemaDriftError(", ".join(f"{f}: {column} {what}" for f, column, what in bad))
        if bad:  # a replayed epoch writes the same folder again
            write_table(spark.createDataFrame([(*row, epoch_id) for row in bad], QUARANTINE), f"{quarantine_path}/epoch={epoch_id}")
        if good:
            fresh = spark.read.schema(RAW_EVENTS).parquet(*good)
            target.apply(fresh) if isinstance(target, Warehouse) else merge_increment(target, fresh)

    stream = raw_event_stream(spark, source_dir, max_files_per_trigger, check_start=quarantine_path is None)
    # the stream itself carries file names only: no column of a file is read before its footer is
    writer = (stream.selectExpr(f"_metadata.file_path AS {FILE}").writeStream.foreachBatch(apply_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def ingest_available(spark: SparkSession, source_dir: str, target: Target | Warehouse, checkpoint_location: str,
                     max_files_per_trigger: int | None = None, quarantine_path: str | None = None) -> DataFrame:
    q = start_ingest(spark, source_dir, target, checkpoint_location, max_files_per_trigger, quarantine_path=quarantine_path)
    q.awaitTermination()
    return target.table("stg_events") if isinstance(target, Warehouse) else as_table(spark, target).read("event_date_utc")
