"""The landing merge as a stream, for files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.registry import LANDING_PATTERN
from millrace.session import TABLE_CODEC
from millrace.sources.landing import stream_reader
from millrace.sources.ledger import merged_files
from millrace.sources.tables import LINEAGE, Store


FILES_PER_BATCH = 1000


def stream_landing(
    store: Store, progress: str, landing: str | None = None, files_per_batch: int = FILES_PER_BATCH, pattern: str | None = None
) -> DataFrame:
    """Merge the landing files not merged before into bronze, each exactly once, then stop.

    `progress` holds the stream's checkpoint and must stay with the bronze
    table it belongs to. Streams and batch merges have folders of their own, and
    bronze is both together. A file that a batch has merged is left out here, and
    batches leave out what streams hold, so one folder may be given to both, but
    not at the same time. Records are independent here, so the stream keeps no
    state and a run costs only the files that are new. A backlog is worked off
    in batches of `files_per_batch`, each committed on its own, so a run that is
    interrupted resumes after the last finished batch. `pattern` says which names are landing files.
    """
    pattern = pattern or (None if landing else LANDING_PATTERN)
    records = stream_reader(store.spark, landing or store.landing, files_per_batch, pattern)
    known = merged_files(store, stream=False)
    if not known.isEmpty():
        records = unmerged(records, known)
    query = (
        records.writeStream.format("parquet")
        .option("path", store.bronze_stream)
        .option("compression", TABLE_CODEC)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store.read_bronze()


def unmerged(records: DataFrame, known: DataFrame) -> DataFrame:
    """The records of files not in `known`, one path per merged file. A stream isn't planned anew by its
    sizes, and Spark sizes `known` by all of bronze: without the hint the records would be shuffled."""
    return records.join(F.broadcast(known), LINEAGE, "left_anti").select(records.columns)
