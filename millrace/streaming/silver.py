"""Silver as a stream: new records of bronze are added to it, without reading the old ones."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.plans.entities import Stamp
from millrace.plans.pipeline import add_to_silver
from millrace.registry import BY_PATH
from millrace.sources.tables import Store


def stream_silver(
    store: Store, progress: str, mode: str = BY_PATH, as_of: Stamp = None, key_type: str = "bigint"
) -> None:
    """Add what came to bronze since the last run to silver, then stop.

    Both parts of bronze are followed, each by a stream that keeps its checkpoint below `progress`. All
    files that are new make one batch, since a landing file may lie in several files of bronze; so merges and
    this must not run at the same time. Landing files that silver covers already, by a whole build or by the
    other part, are left out: a merge or a build that starts anew doubles nothing. `build_silver` may
    be run at any time, and gathers the batches' files in larger ones.
    """
    for part, path in (("batch", store.bronze), ("stream", store.bronze_stream)):
        if not store.exists(path):
            continue

        def add(records: DataFrame, number: int, part: str = part) -> None:
            add_to_silver(Store(records.sparkSession, store.base), records, f"{part}-{number:06}", mode, as_of, key_type)

        schema = store.spark.read.parquet(path).schema
        query = (
            store.spark.readStream.schema(schema).parquet(path)
            .writeStream.foreachBatch(add)
            .option("checkpointLocation", f"{progress.rstrip('/')}/{part}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
