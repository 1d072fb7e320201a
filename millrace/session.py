"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Codec of the tables of the lakehouse: about a quarter smaller than Spark's default, and no slower.
TABLE_CODEC = "zstd"

# Names the scratch folder of the run under way; Spark hands it on to threads that inherit from this one.
_RUN = "millrace.scratch"

_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(app_name: str = "millrace", conf: Mapping[str, str] | None = None) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` wins over them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def object_store_conf(
    endpoint: str,
    path_style: bool = True,
    ssl: bool = True,
    credentials_provider: str | None = None,
) -> dict[str, str]:
    """S3A settings for an S3-compatible store. Secrets stay with the credentials provider."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
    if credentials_provider:
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = credentials_provider
    return conf


def _shared(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever storage it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


@contextmanager
def scratch_run(spark: SparkSession, base: str) -> Iterator[str]:
    """Keep all scratch data of a run in a folder of its own, removed at the end.

    It lies in the folder named by spark.checkpoint.dir, else below `base`, the place of
    the data itself. Nothing read from scratch may be used afterwards. A run that was lost
    leaves its folder behind, which no other run looks into. Within another run, that one's
    folder is used.
    """
    context = spark.sparkContext
    if context.getLocalProperty(_RUN):
        yield context.getLocalProperty(_RUN)
        return
    path = f"{(_shared(spark) or f'{base}/_scratch').rstrip('/')}/millrace/run-{uuid.uuid4().hex}"
    context.setLocalProperty(_RUN, path)
    try:
        yield path
    finally:
        context.setLocalProperty(_RUN, None)
        remove(spark, path)


def scratch_path(spark: SparkSession, label: str = "stage") -> str:
    """A fresh path in the run's scratch folder, else in the one named by spark.checkpoint.dir, which all executors share.

    Only a local master may do without both; it then gets a temporary
    folder that goes away with the process.
    """
    global _local_scratch
    run = spark.sparkContext.getLocalProperty(_RUN)
    if run:
        return f"{run}/{label}-{uuid.uuid4().hex}"
    base = _shared(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_scratch is None:
            warnings.warn("spark.checkpoint.dir is unset: scratch data goes to a temporary folder", stacklevel=2)
            _local_scratch = tempfile.TemporaryDirectory(prefix="millrace-", ignore_cleanup_errors=True)
        base = _local_scratch.name
    return f"{base.rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage", codec: str | None = None) -> DataFrame:
    """Write `df` to scratch, by a codec of Parquet's other than the session's if given, and read it back.

    Cuts the lineage on reliable storage, so values that depend on task layout
    are fixed once and survive the loss of executors, while later readers keep
    column pruning and true file sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
