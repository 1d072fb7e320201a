"""Reading the landing CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.registry import LANDING_FILES, LANDING_TYPES
from millrace.session import TABLE_CODEC, materialize
from millrace.sources.tables import LINEAGE


#: Files that are read from a folder, at any depth; what else lies there is left alone.
LANDING_GLOB = "*.csv"

#: The pattern for files that `write_csv` packed.
PACKED_GLOB = "*.csv.gz"


def _options(pattern: str | None) -> dict[str, str]:
    """How landing files are found and read, the same for headers, batches and streams."""
    return {
        "header": "true", "enforceSchema": "false", "recursiveFileLookup": "true",
        "pathGlobFilter": pattern or LANDING_GLOB,
    }


def landing_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(file): the full path of each landing file, those without a record included; no content is read."""
    options = {key: value for key, value in _options(pattern).items() if key in ("recursiveFileLookup", "pathGlobFilter")}
    return spark.read.format("binaryFile").options(**options).load(path).select(F.col("_metadata.file_path").alias("file"))


def landing_schema(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> T.StructType:
    """Declared types in the order of the header found at `path`.

    Reads one line. Columns the model does not know are kept as text; a missing
    one is an error here rather than a column of NULLs later.
    """
    header = spark.read.options(**_options(pattern)).csv(path).columns
    missing = [name for name in LANDING_TYPES if name not in header]
    if missing:
        raise ValueError(f"landing files at {path} lack the columns {missing}")
    schema = T.StructType()
    for name in header:
        schema = schema.add(name, LANDING_TYPES.get(name, "string"))
    return schema


def read_landing(
    spark: SparkSession, path: str | list[str], infer: bool = False, pattern: str | None = None, lineage: bool = False
) -> DataFrame:
    """All CSV files at or below `path` whose names match `pattern` as one table.

    `path` may be a list of files. `lineage` adds the file each record came from.

    Folders may be nested or dated; their names add no column.
    Types are declared, and a file whose header differs from the others fails
    the read: CSV columns are matched by position, so accepting it would put
    values into the wrong columns. `infer=True` derives types from the data
    instead, at the price of an extra pass.
    """
    schema = landing_schema(spark, path, pattern)
    reader = spark.read.options(**_options(pattern))
    if infer:
        records = reader.option("inferSchema", True).csv(path)
    else:
        records = reader.schema(schema).csv(path)
    return records.withColumn(LINEAGE, F.col("_metadata.file_path")) if lineage else records


_CORRUPT = "_corrupt_record"


def read_landing_checked(spark: SparkSession, path: str, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, rejects): the landing records that fit the declared types, and (file, reason, record) of the others.

    `read_landing` makes a value it cannot read NULL; here such a record is set aside as it was written,
    so that records and rejects together are what landed. `reason` is `columns` where the number of fields
    differs from the header's, else the first column whose value isn't of its type. The files are parsed
    once, with all columns, into scratch storage that both tables read.
    """
    schema = landing_schema(spark, path, pattern)
    whole = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.options(**_options(pattern)).option("columnNameOfCorruptRecord", _CORRUPT)
    parsed = materialize(reader.schema(whole).csv(path).withColumn(LINEAGE, F.col("_metadata.file_path")), "landing", TABLE_CODEC)
    texts = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema.fields), T.StructField(_CORRUPT, T.StringType())])
    fields = F.from_csv(_CORRUPT, texts.simpleString()[7:-1].replace(":", " ").replace("State/Province", "`State/Province`"),
                        {"columnNameOfCorruptRecord": _CORRUPT})
    wrong = [
        F.when(F.col("f")[f.name].isNotNull() & F.expr(f"try_cast(f.`{f.name}` AS {f.dataType.simpleString()})").isNull(), F.lit(f.name))
        for f in schema.fields if not isinstance(f.dataType, T.StringType)
    ]
    reason = F.when(F.col("f")[_CORRUPT].isNotNull(), F.lit("columns")).otherwise(F.coalesce(*wrong, F.lit("value")))
    rejects = parsed.filter(F.col(_CORRUPT).isNotNull()).withColumn("f", fields)
    return (
        parsed.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT, LINEAGE),
        rejects.select(F.col(LINEAGE).alias("file"), reason.alias("reason"), F.col(_CORRUPT).alias("record")),
    )


def stream_reader(spark: SparkSession, path: str, files_per_batch: int, pattern: str | None = None) -> DataFrame:
    """The same files as a stream, each record with the file it came from."""
    reader = spark.readStream.options(**_options(pattern)).option("maxFilesPerTrigger", files_per_batch)
    return reader.schema(landing_schema(spark, path, pattern)).csv(path).withColumn(LINEAGE, F.col("_metadata.file_path"))


def landing_manifest(
    spark: SparkSession,
    path: str,
    expected: Sequence[str] = LANDING_FILES,
    label: Column | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """(source, rows, status) for every expected or found landing file.

    A missing file does not stop a load, so this is where it shows. `label`
    names a source from the file metadata; the default is the file name.
    Records are counted without parsing any column, whatever the header says,
    and files are found through a listing, so a file without records is `empty`
    rather than `missing`. `pattern` says which names are landing files.
    """
    options = {key: value for key, value in _options(pattern).items() if key != "enforceSchema"}
    listing = spark.read.format("binaryFile").options(**options).load(path)
    names = F.col("_metadata.file_name") if label is None else label
    found = listing.select(names.alias("source")).distinct().withColumn("found", F.lit(True))
    rows = (
        spark.read.options(**options).schema("first string").csv(path)
        .select(names.alias("source"))
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    wanted = spark.createDataFrame([(name, True) for name in expected], "source string, wanted boolean")
    status = (
        F.when(F.col("found").isNull(), "missing")
        .when(F.col("wanted").isNull(), "unexpected")
        .when(F.col("rows").isNull(), "empty")
        .otherwise("present")
    )
    return (
        wanted.join(found, "source", "full_outer")
        .join(rows, "source", "left")
        .select("source", F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"))
    )


def reconcile(manifest: DataFrame, bronze: DataFrame) -> DataFrame:
    """(files, landing_rows, bronze_rows, status) in one row: does bronze hold what the landing files do?

    `status` is `complete`, `short` or `over`.
    """
    landed = manifest.agg(
        F.count_if(F.col("status") != "missing").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("landing_rows")
    )
    difference = F.col("bronze_rows") - F.col("landing_rows")
    status = F.when(difference == 0, "complete").when(difference < 0, "short").otherwise("over")
    merged = bronze.agg(F.count(F.lit(1)).alias("bronze_rows"))
    return landed.withColumn("bronze_rows", merged.scalar()).select("*", status.alias("status"))
