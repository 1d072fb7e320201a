"""Where tables live, and how they are read and written."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from millrace.registry import BRONZE_PATH, GOLD_PATH, LANDING_PATH, LOOKUPS, SILVER_PATH, TABLES
from millrace.session import TABLE_CODEC, remove

_WRITES_AT_ONCE = 8

#: Column of bronze that names the landing file of a record.
LINEAGE = "_landing_file"

#: Records of a packed CSV file at most. One task reads such a file, as gzip can't be split: some 100 MB of text.
PACKED_RECORDS = 1 << 19

#: Folder of silver that says which landing files its core tables cover.
COVERED = "covered_files"


@dataclass(frozen=True)
class Store:
    """The lakehouse below `base`, which may be any URI Spark can write to."""

    spark: SparkSession
    base: str

    def _at(self, path: str) -> str:
        return f"{self.base.rstrip('/')}/{path}"

    @property
    def landing(self) -> str:
        return self._at(LANDING_PATH)

    @property
    def bronze(self) -> str:
        return self._at(BRONZE_PATH)

    def silver(self, key: str) -> str:
        return self._at(f"{SILVER_PATH}/{TABLES[key].path}")

    def gold(self, key: str) -> str:
        return self._at(f"{GOLD_PATH}/{TABLES[key].table}.parquet")

    @property
    def covered(self) -> str:
        """The landing files that the core tables of silver cover, by the build or batch that added them."""
        return self._at(f"{SILVER_PATH}/{COVERED}")

    @property
    def bronze_stream(self) -> str:
        """Where streams add records. A stream's log lists all files of its folder, so batches keep out of it."""
        return f"{self.bronze}_stream"

    def read_bronze(self, lineage: bool = False) -> DataFrame:
        """All records, of batch merges and of all streams; `lineage` keeps the landing file of each."""
        parts = [self.spark.read.parquet(path) for path in (self.bronze, self.bronze_stream) if self.exists(path)]
        if not parts:
            return self.spark.read.parquet(self.bronze)  # says what is missing
        whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return whole if lineage else whole.drop(LINEAGE)

    def exists(self, path: str) -> bool:
        place, files = self._place(path)
        return files.exists(place)

    def _place(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def replace(self, path: str, df: DataFrame) -> None:
        """Write `df` next to the table at `path` and put it into its place once it is complete.

        A job that fails leaves the old table as it was. Between the two renames the path is missing for a
        moment; a driver lost just then leaves both tables complete, under names that begin with an underscore.
        `df` may read the table it replaces.
        """
        folder, _, name = path.rpartition("/")
        run = uuid.uuid4().hex
        fresh, old = f"{folder}/_{name}.{run}.new", f"{folder}/_{name}.{run}.old"
        try:
            df.write.parquet(fresh, compression=TABLE_CODEC)
        except BaseException:
            remove(self.spark, fresh)
            raise
        self._rename(path, old)
        if not self._rename(fresh, path):
            self._rename(old, path)
            raise OSError(f"could not move {fresh} to {path}")
        remove(self.spark, old)

    def _rename(self, source: str, target: str) -> bool:
        if not self.exists(source):
            return False
        place, files = self._place(source)
        return files.rename(place, self._place(target)[0])

    def read_silver(self, key: str) -> DataFrame:
        return self._read(key, self.silver(key))

    def read_gold(self, key: str) -> DataFrame:
        return self._read(key, self.gold(key))

    def _read(self, key: str, path: str) -> DataFrame:
        """Lookup types are fixed by the registry, which spares a look at the footers.

        A core table holds the files of its last whole build and a folder for each batch added since.
        """
        reader = self.spark.read
        if key in LOOKUPS:
            reader = reader.schema(LOOKUPS[key].schema)
        else:
            reader = reader.option("recursiveFileLookup", True)
        return reader.parquet(path)

    def write_bronze(self, records: DataFrame, num_files: int | None = None, append: bool = False) -> None:
        """Replace bronze, or add to it. `num_files` gathers the output, which also narrows the write to that many tasks."""
        if num_files is not None:
            records = records.coalesce(num_files)
        if append:
            records.write.mode("append").parquet(self.bronze, compression=TABLE_CODEC)
        else:
            self.replace(self.bronze, records)

    def write_silver(self, key: str, df: DataFrame) -> None:
        self.replace(self.silver(key), df)

    def write_silver_batch(self, key: str, df: DataFrame, batch: str) -> None:
        """Add one batch to a core table; written again, it takes the place of its first attempt."""
        self.replace(f"{self.silver(key)}/{batch}", df)

    def write_gold(self, key: str, df: DataFrame) -> None:
        self.replace(self.gold(key), df)


def write_csv(df: DataFrame, path: str, partition_by: str | None = None, packed: bool = False) -> None:
    """CSV files with a header line and no index column; `packed` makes them gzip files (`.csv.gz`) of bounded length."""
    writer = df.write.mode("overwrite").option("header", True)
    if packed:
        writer = writer.options(compression="gzip", maxRecordsPerFile=PACKED_RECORDS)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def write_all(spark: SparkSession, jobs: Iterable[Callable[[], None]]) -> None:
    """Run independent writes side by side, so small ones do not leave the cluster idle."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(_WRITES_AT_ONCE) as pool:
        for done in [pool.submit(inherit(job)) for job in jobs]:
            done.result()
