"""Tables stored in buckets of a key, so that a join on it does not shuffle them.

The bucket a row lies in is part of its file's name, which Spark uses once the folder is known to the catalog as a bucketed
table. The catalog entry is made anew in every session that does not have it; it holds nothing that the folder does not.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import path_exists, qualified_path

# Buckets of a new table; an existing one keeps those it was made with.
BUCKETS = 32


@dataclass(frozen=True)
class Bucketed:
    """A folder of rows in buckets of `key`; `partition` adds one folder level by that column."""

    path: str
    ddl: str
    key: str
    partition: str | None = None

    def columns(self) -> list[str]:
        return [c.split()[0] for c in self.ddl.split(", ")]

    def folder(self, spark: SparkSession) -> tuple[str, int] | None:
        """(folder, buckets) of the stored rows, None if nothing is stored yet."""
        pattern = f"{self.path}/buckets=*"
        if not path_exists(spark, pattern):
            return None
        location = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = location.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(location)
        numbers = sorted(int(s.getPath().getName().removeprefix("buckets=")) for s in found)
        return f"{self.path}/buckets={numbers[0]}", numbers[0]

    def known(self, spark: SparkSession, folder: str, buckets: int) -> str:
        """Name of the catalog entry, made if the session has none."""
        name = f"ledgerflow_{sha256(qualified_path(spark, folder).encode()).hexdigest()[:24]}"
        if not spark.catalog.tableExists(name):
            quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
            partitioned = f"PARTITIONED BY ({self.partition}) " if self.partition else ""
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({self.ddl}) USING parquet {partitioned}"
                f"CLUSTERED BY ({self.key}) INTO {buckets} BUCKETS LOCATION '{quoted}'"
            )
            if self.partition and spark.conf.get("spark.sql.catalogImplementation") == "hive":
                spark.catalog.recoverPartitions(name)
        return name

    def append(self, rows: DataFrame, buckets: int = BUCKETS) -> None:
        """Add rows: one shuffle of these rows alone, then one file per bucket (and partition)."""
        spark = rows.sparkSession
        folder, buckets = self.folder(spark) or (f"{self.path}/buckets={buckets}", buckets)
        name = self.known(spark, folder, buckets)
        rows.select(*self.columns()).repartition(buckets, self.key).write.insertInto(name)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All rows, None if nothing is stored. Joined on the key, they need no exchange."""
        place = self.folder(spark)
        if place is None:
            return None
        name = self.known(spark, *place)
        spark.catalog.refreshTable(name)
        return spark.table(name).select(*[F.col(c) for c in self.columns()])
