"""Tables that change together: versions in folders of their own, and one pointer that says which of them count.

A run writes the partitions it changes below `<table>/version=<run>`, of as many tables as it likes. Nothing of that is seen
until the run writes the next pointer, a small file that names the version of every partition of every table. A run that
breaks off before leaves the tables as they were. Versions that no pointer needs can be dropped at any time.

One writer at a time; two that publish the same next pointer are told apart, and the later one fails.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import delete_path, path_exists
from ledgerflow.sources.tables import by_partition, counted

# table -> {partition value: version}; a table without partitions has the one value "".
State = dict[str, dict[str, str]]


@dataclass(frozen=True)
class Publication:
    """The pointer folder of some tables; `tables` names their folders."""

    pointer: str
    tables: Mapping[str, str]

    def _system(self, spark: SparkSession, path: str):
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        return location, location.getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self, spark: SparkSession) -> list[int]:
        """Numbers of the pointers that are there, oldest first."""
        pattern, system = self._system(spark, f"{self.pointer}/*.json")
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in system.globStatus(pattern) or [])

    def state(self, spark: SparkSession, number: int | None = None) -> State:
        """What a pointer says, by default the last one; nothing if none is there."""
        if number is None:
            known = self.numbers(spark)
            if not known:
                return {}
            number = known[-1]
        location, system = self._system(spark, f"{self.pointer}/{number:012}.json")
        stream = system.open(location)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(
        self, df: DataFrame, table: str, run_id: str, partition: str | None = None, written: Observation | None = None
    ) -> dict[str, str]:
        """Write rows as a version of their partitions; {partition value: version} of those that have rows. Not visible yet.

        The version has a name that no other write gets, also not one of the same run.
        """
        spark, version = df.sparkSession, f"{run_id}-{uuid4().hex[:12]}"
        folder = f"{self.tables[table]}/version={version}"
        if partition is None:
            counted(df, written).write.mode("overwrite").parquet(folder)
            return {"": version}
        counted(by_partition(df, partition), written).write.mode("overwrite").partitionBy(partition).parquet(folder)
        pattern, system = self._system(spark, f"{folder}/{partition}=*")
        names = [s.getPath().getName().split("=", 1)[1] for s in system.globStatus(pattern) or []]
        return dict.fromkeys(names, version)

    def publish(self, spark: SparkSession, changes: Mapping[str, Mapping[str, str | None]], whole: bool = False) -> int:
        """Make written versions visible, all at once; a partition without a version is no longer there.

        With `whole` the changed tables consist of the given partitions alone. Returns the number of the pointer.
        """
        known = self.numbers(spark)
        state = self.state(spark, known[-1]) if known else {}
        for table, partitions in changes.items():
            merged = {} if whole else state.get(table, {})
            state[table] = {p: v for p, v in (merged | dict(partitions)).items() if v is not None}
        number = known[-1] + 1 if known else 1
        target, system = self._system(spark, f"{self.pointer}/{number:012}.json")
        draft, _ = self._system(spark, f"{self.pointer}/.{number:012}.{spark.sparkContext.applicationId}")
        stream = system.create(draft, True)
        stream.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        stream.close()
        if system.exists(target) or not system.rename(draft, target):
            raise RuntimeError(f"pointer {number} of {self.pointer} is there already: somebody else has published")
        return number

    def read(self, spark: SparkSession, table: str, ddl: str, partition: str | None = None, number: int | None = None) -> DataFrame:
        """The table as the pointer describes it, by default the last one; no rows if it was never published."""
        parts = self.state(spark, number).get(table, {})
        if not parts:
            return spark.createDataFrame([], ddl)
        root = self.tables[table]
        versions = sorted(set(parts.values()))
        found = spark.read.schema(f"{ddl}, version string").option("basePath", root)
        found = found.parquet(*[f"{root}/version={v}" for v in versions])
        if partition is not None:
            pairs = [f"{v}/{p}" for p, v in parts.items()]
            found = found.filter(F.concat("version", F.lit("/"), partition).isin(pairs))
        return found.drop("version")

    def drop_old(self, spark: SparkSession, keep: int = 1) -> None:
        """Delete the versions that the last `keep` pointers do not need, then the older pointers."""
        known = self.numbers(spark)
        kept = [self.state(spark, n) for n in known[-keep:]]
        for table, root in self.tables.items():
            needed = {v for state in kept for v in state.get(table, {}).values()}
            pattern, system = self._system(spark, f"{root}/version=*")
            for status in system.globStatus(pattern) or []:
                if status.getPath().getName().removeprefix("version=") not in needed:
                    system.delete(status.getPath(), True)
        for number in known[:-keep]:
            delete_path(spark, f"{self.pointer}/{number:012}.json")

    def register_views(self, spark: SparkSession, ddl: Mapping[str, str], partitions: Mapping[str, str]) -> None:
        """The published tables as views for `spark.sql`; they stay with the pointer of this moment."""
        for table, columns in ddl.items():
            self.read(spark, table, columns, partitions.get(table)).createOrReplaceTempView(table)


def holds_any(column: str, values: Iterable[str]):
    """Predicate on a partition column; prunes to these values."""
    return F.col(column).isin(sorted(values))


def is_published(spark: SparkSession, pointer: str) -> bool:
    return path_exists(spark, f"{pointer}/*.json")
