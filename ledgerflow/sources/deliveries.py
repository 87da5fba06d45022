"""CSV deliveries: one pinned listing and one parse per run, whatever the headers.

A delivery is one CSV file or, with `unit="folder"`, one folder of part files,
which is how a distributed producer drops a delivery too big for one file. Its
name is its path below the landing folder.

The first line of every file is read on its own, without the rest of a large
file; the distinct headers then say how wide the one parse of the rows must be.
That parse is never stored: a job stages what it makes of the rows. Files are
taken from a listing made before, so a file that arrives during a run waits for
the next one.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.layout import METADATA_COLUMNS
from ledgerflow.operators.joins import broadcast_if_small
from ledgerflow.session import path_exists, qualified_path, stage

# Fields that a parse has room for beyond the longest header, to see rows that are too long.
SURPLUS = 8
# Helper columns next to the payload; no delivery may use these names.
HEADER_ID = "_ledgerflow_header"
TOO_LONG = "_ledgerflow_long"
RESERVED = (HEADER_ID, TOO_LONG, "_ledgerflow_fate", "_ledgerflow_text")
# Lines of a file that reach Python at once while headers are read, and how many batches of a file are read to its end
# so that the worker can go on with the next file.
HEAD_LINES = 512
HEAD_BATCHES = 64
# A split that no file exceeds, so that every file is one task while headers are read.
WHOLE_FILE = 1 << 40


@dataclass(frozen=True)
class Landing:
    """Where deliveries arrive and what counts as one.

    `modified_after` (`YYYY-MM-DDTHH:mm:ss`) leaves out files that have not
    changed since, so that a run need not parse the whole history again.
    `multi_line` allows line breaks inside quotes, at the price that a file is
    no longer split among tasks.
    """

    folder: str
    pattern: str = "*.csv"
    unit: str = "file"
    multi_line: bool = False
    modified_after: str | None = None

    def __post_init__(self) -> None:
        if self.unit not in ("file", "folder"):
            raise ValueError(f"unit must be 'file' or 'folder', got {self.unit!r}")

    def options(self) -> dict[str, str]:
        chosen = {"pathGlobFilter": self.pattern, "recursiveFileLookup": str(self.unit == "folder").lower()}
        return chosen | ({"modifiedAfter": self.modified_after} if self.modified_after else {})

    def delivery_of(self, spark: SparkSession, path: Column) -> Column:
        """Delivery name of a plain path: the path of the file, or of its folder, below the landing folder."""
        base = qualified_path(spark, self.folder).rstrip("/")
        below = F.when(F.startswith(path, F.lit(base + "/")), F.substring(path, len(base) + 2, 1 << 30))
        file = F.coalesce(below, F.element_at(F.split(path, "/"), -1))
        if self.unit == "file":
            return file
        return F.when(F.contains(file, F.lit("/")), F.regexp_replace(file, "/[^/]*$", "")).otherwise(base.split("/")[-1])


def plain(path: Column) -> Column:
    """The path part of a location; file metadata holds URI-encoded ones, though most need no decoding."""
    text = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def listing(spark: SparkSession, landing: Landing) -> DataFrame:
    """(path, source_file) of all delivery files, empty ones included; no file is opened.

    This is the listing Spark makes for any scan; it stays in the JVM and becomes a table there.
    """
    if not path_exists(spark, landing.folder):
        return spark.createDataFrame([], "path string, source_file string")
    found = spark.read.options(**landing.options()).text(landing.folder)
    paths = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(found._jdf.inputFiles())
    encoder = spark._jvm.org.apache.spark.sql.Encoders.STRING()
    files = DataFrame(spark._jsparkSession.createDataset(paths, encoder).toDF(), spark)
    path = plain(F.col("value"))
    return files.select(path.alias("path"), landing.delivery_of(spark, path).alias("source_file"))


def discover(spark: SparkSession, landing: Landing) -> list[str]:
    """Sorted names of all deliveries, for people; the jobs work on `listing`."""
    return sorted(r[0] for r in listing(spark, landing).select("source_file").distinct().collect())


def parse_header(fields: Sequence[str | None]) -> list[str]:
    """Column names of a header line; repeats get a numeric suffix."""
    seen: dict[str, int] = {}
    result = []
    for i, name in enumerate(fields):
        name = (name or "").lstrip("﻿" if not i else "")
        count = seen.get(name.lower(), 0)
        seen[name.lower()] = count + 1
        result.append(f"{name}.{count}" if count else name)
    return result


def header_fields(lines: Iterator[str]) -> list[str] | None:
    """Fields of the first line that is not blank, quoted line breaks included; trailing empty ones do not count."""
    for line in lines:
        if not line.strip():
            continue
        while line.count('"') % 2 and (more := next(lines, None)) is not None:
            line += "\n" + more
        fields = next(csv.reader([line.replace("\r", "")] if "\n" not in line else line.splitlines(True)))
        while fields and not fields[-1]:
            fields.pop()
        return fields
    return None


def first_lines(multi_line: bool):
    """A task over the lines (path, value) of one file that yields its header; it reads on only in a short file."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path: list[str] = []

        def lines() -> Iterator[str]:
            for batch in batches:
                if batch.num_rows:
                    path[:] = [batch.column("path")[0].as_py()]
                yield from batch.column("value").to_pylist()

        every = lines()
        if multi_line:
            found = header_fields(every)
        else:
            found = next((header_fields(iter([line])) for line in every if line.strip()), None)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array(path), pa.array([json.dumps(found)])], ["path", "text"])
        for _ in zip(range(HEAD_BATCHES), batches):
            pass

    return task


@contextmanager
def one_task_per_file(spark: SparkSession) -> Iterator[None]:
    """Scans planned within the block do not split files, put each in a task of its own, and hand on few lines at once."""
    settings = {
        "spark.sql.files.maxPartitionBytes": WHOLE_FILE,
        "spark.sql.files.openCostInBytes": WHOLE_FILE,
        "spark.sql.execution.arrow.maxRecordsPerBatch": HEAD_LINES,
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def file_headers(spark: SparkSession, landing: Landing) -> DataFrame:
    """(path, text) of every file with a line: its header as a JSON array, staged."""
    lines = spark.read.options(**landing.options()).text(landing.folder)
    lines = lines.select(plain(F.col("_metadata.file_path")).alias("path"), "value")
    with one_task_per_file(spark):
        return stage(lines.mapInArrow(first_lines(landing.multi_line), "path string, text string"), "headers")


def parsed(spark: SparkSession, landing: Landing, fields: int) -> DataFrame:
    """Every line but the headers, by position: path, used (the last field that is there), c0, c1, ..."""
    columns = [f"c{i}" for i in range(fields)]
    rows = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        .options(**landing.options())
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", landing.multi_line)
        .csv(landing.folder)
    )
    used = F.greatest(F.lit(0), *[F.when(F.col(c).isNotNull(), F.lit(i + 1)).otherwise(F.lit(0)) for i, c in enumerate(columns)])
    return rows.select(plain(F.col("_metadata.file_path")).alias("path"), used.alias("used"), *columns)


@dataclass(frozen=True)
class Deliveries:
    """The deliveries of one run, pinned.

    `headers` are the distinct headers (one entry per layout, not per file).
    `files` has one row per listed file: path, source_file, header (its number,
    NULL without a header line).
    """

    landing: Landing
    headers: list[list[str]]
    files: DataFrame

    def columns(self, headers: Sequence[int] | None = None) -> list[str]:
        """Payload columns of these headers, in order of appearance."""
        chosen = range(len(self.headers)) if headers is None else headers
        return [c for c in dict.fromkeys(n for h in chosen for n in self.headers[h]) if c not in METADATA_COLUMNS]

    def lines(self, files: DataFrame | None = None) -> DataFrame:
        """The data lines of these files (by default all) by position, with `source_file`, HEADER_ID and TOO_LONG.

        A line is cut `SURPLUS` fields after the longest header.
        """
        files = self.files if files is None else files
        spark = files.sparkSession
        known = files.filter("header IS NOT NULL").select("path", "source_file", F.col("header").alias(HEADER_ID))
        width = max(map(len, self.headers), default=0) + SURPLUS
        if not self.headers:
            empty = spark.createDataFrame([], f"path string, used int, {', '.join(f'c{i} string' for i in range(width))}")
            return empty.join(known, "path").withColumn(TOO_LONG, F.lit(False))
        length = F.element_at(F.array(*[F.lit(len(h)) for h in self.headers]), F.col(HEADER_ID) + 1)
        found = parsed(spark, self.landing, width).join(broadcast_if_small(known), "path")
        return found.withColumn(TOO_LONG, F.col("used") > length)

    def rows(self, files: DataFrame | None = None, headers: Sequence[int] | None = None) -> DataFrame:
        """Data rows of these files (by default all) as text, matched by column name, with `source_file`, HEADER_ID, TOO_LONG.

        Blanks and missing fields are "", a column that a file lacks is NULL. `headers` are those of the files.
        """
        chosen = list(range(len(self.headers))) if headers is None else list(headers)

        def text(name: str) -> Column:
            value = F.lit(None).cast("string")
            for h in chosen:
                if name in self.headers[h]:
                    at = self.headers[h].index(name)
                    value = F.when(F.col(HEADER_ID) == h, F.coalesce(F.col(f"c{at}"), F.lit(""))).otherwise(value)
            return value

        return self.lines(files).select(*[text(c).alias(c) for c in self.columns(chosen)], "source_file", HEADER_ID, TOO_LONG)

    def shapes(self) -> DataFrame:
        """(path, source_file, header, rows, overflow) of every listed file; parses all of them."""
        counts = self.lines().groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.max(TOO_LONG).alias("overflow"))
        return self.files.join(counts, "path", "left").fillna(0, ["rows"]).fillna(False, ["overflow"])


def read_landing(spark: SparkSession, landing: Landing, columns: Sequence[str] | None = None) -> Deliveries:
    """List the landing folder and read its headers. `columns` promises one header; another one is an error.

    The driver sees one entry per distinct header; files stay in a table.
    """
    files = stage(listing(spark, landing), "files")
    if files.isEmpty():
        return Deliveries(landing, [], files.withColumn("header", F.lit(None).cast("int")))
    heads = file_headers(spark, landing)
    texts = [r[0] for r in heads.select("text").distinct().orderBy("text").collect()]
    headers = [parse_header(json.loads(t)) for t in texts]
    for header in headers:
        clash = set(header) & set(RESERVED)
        if clash:
            raise ValueError(f"reserved column names in a delivery: {sorted(clash)}")
    if columns is not None and any(h != list(columns) for h in headers):
        raise ValueError(f"CSV header does not conform to the promised columns {list(columns)}")
    numbers = spark.createDataFrame(list(enumerate(texts)), "header int, text string")
    described = files.join(heads.join(F.broadcast(numbers), "text").select("path", "header"), "path", "left")
    return Deliveries(landing, headers, stage(described.select("path", "source_file", "header"), "described-files"))


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows; a column absent from a part is NULL there."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


def read_deliveries(spark: SparkSession, landing: Landing, columns: Sequence[str] | None = None) -> DataFrame:
    """All readable deliveries as text, matched by column name."""
    found = read_landing(spark, landing, columns)
    long = found.lines().filter(TOO_LONG).select("source_file").distinct()
    # A row longer than its header disqualifies its delivery, which only a whole parse can tell.
    files = stage(found.files.join(long, "source_file", "left_anti"), "sound-files")
    return found.rows(files).drop(HEADER_ID, TOO_LONG)
