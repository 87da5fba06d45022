"""Audit tables of the runs: one manifest row per delivery, one report row per table."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.enrich import run_clock

# --- fixed values -------------------------------------------------------------
SUCCESS = "SUCCESS"
PARTIAL = "PARTIAL"
FAILED = "FAILED"

# What became of a delivery.
INGESTED = "ingested"
MISSING_COLUMNS = "missing_columns"
OVERFLOWING = "overflowing"
EMPTY = "empty"

MANIFEST_DDL = (
    "run_id string, run_ts timestamp, status string, source_file string, outcome string, "
    "missing_columns string, rows_read bigint, rows_written bigint, rows_skipped bigint, "
    "rows_quarantined bigint, rows_undated bigint, rows_out_of_range bigint, extra map<string,string>"
)
REPORT_DDL = (
    "run_id string, pipeline_stage string, start_ts timestamp, end_ts timestamp, "
    "duration_seconds double, status string, table_name string, rows_read bigint, "
    "rows_written bigint, rows_quarantined bigint"
)
# ------------------------------------------------------------------------------


def run_status(counts: DataFrame) -> str:
    """PARTIAL once a delivery was left out or a row has no date. `counts` has one row per delivery."""
    return SUCCESS if counts.filter((F.col("outcome") != INGESTED) | (F.col("rows_undated") > 0)).isEmpty() else PARTIAL


def run_manifest(
    counts: DataFrame, run_id: str, run_ts: datetime, status: str, extra: Mapping[str, str] | None = None
) -> DataFrame:
    """Manifest rows of one ingest run, with any further facts about it in `extra`.

    A run that met no delivery has one row, without a name and with zeros.
    """
    if counts.isEmpty():
        nothing = {f.name: F.lit(0).cast(f.dataType) for f in counts.schema if f.name.startswith("rows_")}
        counts = counts.sparkSession.range(1).select(
            *[nothing.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in counts.schema]
        )
    facts = F.create_map(*[F.lit(text) for item in (extra or {}).items() for text in item])
    return counts.withColumns(
        {
            "run_id": F.lit(run_id),
            "run_ts": F.lit(run_ts),
            "status": F.lit(status),
            "extra": facts.cast("map<string,string>"),
        }
    ).select(*[c.split()[0] for c in MANIFEST_DDL.split(", ")])


def delivery_measures(counts: DataFrame) -> DataFrame:
    """Manifest counts as report rows; a delivery left out counts as quarantined whole."""
    return counts.select(
        F.col("source_file").alias("table_name"),
        "rows_read",
        "rows_written",
        F.when(F.col("outcome") == INGESTED, F.col("rows_quarantined")).otherwise(F.col("rows_read")).alias("rows_quarantined"),
    )


def stage_summary(measures: DataFrame) -> DataFrame:
    """One row: totals over all tables of a stage and the status they imply."""
    return measures.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_read", "rows_written", "rows_quarantined")]
    ).withColumn("status", F.when(F.col("rows_quarantined") > 0, PARTIAL).otherwise(SUCCESS))


@dataclass
class StageReport:
    """Collects the measures of a stage while it runs."""

    run_id: str
    stage: str
    start_ts: datetime
    failed: bool = False
    measures: list[DataFrame] = field(default_factory=list)

    def record(self, measures: DataFrame) -> None:
        """Add rows of (table_name, rows_read, rows_written, rows_quarantined)."""
        self.measures.append(measures)

    def record_table(self, spark: SparkSession, name: str, read: int = 0, written: int = 0, quarantined: int = 0) -> None:
        ddl = "table_name string, rows_read bigint, rows_written bigint, rows_quarantined bigint"
        self.record(spark.createDataFrame([(name, read, written, quarantined)], ddl))

    def rows(self, spark: SparkSession, end_ts: datetime) -> DataFrame:
        """Report rows; measures of the same table add up, and a run without any keeps one row."""
        if self.measures:
            merged = self.measures[0]
            for part in self.measures[1:]:
                merged = merged.unionByName(part)
            merged = merged.groupBy("table_name").agg(
                *[F.sum(c).alias(c) for c in ("rows_read", "rows_written", "rows_quarantined")]
            )
        else:
            merged = spark.createDataFrame(
                [(None, 0, 0, 0)],
                "table_name string, rows_read bigint, rows_written bigint, rows_quarantined bigint",
            )
        status = FAILED if self.failed else stage_summary(merged).first()["status"]
        seconds = round((end_ts - self.start_ts).total_seconds(), 3)
        return (
            merged.withColumns(
                {
                    "run_id": F.lit(self.run_id),
                    "pipeline_stage": F.lit(self.stage),
                    "start_ts": F.lit(self.start_ts),
                    "end_ts": F.lit(end_ts),
                    "duration_seconds": F.lit(seconds),
                    "status": F.lit(status),
                }
            ).select(*[c.split()[0] for c in REPORT_DDL.split(", ")])
        )


@contextmanager
def track_stage(spark: SparkSession, run_id: str, stage: str, path: str | None) -> Iterator[StageReport]:
    """Time a stage and append its report to `path`, also when it fails; errors pass on."""
    report = StageReport(run_id, stage, run_clock())
    try:
        yield report
    except Exception:
        report.failed = True
        raise
    finally:
        if path:
            report.rows(spark, run_clock()).write.mode("append").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_DDL).json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_DDL).json(path)

