"""Which days to query, and how far the record is complete."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ProducerConfig:
    bootstrap_days: int = 31
    max_gap_closures: int = 5
    max_changed_partitions: int = 7
    #: days before today that are asked again when there is no gap
    overlap_days: int = 1
    max_per_run: int = 20
    batch_size: int = 20
    warning_bytes: int = 524_288_000
    stop_bytes: int = 786_432_000
    metadata_prefix: str = "arXivRaw"

    def __post_init__(self) -> None:
        if min(self.bootstrap_days, self.max_gap_closures, self.max_changed_partitions) < 1:
            raise ValueError("planning limits must be positive")


@dataclass(frozen=True)
class Plan:
    coverage_start: date
    source_dates: list[str] = field(default_factory=list)
    pending_before: list[str] = field(default_factory=list)


def plan_collection(today: date, config: ProducerConfig, start: date | None = None, closed_through: date | None = None) -> Plan:
    """Oldest gaps first; today only when every gap is asked; without a gap the overlap and today."""
    begin = start or today - timedelta(days=config.bootstrap_days - 1)
    at = closed_through + timedelta(days=1) if closed_through else begin
    pending = [(at + timedelta(days=i)).isoformat() for i in range(max(0, (today - at).days))]
    chosen = pending[: config.max_gap_closures]
    if not pending:
        chosen += [(today - timedelta(days=i)).isoformat() for i in range(config.overlap_days, -1, -1)]
    elif len(chosen) == len(pending):
        chosen.append(today.isoformat())
    return Plan(begin, list(dict.fromkeys(chosen))[: config.max_changed_partitions], pending)


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """``source_date`` of every day from start to end; none if end is before start."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).filter(F.lit(start) <= F.lit(end)).select(F.explode(F.transform(days, lambda d: d.cast("string"))).alias("source_date"))


def frontier(spark: SparkSession, closed: DataFrame, start: str, today: str) -> DataFrame:
    """``closed_complete_through, n_gaps``: the last day up to which every day before today is closed.

    Days close by being queried, never by time, so this is an anti-join with the calendar.
    """
    last = F.date_sub(F.lit(today).cast("date"), 1)
    days = calendar(spark, start, today).filter(F.col("source_date") < today)
    missing = days.join(closed.select("source_date").distinct(), "source_date", "left_anti").agg(F.min("source_date").alias("first"), F.count("*").alias("n_gaps"))
    through = F.when(F.col("first").isNull(), last).otherwise(F.date_sub(F.col("first").cast("date"), 1))
    return missing.select(F.when(through >= F.lit(start).cast("date"), through.cast("string")).alias("closed_complete_through"), "n_gaps")


def pending_gaps(spark: SparkSession, closed: DataFrame, start: str, today: str) -> DataFrame:
    """Days before today that are not reached by the frontier, whether queried or not."""
    days = calendar(spark, start, today).filter(F.col("source_date") < today)
    missing = days.join(closed.select("source_date").distinct(), "source_date", "left_anti").agg(F.min("source_date").alias("first"))
    return days.join(F.broadcast(missing), F.col("source_date") >= F.col("first")).select("source_date")


def chain_breaks(manifests: DataFrame, genesis: str) -> DataFrame:
    """``rule, key``: partitions whose base is not the result before them, and dates that repeat."""
    w = Window.orderBy("source_date")  # one row a day
    before = F.coalesce(F.lag("projection_result_hash").over(w), F.lit(genesis))
    breaks = manifests.withColumn("before", before).filter("projection_base_hash <> before").select(F.lit("projection_base_differs").alias("rule"), F.col("source_date").alias("key"))
    twice = manifests.groupBy("source_date").count().filter("count > 1").select(F.lit("date_repeats").alias("rule"), F.col("source_date").alias("key"))
    return breaks.unionByName(twice)


def capacity_status(total_bytes: int, config: ProducerConfig) -> str:
    if total_bytes >= config.stop_bytes:
        raise ValueError("snapshot reaches the hard size limit")
    return "warning" if total_bytes >= config.warning_bytes else "ok"


def check_changed(dates: list[str], config: ProducerConfig, kind: str = "ordinary") -> None:
    if kind == "ordinary" and len(dates) > config.max_changed_partitions:
        raise ValueError("ordinary run changes too many partitions")


def retry_delay(attempt: int, retry_after: str | None = None, jitter: float = 0.0) -> float:
    """Seconds to wait after a failed attempt: the server's digits, else a power of two, plus jitter up to a quarter."""
    base = float(retry_after) if retry_after and retry_after.isdigit() else float(2 ** (attempt - 1))
    return base + min(max(jitter, 0.0), 1.0, base / 4)
