"""Timeline of batch runs: events from a log, and their trace form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.functions.durations import (
    add_seconds,
    clock_seconds,
    duration_text,
    log_timestamp,
    microseconds_between,
)
from ledgerleaf.operators.filters import differs_or_missing
from ledgerleaf.operators.mapping import exists_flag, literal_map
from ledgerleaf.operators.running import largest, repeat_rows, running_total_before
from ledgerleaf.scratch import settle
from ledgerleaf.sources.csv import write_csv
from ledgerleaf.sources.json_array import read_json_array, write_json_array

# Event numbers of the log.
START_CODE = 8169
FINISH_CODE = 7473

# Names of the step actions. 3 runs another batch and is no step.
ACTIONS = {
    0: "Initialize",
    1: "Load",
    2: "Map",
    3: "Run batch",
    4: "Run query",
    5: "Export seriatim",
    6: "Update assumptions",
    9: "Build risk classes",
    10: "Remove cells",
}
RUN_BATCH = 3

UNKNOWN = "Unknown"
SHORTEST_STEP = 2

EVENT_COLUMNS = [
    "batch_id",
    "step_ref",
    "event_id",
    "event_name",
    "event_start",
    "event_finish",
    "duration",
    "duration_in_seconds",
]


def clean_log(log: DataFrame) -> DataFrame:
    """Start and finish lines with time stamps; texts are parsed, time stamps are kept."""
    log = log.where(F.col("No").isin(START_CODE, FINISH_CODE))
    if dict(log.dtypes)["Timestamp"] == "string":
        log = log.withColumn("Timestamp", log_timestamp(F.col("Timestamp")))
    return log


def step_seconds(time: Column) -> Column:
    """Length of a step; missing or below two seconds counts as none."""
    seconds = F.coalesce(clock_seconds(time), F.lit(0))
    return F.when(seconds < SHORTEST_STEP, F.lit(0)).otherwise(seconds)


def started_batches(batch: DataFrame, log: DataFrame) -> DataFrame:
    """Id and name of the batches that have a start line in the log."""
    starts = log.where(F.col("No") == START_CODE).select(F.col("BatchId").alias("Id"))
    return batch.select("Id", "Name").join(starts.distinct(), "Id", "left_semi")


def batch_starts(batch: DataFrame, log: DataFrame) -> DataFrame:
    """One row per start line of a batch: id, name, start time."""
    starts = log.where(F.col("No") == START_CODE).select(
        F.col("BatchId").alias("Id"), F.col("Timestamp").alias("start_time")
    )
    return started_batches(batch, log).join(starts, "Id", "left")


def batch_spans(log: DataFrame) -> DataFrame:
    """Per started batch: first start and finish in log order, and number of starts."""
    is_start = F.col("No") == START_CODE
    is_finish = F.col("No") == FINISH_CODE
    return (
        log.groupBy(F.col("BatchId").alias("Id"))
        .agg(
            F.min_by("Timestamp", F.when(is_start, F.col("Id"))).alias("batch_start"),
            F.min_by("Timestamp", F.when(is_finish, F.col("Id"))).alias("batch_finish"),
            F.count(F.when(is_start, 1)).alias("n_starts"),
        )
        .where("n_starts > 0")
    )


def flag_macros(batches: DataFrame, steps: DataFrame) -> DataFrame:
    """Add ``is_macro``: the batch has steps of its own."""
    return exists_flag(batches, "Id", steps, "Id", "is_macro")


def batch_steps(steps: DataFrame, batches: DataFrame) -> DataFrame:
    """Steps of the given batches with their names and lengths; runs of other batches are left out."""
    action = literal_map(F.col("Act").cast("int"), ACTIONS)
    argument = F.coalesce(F.col("ArgumentNameTmp"), F.lit(""))
    return (
        steps.where(differs_or_missing(F.col("Act"), RUN_BATCH))
        .join(batches.select("Id").distinct(), "Id", "left_semi")
        .select(
            "Id",
            "Reference",
            F.concat(action, F.lit(": "), argument).alias("step_name"),
            step_seconds(F.col("Time")).alias("step_seconds"),
        )
    )


def step_offsets(steps: DataFrame) -> DataFrame:
    """Add ``offset_seconds``: length of all earlier steps of the same batch."""
    return running_total_before(
        steps, ["Id"], "Reference", F.col("step_seconds"), "offset_seconds"
    )


def _batch_events(started: DataFrame) -> DataFrame:
    repeated = repeat_rows(started, "n_starts", "_copy", largest(started, "n_starts"))
    return repeated.select(
        F.col("Id").alias("batch_id"),
        F.lit(None).cast("int").alias("step_ref"),
        F.col("Id").cast("double").alias("event_id"),
        F.col("Name").alias("event_name"),
        F.col("batch_start").alias("event_start"),
        F.col("batch_finish").alias("event_finish"),
    )


def _step_events(steps: DataFrame, started: DataFrame) -> DataFrame:
    spans = started.select("Id", "batch_start", "batch_finish").distinct()
    finish = F.col("batch_finish")
    latest_start = add_seconds(finish, F.lit(-1))
    placed = (
        step_offsets(batch_steps(steps, started))
        .join(spans, "Id")
        .withColumn(
            "event_start",
            F.least(add_seconds(F.col("batch_start"), F.col("offset_seconds")), latest_start),
        )
    )
    end = F.least(add_seconds(F.col("event_start"), F.col("step_seconds")), finish)
    return placed.select(
        F.col("Id").alias("batch_id"),
        F.col("Reference").cast("int").alias("step_ref"),
        (F.col("Id") + F.col("Reference") / F.lit(100.0)).alias("event_id"),
        F.col("step_name").alias("event_name"),
        "event_start",
        F.when(finish.isNotNull(), end).alias("event_finish"),
    )


def batch_events(log: DataFrame, batch: DataFrame, steps: DataFrame) -> DataFrame:
    """One event per batch start and per step, in no order.

    Steps follow each other from the start of their batch and end with it. A
    batch without a finish line keeps a null finish. ``event_id`` is the batch
    id plus a hundredth of the step number, ``batch_id`` and ``step_ref`` tell
    apart what it cannot.
    """
    spans = batch_spans(clean_log(log))
    started = settle(batch.select("Id", "Name").join(spans, "Id"), "started")
    events = _batch_events(started).unionByName(_step_events(steps, started))
    seconds = microseconds_between(F.col("event_start"), F.col("event_finish")) / 1_000_000
    return (
        events.withColumn("event_name", F.coalesce("event_name", F.lit(UNKNOWN)))
        .withColumn("duration", F.col("event_finish") - F.col("event_start"))
        .withColumn("duration_in_seconds", seconds)
        .select(*EVENT_COLUMNS)
    )


def batch_profile(log: DataFrame, batch: DataFrame, steps: DataFrame) -> DataFrame:
    """:func:`batch_events` by start time."""
    events = batch_events(log, batch, steps)
    return events.orderBy("event_start", "event_id", "step_ref", "event_name")


def to_trace(events: DataFrame, pid: int = 0, tid: int = 0) -> DataFrame:
    """Trace rows: microseconds since the earliest start, at least one long.

    ``events`` is read twice, so pass stored events.
    """
    origin = events.select(F.min("event_start")).scalar()
    length = microseconds_between(F.col("event_start"), F.col("event_finish"))
    return events.select(
        F.lit(pid).alias("pid"),
        F.lit(tid).alias("tid"),
        F.lit("X").alias("ph"),
        F.col("event_name").alias("name"),
        microseconds_between(origin, F.col("event_start")).alias("ts"),
        F.when(length == 0, F.lit(1)).otherwise(length).alias("dur"),
    )


def write_events(events: DataFrame, path: str) -> None:
    """Events as CSV; durations read ``d days HH:mm:ss``."""
    text = duration_text(F.col("duration_in_seconds"))
    write_csv(events.withColumn("duration", text), path)


def write_trace(trace: DataFrame, path: str) -> None:
    """Trace rows as JSON lines, earliest first."""
    trace.orderBy("ts", "name").write.mode("overwrite").json(path)


def write_trace_array(trace: DataFrame, path: str) -> None:
    """Trace rows as one file with one JSON array, earliest first, as trace viewers read it."""
    write_json_array(trace, path, ["ts", "name"])


def read_trace_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Trace rows of a file of :func:`write_trace_array`, in no order."""
    return read_json_array(spark, path, schema)
