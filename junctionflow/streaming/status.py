"""Run status: the latest state of each run, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATES = ["started", "completed", "terminated", "failed"]


def latest_status(events: DataFrame) -> DataFrame:
    """run_id, state, ts: the newest of each run; the later state in STATES on a tie, then the larger seq."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("state"))
    order = Window.partitionBy("run_id").orderBy(F.desc("ts"), F.desc(rank), F.desc("seq"))
    return events.withColumn("_k", F.row_number().over(order)).filter("_k = 1").select("run_id", "state", "ts")


def latest_status_stream(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """The same from a stream: one aggregate row per run in update mode; events later than ``lateness`` are dropped."""
    distinct = events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["run_id", "state", "seq"])
    rank = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("state"))
    return distinct.groupBy("run_id").agg(F.max(F.struct("ts", rank.alias("rank"), "seq", "state")).alias("last")).select("run_id", "last.state", "last.ts")


def run_durations(events: DataFrame) -> DataFrame:
    """run_id, started, ended, duration_sec, exit_code (0 completed, 1 otherwise, null while it runs)."""
    at = lambda *states: F.when(F.col("state").isin(*states), F.col("ts"))
    runs = events.groupBy("run_id").agg(F.min(at("started")).alias("started"), F.max(at("completed", "terminated", "failed")).alias("ended"), F.max(F.when(F.col("state") == "completed", 0).when(F.col("state").isin("terminated", "failed"), 1)).alias("exit_code"))
    return runs.withColumn("duration_sec", F.unix_timestamp("ended") - F.unix_timestamp("started"))
