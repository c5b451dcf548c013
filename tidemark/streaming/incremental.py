"""Incremental snapshot delta: each arriving snapshot against the last states of its keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.deltas import snapshot_delta
from tidemark.operators.picks import last_wins
from tidemark.sources.buckets import BUCKETS, newest_versions, read_buckets, touched_buckets, write_buckets


def delta_against_state(
    batch: DataFrame, state: DataFrame | None, keys: Sequence[str], date: str, measure: str, order: str, on_absent: str,
    captured: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(delta rows of the batch, state after it).

    The batch may hold several days and several rows of a key and day, of which the one with the greatest ``order``
    counts. The state has the last two days of each key, so a later row of a key's last day still corrects that day: its
    delta is given again. ``remember`` compares a key that a day lacks with its last value on its return; ``forget`` makes
    it new unless the captured day just before has it. ``captured`` has the days captured before the batch.
    """
    if on_absent not in ("remember", "forget"):
        raise ValueError(f"unknown on_absent {on_absent!r}")
    columns = [*keys, date, order, measure]
    rows = batch.select(*columns, F.lit(True).alias("__new"))
    if state is not None:
        rows = rows.unionByName(state.select(*columns, F.lit(False).alias("__new")))
    history = last_wins(rows, [*keys, date], order)
    days = None
    if on_absent == "forget":
        days = batch.select(date)
        days = (days if captured is None else days.unionByName(captured.select(date))).distinct()
    linked = snapshot_delta(history, keys, date, measure, max_gap_days=None, mode="diff", adjacent=days is not None, captured=days)
    latest = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    after = history.withColumn("__age", F.row_number().over(latest)).where("__age <= 2").select(*columns)
    return linked.where("__new").drop("__new", order), after


def read_deltas(spark: SparkSession, output_path: str, keys: Sequence[str], date: str) -> DataFrame:
    """One delta per key and day: what a later batch corrected replaces what an earlier one gave."""
    return last_wins(spark.read.option("basePath", output_path).parquet(f"{output_path}/batch=*"), [*keys, date], "batch").drop("batch")


def incremental_delta(
    stream: DataFrame, keys: Sequence[str], date: str, measure: str, order: str, state_path: str, output_path: str,
    on_absent: str = "remember", buckets: int = BUCKETS,
) -> DataStreamWriter:
    """Streaming writer of the deltas; snapshots must arrive in date order.

    The state lies in buckets of the keys' hash, and a batch reads and writes only those that hold its keys. Batch n writes
    version n of them and reads versions below n, so a batch that is run again after a failure at any point meets the
    state it met before and replaces its own output: every delta is there exactly once. A new checkpoint needs a new state.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0 and max(newest_versions(spark, state_path).values(), default=0) > 0:
            raise RuntimeError(f"{state_path} holds the state of another checkpoint")
        rows = batch.persist()
        try:
            touched = touched_buckets(rows, keys, buckets)
            state = read_buckets(spark, state_path, touched, below=batch_id) if touched else None
            captured = None
            if batch_id:
                captured = spark.read.option("basePath", f"{state_path}/days").parquet(f"{state_path}/days/batch=*").where(F.col("batch") < batch_id)
            deltas, after = delta_against_state(rows, state, keys, date, measure, order, on_absent, captured)
            deltas.write.mode("overwrite").parquet(f"{output_path}/batch={batch_id}")
            rows.select(date).distinct().write.mode("overwrite").parquet(f"{state_path}/days/batch={batch_id}")
            write_buckets(after, state_path, keys, buckets, batch_id)
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(step).outputMode("update")
