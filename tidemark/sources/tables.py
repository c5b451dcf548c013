"""Snapshot and latest-state tables: merge rules, generations, corrections, report sinks.

A table of snapshots is a Parquet folder partitioned by date that is only appended to. A report is a
folder of complete generations; a reader takes those that carry the writer's success marker, so a lost
executor or driver never leaves a half-written one in view. Latest states are in ``buckets``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import local_day
from tidemark.operators.picks import first_by, last_wins


def read_or_default(spark: SparkSession, table: str, default: DataFrame) -> DataFrame:
    """The table, or the default when it is missing or empty."""
    if not spark.catalog.tableExists(table):
        return default
    found = spark.table(table)
    return default if found.isEmpty() else found


def read_wide(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    """Wide history table as typed rows; the schema is given, never inferred."""
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


# --- merge rules ---------------------------------------------------------------------------

def absent_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], ordinal: str, date: str | None = None) -> DataFrame:
    """Source rows to insert: first per key, and only keys the target lacks.

    ``date`` names a key column the target is partitioned by; only the source's date range of the
    target is then read.
    """
    fresh = first_by(source, keys, ordinal).drop(ordinal)
    known = target.select(*keys)
    if date is not None:
        low = source.agg(F.min(date).alias("a")).select("a").scalar()
        high = source.agg(F.max(date).alias("b")).select("b").scalar()
        known = known.where(F.col(date).between(low, high))
    return fresh.join(known, list(keys), "left_anti")


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Target after an insert that skips known keys; within the source the first row wins."""
    return target.unionByName(absent_rows(target, source, keys, ordinal), allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Target after an upsert: columns the source has are replaced, the others keep their value.

    Among source rows of one key the last one wins. The batch is the small side of every join, so while
    Spark can broadcast it the target is only scanned, not shuffled.
    """
    incoming = last_wins(source, keys, ordinal).drop(ordinal)
    new = [c for c in incoming.columns if c not in keys]
    carried = [c for c in target.columns if c not in keys and c not in new]
    touched = incoming.select(*keys)
    untouched = target.join(touched, list(keys), "left_anti")
    if carried:
        kept = target.select(*keys, *carried).join(touched, list(keys), "left_semi")
        incoming = incoming.join(kept, list(keys), "left")
    order = [*keys, *[c for c in target.columns if c not in keys], *[c for c in new if c not in target.columns]]
    return untouched.unionByName(incoming, allowMissingColumns=True).select(*order)


def upsert_collisions(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys for which one upsert batch carries several rows."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def update_changed(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Target with the listed columns corrected from the source; ``was_changed`` marks touched rows."""
    fixes = source.select(*keys, F.struct(*columns).alias("__fix"))
    joined = target.join(fixes, list(keys), "left")
    differs = reduce(
        lambda acc, c: acc | ~F.col(c).eqNullSafe(F.col("__fix")[c]), columns, F.lit(False)
    )
    hit = F.col("__fix").isNotNull() & differs
    return joined.select(
        *[F.when(hit, F.col("__fix")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
          for c in target.columns],
        hit.alias("was_changed"),
    )


def derive_snapshot_date(df: DataFrame, stamp: str, date: str = "snapshot_date") -> DataFrame:
    """Fill the date column with the local day of the capture where it is empty."""
    day = local_day(df, stamp)
    return df.withColumn(date, F.coalesce(F.col(date), day) if date in df.columns else day)


def backfill_violations(df: DataFrame, stamp: str, keys: Sequence[str], date: str = "snapshot_date") -> DataFrame:
    """What forbids (date, keys) as a unique key once dates are derived: rows without a date, and keys held by several rows.

    As in a unique index, a key with a NULL part repeats no other.
    """
    derived = derive_snapshot_date(df, stamp, date)
    whole = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.col(date).isNotNull())
    held = derived.select(date, *keys).groupBy(date, *keys).agg(F.count(F.lit(1)).alias("rows"))
    fault = F.when(F.col(date).isNull(), "no date").when(whole & (F.col("rows") > 1), "repeated key")
    return held.withColumn("fault", fault).where("fault is not null")


# --- writers -------------------------------------------------------------------------------

def _require(source: DataFrame, *columns: str) -> None:
    lacking = [c for c in columns if c not in source.columns]
    if lacking:
        raise ValueError(f"source lacks {lacking}")


def append_absent(source: DataFrame, path: str, keys: Sequence[str], ordinal: str, date: str) -> int:
    """Insert into a date-partitioned Parquet table and return the rows really inserted.

    Running it again inserts nothing.
    """
    _require(source, *keys, ordinal, date)
    spark = source.sparkSession
    try:
        target = spark.read.parquet(path)
    except Exception as missing:  # first load: there is no table yet
        if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER_SCHEMA" not in str(missing):
            raise
        rows = first_by(source, keys, ordinal).drop(ordinal)
    else:
        rows = absent_rows(target, source, keys, ordinal, date)
    seen = Observation()
    # One task per date would make a huge day a single file; AQE splits it when rebalancing. The count comes last: AQE
    # drops what lies below a shuffle that turns out empty, a count included.
    counted = rows.hint("rebalance", date).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").partitionBy(date).parquet(path)
    return seen.get["rows"]


def latest_generation(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """Number and rows of the newest complete generation, (0, None) when there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [0]
    if fs.exists(folder):
        for entry in fs.listStatus(folder):
            name = entry.getPath().getName()
            if name.startswith("generation=") and fs.exists(hadoop.Path(entry.getPath(), "_SUCCESS")):
                done.append(int(name.split("=")[1]))
    newest = max(done)
    return newest, spark.read.parquet(f"{path}/generation={newest}") if newest else None


def save_generation(df: DataFrame, path: str, number: int) -> None:
    """Write one complete generation; writing the same number again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/generation={number}")


def backfill_report(spark: SparkSession, path: str, stamp: str, keys: Sequence[str], date: str = "snapshot_date") -> int:
    """Backfill the dates of a report table as a new generation; nothing is written if (date, keys) would not be unique."""
    number, rows = latest_generation(spark, path)
    if rows is None:
        raise ValueError(f"no complete generation in {path}")
    found = backfill_violations(rows, stamp, keys, date).groupBy("fault").agg(F.sum("rows").alias("rows")).collect()
    if found:
        raise ValueError("; ".join(sorted(f"{r.fault}: {r.rows} rows" for r in found)))
    save_generation(derive_snapshot_date(rows, stamp, date), path, number + 1)
    return number + 1


def try_write(write: Callable[[], int]) -> tuple[int | None, str | None]:
    """(rows, None) on success, (None, message) on failure; never raises."""
    try:
        return write(), None
    except Exception as problem:
        return None, str(problem)


def run_status(spark: SparkSession, outcomes: dict[str, tuple[int | None, str | None]]) -> DataFrame:
    """Outcome of each table's write as rows."""
    rows = [(name, "failed" if error else "written", count, error) for name, (count, error) in outcomes.items()]
    return spark.createDataFrame(rows, "table string, status string, rows bigint, error string")


def append_report(df: DataFrame, path: str) -> None:
    """Append to a report table, columns aligned by name; creates it when missing."""
    spark = df.sparkSession
    number, _ = latest_generation(spark, path)
    save_generation(df, path, number + 1)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """All appended parts of a report; columns missing in older parts are NULL."""
    return spark.read.option("mergeSchema", True).parquet(path).drop("generation")


def overwrite_report(df: DataFrame, path: str) -> None:
    """Replace a whole report."""
    df.write.mode("overwrite").parquet(path)
