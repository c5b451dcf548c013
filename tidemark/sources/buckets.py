"""Latest states in Parquet folders by buckets of a key's hash, so that a change rewrites only the buckets it touches.

The layout is Spark's own partitioning: ``buckets=<count>/bucket=<b>/version=<n>``. A change writes a new version of the
buckets that hold its keys, by dynamic partition overwrite, and leaves all others alone; a reader takes each bucket's newest
version up to the last one that was finished. A version that was only half written is written again under its number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.picks import last_wins
from tidemark.sources.tables import upsert

BUCKETS = 64


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers after ``prefix`` among the names in a folder; none when there is no folder."""
    fs, place = _hadoop(spark, path)
    if not fs.exists(place(path)):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(place(path))]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """The number of buckets a table was made with."""
    found = _names(spark, path, "buckets=")
    return found[0] if found else None


def touched_buckets(rows: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """Buckets that hold keys of ``rows``; at most ``buckets`` numbers."""
    return sorted(r[0] for r in rows.select(bucket_of(keys, buckets)).distinct().collect())


def newest_versions(spark: SparkSession, path: str, below: int | None = None) -> dict[int, int]:
    """Each bucket's newest version under ``below``."""
    count, found = bucket_count(spark, path), {}
    for bucket in _names(spark, f"{path}/buckets={count}", "bucket=") if count else []:
        versions = [v for v in _names(spark, f"{path}/buckets={count}/bucket={bucket}", "version=") if below is None or v < below]
        if versions:
            found[bucket] = versions[-1]
    return found


def read_buckets(spark: SparkSession, path: str, wanted: Sequence[int] | None = None, below: int | None = None) -> DataFrame | None:
    """Rows of the wanted buckets (all by default) in their newest version; None where there is nothing."""
    count = bucket_count(spark, path)
    newest = newest_versions(spark, path, below)
    places = [f"{path}/buckets={count}/bucket={b}/version={v}" for b, v in newest.items() if wanted is None or b in wanted]
    if not places:
        return None
    return spark.read.option("mergeSchema", True).option("basePath", path).parquet(*places).drop("buckets", "bucket", "version")


def write_buckets(rows: DataFrame, path: str, keys: Sequence[str], buckets: int, version: int) -> None:
    """The rows as a new version of their buckets; the same version written again replaces itself."""
    placed = rows.withColumns({"buckets": F.lit(buckets), "bucket": bucket_of(keys, buckets), "version": F.lit(version)})
    writer = placed.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("buckets", "bucket", "version").parquet(path)


def drop_old_versions(spark: SparkSession, path: str, below: int) -> int:
    """Delete versions that readers of ``below`` and later no longer look at; returns how many."""
    fs, place = _hadoop(spark, path)
    count, gone = bucket_count(spark, path), 0
    for bucket, newest in newest_versions(spark, path, below).items():
        folder = f"{path}/buckets={count}/bucket={bucket}"
        for version in _names(spark, folder, "version="):
            if version < newest:
                gone += fs.delete(place(f"{folder}/version={version}"), True)
    return gone


# --- upserts -------------------------------------------------------------------------------

def _mark(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False when it is there already."""
    fs, place = _hadoop(spark, path)
    try:
        fs.create(place(path), False).close()
    except Exception as problem:
        if "FileAlreadyExists" in str(problem) or "already exists" in str(problem):
            return False
        raise
    return True


def last_commit(spark: SparkSession, path: str) -> int:
    return max(_names(spark, f"{path}/_commits", "commit-"), default=0)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table after its last finished upsert; None before the first."""
    return read_buckets(spark, path, below=last_commit(spark, path) + 1)


def release(spark: SparkSession, path: str) -> bool:
    """Give up the claim of a writer that died; False when there was none."""
    fs, place = _hadoop(spark, path)
    claim = place(f"{path}/_commits/claim-{last_commit(spark, path) + 1}")
    return bool(fs.exists(claim) and fs.delete(claim, False))


def upsert_table(source: DataFrame, path: str, keys: Sequence[str], ordinal: str, buckets: int = BUCKETS) -> int:
    """Upsert into a table of buckets and return the rows inserted or updated.

    Only buckets with keys of the source are read and written; the count is observed while they are written. Every upsert
    claims the next commit first, so a second writer at the same time gets an error and changes nothing. Rows without a
    whole key are refused, since a key identifies a row. ``buckets`` counts only when the table is made.
    """
    lacking = [c for c in (*keys, ordinal) if c not in source.columns]
    if lacking:
        raise ValueError(f"source lacks {lacking}")
    spark = source.sparkSession
    version = last_commit(spark, path) + 1
    if not _mark(spark, f"{path}/_commits/claim-{version}"):
        raise RuntimeError(f"another writer is at commit {version} of {path}; release() after it has died")
    try:
        count = _upsert_version(source, path, keys, ordinal, buckets, version)
    except BaseException:
        release(spark, path)
        raise
    _mark(spark, f"{path}/_commits/commit-{version}")
    return count


def _upsert_version(source: DataFrame, path: str, keys: Sequence[str], ordinal: str, buckets: int, version: int) -> int:
    spark = source.sparkSession
    buckets = bucket_count(spark, path) or buckets
    batch = last_wins(source, keys, ordinal).persist()
    try:
        if batch.where(" or ".join(f"`{k}` is null" for k in keys)).limit(1).count():
            raise ValueError(f"a row of the source has no whole key {list(keys)}")
        touched = touched_buckets(batch, keys, buckets)
        if not touched:
            return 0
        known = read_buckets(spark, path, touched, below=version)
        fresh = batch.withColumn("__fresh", F.lit(True))
        merged = fresh.drop(ordinal) if known is None else upsert(known.withColumn("__fresh", F.lit(False)), fresh, keys, ordinal)
        seen = Observation()
        counted = merged.observe(seen, F.count_if("__fresh").alias("rows"))
        write_buckets(counted.drop("__fresh"), path, keys, buckets, version)
        return seen.get["rows"]
    finally:
        batch.unpersist()
