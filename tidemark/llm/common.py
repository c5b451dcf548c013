"""What the operators of this subpackage share: the scratch folder, stored intermediates, Arrow maps."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PIECE_BYTES = 2_000_000


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again: cuts lineage, survives lost executors."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text each, or one row; null texts become empty."""
    for batch in batches:
        place = batch.schema.get_field_index(column)
        batch = batch.set_column(place, column, pc.fill_null(batch.column(place), ""))
        ends = pc.cumulative_sum(pc.binary_length(batch.column(place)).cast(pa.int64())).to_numpy()
        start, rows = 0, batch.num_rows
        while start < rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(ends.searchsorted(before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def reach_workers(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it, besides what ``--py-files`` ships."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])


def give_back() -> None:
    """Returns freed memory to the system: Spark keeps Python workers for later tasks, several for each core."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, body: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` of a generator of column dicts; the schema gives the Arrow types."""
    shape = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for columns in body(batches):
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in target], schema=target
                )
        finally:
            columns = None
            give_back()

    reach_workers(df.sparkSession)
    return df.mapInArrow(run, shape)
