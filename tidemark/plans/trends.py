"""Search-interest series: stitched, monthly, kept as latest state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.reshape import melt
from tidemark.operators.series import stitch, to_month
from tidemark.sources.tables import upsert


def monthly_trend(
    chunks: DataFrame, series: Sequence[str], chunk: str, date: str, value: str,
    fill: str = "missing", average: str = "after", dense: bool = False,
) -> DataFrame:
    """Monthly series from chunks; the months are averaged ``before`` or ``after`` stitching."""
    if average == "before":
        monthly = to_month(chunks, date, value, [*series, chunk], dense=False)
        stitched = stitch(monthly, series, chunk, "month", value, fill).drop(chunk)
        return stitched
    return to_month(stitch(chunks, series, chunk, date, value, fill), date, value, series, dense)


def trend_rows(wide: DataFrame, pipeline: str, sheet: str = "default", fetched_at=None) -> DataFrame:
    """Wide monthly table to rows of (pipeline, sheet, series, month, value, fetched_at)."""
    stamp = F.current_timestamp() if fetched_at is None else F.lit(fetched_at).cast("timestamp")
    long = melt(wide, ["month"])
    return long.select(
        F.lit(pipeline).alias("pipeline"), F.lit(sheet).alias("sheet"), "series", "month",
        F.col("value").cast("double").alias("value"), stamp.alias("fetched_at"),
    )


def upsert_trend(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Latest state per (pipeline, sheet, series, month)."""
    ordered = rows.withColumn("ordinal", F.unix_micros("fetched_at"))
    return upsert(target, ordered, ["pipeline", "sheet", "series", "month"], "ordinal")
