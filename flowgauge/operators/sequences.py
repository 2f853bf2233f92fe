"""Look-back windows, previous values and every-nth rows of long series.

A window over a whole series would put a series that holds a third of all rows into one task.
Series are therefore cut into time chunks. What a chunk needs from earlier ones (its last n rows,
or a row count) is a small table, and only that table is windowed over the whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.constants import EVERY_NTH, LOOKBACK_ROWS

CHUNK_DAYS = 30
PART = ["series_id", "_chunk"]


def _chunked(df: DataFrame, days: int) -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.unix_timestamp("date_time") / F.lit(days * 86400)))


def _in_chunk() -> Window:
    return Window.partitionBy(*PART).orderBy("date_time")


def _earlier_chunks(first: int) -> Window:
    return Window.partitionBy("series_id").orderBy("_chunk").rowsBetween(first, -1)


def row_positions(df: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Add ``position``: the 0-based row number inside the series, in time order."""
    rows = _chunked(df, chunk_days)
    sizes = rows.groupBy(*PART).agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select(
        *PART, F.coalesce(F.sum("_size").over(_earlier_chunks(Window.unboundedPreceding)), F.lit(0)).alias("_before")
    )
    position = F.col("_before") + F.row_number().over(_in_chunk()) - 1
    return rows.join(before, PART).withColumn("position", position).select(*df.columns, "position")


def _last_rows(rows: DataFrame, payload: Column, n: int) -> DataFrame:
    """The last n rows of each chunk as one array in time order; n is a fixed, small number."""
    newest = Window.partitionBy(*PART).orderBy(F.desc("date_time"))
    return (
        rows.select(*PART, "date_time", payload.alias("_row"))
        .withColumn("_n", F.row_number().over(newest))
        .where(F.col("_n") <= n)
        .groupBy(*PART)
        .agg(F.sort_array(F.collect_list(F.struct("date_time", "_row"))).alias("_tail"))
        .withColumn("_tail", F.transform("_tail", lambda r: r["_row"]))
    )


def _last_n(array: Column, n: int) -> Column:
    return F.slice(array, F.greatest(F.size(array) - n + 1, F.lit(1)), n)


def lookback_windows(
    df: DataFrame, channels: Sequence[str], n: int = LOOKBACK_ROWS, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Add ``window``: the previous n rows as arrays of channel values; rows with fewer are dropped.

    Look-back is by row, not by clock: gaps are not filled.
    """
    rows = _chunked(df, chunk_days)
    payload = F.array(*[F.col(c).cast("double") for c in channels])
    tails = _last_rows(rows, payload, n)
    # every non-empty chunk gives at least one row, so n earlier chunks always suffice
    halo = tails.select(
        *PART, _last_n(F.flatten(F.collect_list("_tail").over(_earlier_chunks(-n))), n).alias("_halo")
    )
    own = F.collect_list(payload).over(_in_chunk().rowsBetween(-n, -1))
    return (
        rows.withColumn("_own", own)
        .join(halo, PART)
        .withColumn("window", _last_n(F.concat("_halo", "_own"), n))
        .where(F.size("window") == n)
        .select(*df.columns, "window")
    )


def previous_value(df: DataFrame, column: str, alias: str = "previous", chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """The value of the preceding row of the series, NULL on its first row."""
    rows = _chunked(df, chunk_days)
    last = rows.groupBy(*PART).agg(F.max_by(column, "date_time").alias("_last"))
    carried = last.select(
        *PART, F.lag("_last").over(Window.partitionBy("series_id").orderBy("_chunk")).alias("_carried")
    )
    opens = F.row_number().over(_in_chunk()) == 1
    return (
        rows.withColumns({"_lag": F.lag(column).over(_in_chunk()), "_opens": opens})
        .join(carried, PART)
        .withColumn(alias, F.when(F.col("_opens"), F.col("_carried")).otherwise(F.col("_lag")))
        .select(*df.columns, alias)
    )


def every_nth(
    df: DataFrame, split: str, n: int = EVERY_NTH, lookback: int = LOOKBACK_ROWS, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Every n-th training row among those that have a full look-back."""
    numbered = row_positions(df.where(F.col("date_time") < F.lit(split).cast("timestamp")), chunk_days)
    return numbered.where((F.col("position") >= lookback) & ((F.col("position") - lookback) % n == 0))
