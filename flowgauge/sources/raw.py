"""Reading raw observations by column name, with a quarantine for values that do not parse."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.constants import RAW_TYPES


LINE = "line"


def check_columns(columns: Iterable[str]) -> None:
    present = set(columns)
    missing = [name for name in RAW_TYPES if name not in present]
    if missing:
        raise ValueError(f"input is missing expected columns: {missing}")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column as text. Files whose headers differ raise an error.

    ``line`` is the whole text of a line that has too many or too few cells, and null otherwise.
    Without an ``ordinal`` column one is made: by file name, block of the file and row in the block. Spark packs files
    into tasks by size, so the order of its tasks is not the order of the input.
    """
    names = spark.read.option("header", True).csv(path).columns
    check_columns(names)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, LINE]])
    reader = spark.read.option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", LINE)
    df = reader.schema(schema).csv(path)
    if "ordinal" in names:
        return df
    plain = r"^([A-Za-z0-9]+:)/+"  # one form of a path, whatever number of slashes it came with
    files = spark.createDataFrame(list(enumerate(sorted(df.inputFiles()))), "_file_no long, _file string")
    files = files.withColumn("_file", F.regexp_replace("_file", plain, "$1/"))
    # a task's row numbers stay below its bytes, so neighbouring blocks of a file do not overlap
    place = F.col("_block") + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = df.select("*", F.regexp_replace("_metadata.file_path", plain, "$1/").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    rows = rows.withColumn("_place", place).join(files, "_file", "left")
    return rows.withColumn("ordinal", (F.shiftleft("_file_no", 42) + F.col("_place")).cast("string")).select(*df.columns, "ordinal")


def _parsed(name: str) -> Column:
    return F.col(name).try_cast(RAW_TYPES[name])


def _unparsable(name: str) -> Column:
    return F.col(name).isNotNull() & _parsed(name).isNull()


def typed(text: DataFrame) -> DataFrame:
    """Typed columns plus ``series_id``, ``ordinal`` (input order), ``rejected`` (names of cells that don't parse; ``line`` for a line with
    another number of cells) and, for such rows, ``cells``: the text of every cell."""
    series = F.col("series_id").try_cast("bigint") if "series_id" in text.columns else F.lit(0).cast("bigint")
    order = F.col("ordinal").try_cast("bigint") if "ordinal" in text.columns else F.monotonically_increasing_id()
    torn = [F.when(F.col(LINE).isNotNull(), F.lit(LINE))] if LINE in text.columns else []
    bad = F.array_compact(F.array(*torn, *[F.when(_unparsable(n), F.lit(n)) for n in RAW_TYPES]))
    cells = F.create_map(*[x for n in text.columns for x in (F.lit(n), F.col(n))])
    return text.select(
        series.alias("series_id"),
        order.alias("ordinal"),
        *[_parsed(n).alias(n) for n in RAW_TYPES],
        bad.alias("rejected"),
        F.when(F.size(bad) > 0, cells).alias("cells"),
    )


def scan_raw(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows)."""
    rows = typed(read_text(spark, path))
    return rows.where(F.size("rejected") == 0).drop("rejected", "cells"), rows.where(F.size("rejected") > 0)


def split_scan(spark: SparkSession, path: str, out: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(accepted rows, refused rows, counts), both sides written to ``out`` by one scan of the files.

    The counts (read, accepted, refused, and refused cells by column) come with the write, without another pass.
    """
    rows = typed(read_text(spark, path)).withColumn("refused", F.size("rejected") > 0)
    seen = Observation()
    count = [F.count(F.lit(1)).alias("read"), F.count_if(~F.col("refused")).alias("accepted"), F.count_if("refused").alias("refused")]
    by_column = [F.count_if(F.array_contains("rejected", n)).alias(n) for n in (LINE, *RAW_TYPES)]
    schema = rows.drop("refused").schema
    rows.observe(seen, *count, *by_column).write.mode("overwrite").partitionBy("refused").parquet(out)
    sides = [spark.read.schema(schema.add("refused", "boolean")).parquet(out).where(F.col("refused") == side).drop("refused") for side in (False, True)]
    return sides[0].drop("rejected", "cells"), sides[1], dict(seen.get)


def schema_report(text: DataFrame) -> DataFrame:
    """Per expected column: filled, empty and unparsable values, in one pass."""
    aggs = []
    for name in RAW_TYPES:
        aggs += [
            F.count_if(_parsed(name).isNotNull()).alias(f"{name}|parsed"),
            F.count_if(F.col(name).isNull()).alias(f"{name}|empty"),
            F.count_if(_unparsable(name)).alias(f"{name}|rejected"),
        ]
    one = text.agg(*aggs)
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            *[F.col(f"`{name}|{kind}`").alias(kind) for kind in ("parsed", "empty", "rejected")],
        )
        for name in RAW_TYPES
    ])
    return one.select(F.inline(rows))
