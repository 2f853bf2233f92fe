"""Processed tables, result tables and stored models."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_by_month(df: DataFrame, path: str) -> None:
    """Replace a table laid out by year and month.

    REBALANCE lets adaptive execution split a month that holds most rows and merge small ones,
    so neither one huge task nor many small files result.
    """
    dated = df.withColumns({"year": F.year("date_time"), "month_part": F.month("date_time")})
    (
        dated.hint("rebalance", "year", "month_part")
        .write.mode("overwrite")
        .partitionBy("year", "month_part")
        .parquet(path)
    )


def read_by_month(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read such a table; Spark raises when it does not exist."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def replace_table(df: DataFrame, name: str, path: str) -> int:
    """Fill a new version of a named relation, then point the name at it; returns the rows written without a second pass.

    Every version has a folder of its own below ``path``, and the name is a view on the last complete one. Moving it is one step of the
    catalog: a load that fails half-way leaves the rows of before, readers never see an empty or half relation, and those that
    have begun go on with the version they opened. Schemas may differ from version to version.
    """
    spark = df.sparkSession
    version, written = f"{path}/version={uuid.uuid4().hex}", Observation()
    df.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{version}`")
    return written.get["n"]


RESULT_COLUMNS = ["analysis", "metric", "group", "value"]


def long_results(df: DataFrame, analysis: str, metrics: Sequence[str], group: Column | None = None) -> DataFrame:
    """One row per (group, metric) of a small result, ready for the results table."""
    group = F.lit("all") if group is None else group.cast("string")
    pairs = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])
    return df.select(F.lit(analysis).alias("analysis"), group.alias("group"), F.inline(pairs)).select(*RESULT_COLUMNS)


def append_results(results: DataFrame, path: str, run: str | None = None) -> None:
    """Add results to the table of all runs. A run that is written again replaces its own results of the same analyses, nothing else."""
    keyed = results.withColumns({"run_ts": F.current_timestamp(), "run": F.lit(run or uuid.uuid4().hex)})
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "analysis").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Feature order is part of the stored assembler stage, so it need not be realigned."""
    return PipelineModel.load(path)
