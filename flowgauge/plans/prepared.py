"""Tables and models that many queries share, written once per application to the shared folder.

The study itself hands over between its stages through stored tables; here they are Parquet, so
a lost executor costs a re-read instead of the whole lineage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from datetime import date
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowgauge.operators import cleaning, features, models
from flowgauge.session import work_path
from flowgauge.sources import tables
from flowgauge.sources.views import observations

SPLIT = "2024-01-24"
MONTH_COLUMNS = ("year", "month_part")

_done: set[str] = set()
_schemas: dict[str, StructType] = {}
_models: dict[str, PipelineModel] = {}


def place(spark: SparkSession, sf_dir: str, name: str) -> str:
    return work_path(spark, hashlib.sha256(sf_dir.encode()).hexdigest()[:12], name)


def once(path: str, build: Callable[[str], None]) -> str:
    if path not in _done:
        build(path)
        _done.add(path)
    return path


def dated(spark: SparkSession, path: str) -> DataFrame:
    """A table written by this application, with its partition columns; its schema is read from the files only once."""
    if path not in _schemas:
        _schemas[path] = tables.read_by_month(spark, path).schema
    return tables.read_by_month(spark, path, _schemas[path])


def stored(spark: SparkSession, path: str) -> DataFrame:
    return dated(spark, path).drop(*MONTH_COLUMNS)


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = observations(spark, sf_dir)
    path = once(
        place(spark, sf_dir, "clean"), lambda p: tables.write_by_month(cleaning.clean(raw), p)
    )
    return stored(spark, path).select(*raw.columns)


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = once(
        place(spark, sf_dir, "features"),
        lambda p: tables.write_by_month(features.feature_table(clean_rows(spark, sf_dir)), p),
    )
    return stored(spark, path)


def split_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train, test); each opens only the months on its side of the split."""
    feature_rows(spark, sf_dir)
    rows = features.high_risk_label(dated(spark, place(spark, sf_dir, "features")))
    month, day = F.col("year") * 12 + F.col("month_part"), date.fromisoformat(SPLIT)
    at = day.year * 12 + day.month
    train, test = models.time_split(rows.where(month <= at), SPLIT)[0], models.time_split(rows.where(month >= at), SPLIT)[1]
    return train.drop(*MONTH_COLUMNS), test.drop(*MONTH_COLUMNS)


FITS = {
    "linear": models.fit_linear,
    "forest_regressor": models.fit_forest_regressor,
    "logistic": models.fit_logistic,
    "forest_classifier": models.fit_forest_classifier,
    "balanced_classifier": models.fit_balanced_classifier,
}


def model(spark: SparkSession, sf_dir: str, name: str) -> PipelineModel:
    """Fitted on the training rows at first use, then loaded from the store, once an application."""
    path = once(
        place(spark, sf_dir, f"models/{name}"),
        lambda p: tables.save_model(FITS[name](split_rows(spark, sf_dir)[0]), p),
    )
    if path not in _models:
        _models[path] = tables.load_model(path)
    return _models[path]


def fitted(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> list[PipelineModel]:
    """Several models. Those of small tables are fitted side by side: a fit leaves cores idle between its passes."""
    n = split_rows(spark, sf_dir)[0].count()
    with ThreadPool(len(names) if n <= models.SMALL_FIT else 1) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda name: model(spark, sf_dir, name)), names)
