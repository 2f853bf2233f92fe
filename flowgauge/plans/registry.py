"""Registration of queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable output: 64-bit numbers, rounded doubles without a negative zero, text timestamps."""
    columns = []
    for name, kind in df.dtypes:
        c = f"`{name}`"
        if kind in ("tinyint", "smallint", "int"):
            c = f"CAST({c} AS BIGINT)"
        elif kind in ("double", "float") or kind.startswith("decimal"):
            c = f"round(CAST({c} AS DOUBLE), {digits}) + 0.0D"
        elif kind in ("timestamp", "timestamp_ntz"):
            c = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
        elif kind == "date":
            c = f"date_format({c}, 'yyyy-MM-dd')"
        columns.append(f"{c} AS `{name}`")
    return df.selectExpr(*columns)


def query(name: str, sql: str | None = None, doubles: Sequence[str] = (), digits: int = 6):
    """Register a builder; ``doubles`` are rounded in the SQL as ``tidy`` rounds them in Spark."""
    def register(build: Build) -> Build:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return tidy(build(spark, sf_dir), digits)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _rounded(sql, doubles, digits)
        return build

    return register


def _rounded(sql: str, doubles: Sequence[str], digits: int) -> str:
    sql = sql.strip()
    if not doubles:
        return sql
    replaced = ", ".join(f"ROUND(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({replaced}) FROM (\n{sql}\n) AS result"
