"""Table scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Batch scan of a path; the filter and the column list reach the file reader."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_in_sql(spark: SparkSession, path: str, body: str = "SELECT * FROM {source}", fmt: str = "parquet") -> DataFrame:
    """SQL over a path-qualified table; ``{source}`` stands for it."""
    return spark.sql(body.replace("{source}", f"{fmt}.`{path}`"))


def first_available(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Scan of the first path that exists; any other problem with a path is an error."""
    missing = []
    for path in paths:
        try:
            return spark.read.format(fmt).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
    raise FileNotFoundError(f"none of these can be read: {missing}")


def flatten(
    df: DataFrame, payload: str, schema: str, mapping: Mapping[str, str], defaults: Mapping[str, object] = {},
    keep: Sequence[str] = (),
) -> DataFrame:
    """JSON text to columns: ``mapping`` is output name to field path; a missing key is NULL.

    A schema that is an array gives one row per element.
    """
    parsed = F.from_json(F.col(payload), schema)
    is_array = schema.strip().lower().startswith("array")
    rows = df.select(*keep, (F.explode(parsed) if is_array else parsed).alias("_item"))
    out = []
    for name, path in mapping.items():
        field = F.col(f"_item.{path}")
        if name in defaults:
            field = F.coalesce(field, F.lit(defaults[name]))
        out.append(field.alias(name))
    return rows.select(*keep, *out)


def run_history(spark: SparkSession, path: str) -> DataFrame:
    """Run-log table, newest first."""
    return scan(spark, path).orderBy(F.desc("start_time"), "run_id")
