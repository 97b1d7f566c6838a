"""Writing tables and exports. Every writer runs on the executors."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carriageway.functions.cells import cell_boundary
from carriageway.functions.geometry import extent, geojson_geometry, parse_wkt, polygon_wkt
from carriageway.functions.text import has_text
from carriageway.operators.ordered import value_slice
from carriageway.operators.settle import settled


def overwrite(df: DataFrame, path: str, parts: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace a table, schema included.

    Rows are brought together by partition column first, so a partition is not
    scattered over one small file per task; a large one is split again by size
    at run time, so a hot partition never ends in a single task.
    """
    writer = (df.hint("rebalance", *parts) if parts else df).write.format(fmt).mode("overwrite")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def save_table(df: DataFrame, name: str, parts: Sequence[str] = (), fmt: str = "parquet", gather: bool = True, codec: str | None = None) -> None:
    """Save as a catalog table, replacing it; rows come together by partition as in ``overwrite``.

    Without ``gather`` each task writes its own rows, one file per partition it
    holds: for rows that already lie together, or large scans with few partitions.
    """
    writer = (df.hint("rebalance", *parts) if parts and gather else df).write.format(fmt).mode("overwrite")
    if codec:
        writer = writer.option("compression", codec)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.saveAsTable(name)


def register_files(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Existing files as an external table; nothing is copied."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")


def quoted(text: str) -> str:
    """A text as an SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def describe(spark: SparkSession, name: str, comment: str, columns: Mapping[str, str] = {}) -> None:
    """Store a table comment and column comments."""
    spark.sql(f"COMMENT ON TABLE {name} IS {quoted(comment)}")
    for column, text in columns.items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN {column} COMMENT {quoted(text)}")


def analyze(spark: SparkSession, name: str) -> None:
    """Statistics of every column for the optimizer."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def column_statistics(spark: SparkSession, name: str) -> DataFrame:
    """What the catalog knows of each column of an analyzed table, as rows; numbers of a text's smallest and greatest value are null."""
    rows = []
    for column in spark.table(name).columns:  # one catalog look-up per column, no scan
        known = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {name} `{column}`").collect()}
        known = {k: None if v == "NULL" else v for k, v in known.items()}
        rows.append((column, *[None if known.get(k) is None else float(known[k]) for k in ("min", "max")],
                     *[None if known.get(k) is None else int(known[k]) for k in ("num_nulls", "distinct_count")]))
    return spark.createDataFrame(rows, "column_name string, least double, greatest double, n_null long, n_distinct long")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 5) -> Column:
    """Position of a row on a curve through all columns: each column's range number, their bits dealt in turn.

    Ranges hold like numbers of rows: their borders are approximate quantiles of
    numbers, dates or the first six bytes of texts. NULL counts as the lowest.
    """
    kinds = dict(df.dtypes)
    place = F.lit(0).cast("long")
    for k, c in enumerate(columns):
        text = F.conv(F.rpad(F.hex(F.substring(c, 1, 6)), 12, "0").substr(1, 12), 16, 10)
        value = text.cast("double") if kinds[c] == "string" else F.unix_micros(F.col(c).cast("timestamp")).cast("double") if kinds[c] in ("date", "timestamp") else F.col(c).cast("double")
        number = F.coalesce(value_slice(df.select(value.alias("_value")), "_value", 1 << bits, of=value).cast("long"), F.lit(0).cast("long"))
        for bit in range(bits):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(columns) + k))
    return place


def clustered_by_all(df: DataFrame, columns: Sequence[str], files: int, bits: int = 5) -> DataFrame:
    """Rows in files such that a filter on any of the columns skips files, not on the first only."""
    return df.withColumn("_place", interleaved(df, columns, bits)).repartitionByRange(files, "_place").sortWithinPartitions("_place").drop("_place")


def files_met(spark: SparkSession, path: str, column: str, low: object, high: object) -> DataFrame:
    """How many files of a table there are, and how many hold a value range that meets ``low`` to ``high``: those a filter must read."""
    ranges = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("least"), F.max(column).alias("greatest"))
    return ranges.agg(F.count(F.lit(1)).alias("files"), F.count_if((F.col("least") <= F.lit(high)) & (F.col("greatest") >= F.lit(low))).alias("met"))


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in range order of the columns, so file statistics can skip files.

    A linear order. Ranges are sampled, so a hot leading value is spread by the
    columns after it.
    """
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def rows_by_file(spark: SparkSession, path: str) -> DataFrame:
    """(file, n) per data file of a table; none if there is no table yet. The scan has no column, so it counts from footers."""
    try:
        held = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "file string, n long")
    return held.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))


def write_logged(
    df: DataFrame, path: str, operation: str, at: Column, write: Callable[[DataFrame, str], None]
) -> DataFrame:
    """Run a write and give its history row: what was done, how many rows this write had, when.

    The rows are those of files that were not there before; both lists of files
    are tables, joined on the executors.
    """
    spark = df.sparkSession
    before = settled(rows_by_file(spark, path).select("file"), "files-before")
    write(df, path)
    added = rows_by_file(spark, path).join(before, "file", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("rows_written"))
    return settled(added.select(
        F.lit(operation).alias("operation"), "rows_written",
        F.lit(",".join(df.columns)).alias("columns"), at.alias("logged_at"),
    ), "history-row")


def features(df: DataFrame, geometry: str) -> DataFrame:
    """GeoJSON features as one text column: one per row, empty geometry dropped.

    Every other column becomes a property.
    """
    kept = df.where(has_text(geometry))
    properties = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != geometry]))
    return kept.select(
        F.concat(
            F.lit('{"type":"Feature","geometry":'), geojson_geometry(geometry),
            F.lit(',"properties":'), properties, F.lit("}"),
        ).alias("value")
    )


def export_geojson(df: DataFrame, geometry: str, path: str) -> None:
    """Newline-delimited GeoJSON."""
    features(df, geometry).write.mode("overwrite").text(path)


def with_extent(df: DataFrame, geometry: str) -> DataFrame:
    """Bounding-box columns beside the WKT, for readers that skip by box."""
    return df.where(has_text(geometry)).withColumn("_box", extent(parse_wkt(geometry))).select("*", "_box.*").drop("_box")


def export_geoparquet(df: DataFrame, geometry: str, path: str) -> None:
    with_extent(df, geometry).write.mode("overwrite").parquet(path)


def cells_as_polygons(df: DataFrame, cell: str, out: str = "geometry_wkt") -> DataFrame:
    """Cell outline as WKT; rows whose cell is not a cell id are left out."""
    good = df.where(F.regexp_like(F.col(cell), F.lit(r"^\d+:-?\d+:-?\d+$")))
    return good.withColumn(out, polygon_wkt(cell_boundary(cell)))


def export_json(df: DataFrame, path: str) -> None:
    """One JSON record per line."""
    df.write.mode("overwrite").json(path)


def feed_bundle(lists: Mapping[str, DataFrame], stamp: Column) -> DataFrame:
    """Named lists and a time stamp as tagged JSON records.

    The bundle is a set of lines, each tagged with its list, instead of one
    document held in one task.
    """
    out = None
    for name, df in lists.items():
        lines = df.select(
            F.lit(name).alias("kind"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record")
        )
        out = lines if out is None else out.unionByName(lines)
    return out.withColumn("stamp", stamp)
