"""JSON files whose records change: rescued fields, quarantined lines, schemas that widen between runs.

A line is read as text and parsed twice: into the known schema, and into a map
of whatever it holds. A line that is no JSON object goes to the quarantine with
its file. A field that the schema does not know, or whose value does not fit
its type, is kept in ``_rescued`` as JSON text beside the fields that do fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carriageway.session import shared_dir
from carriageway.streaming.jobs import BATCH, limited, run_batches, written

RESCUED = "_rescued"
ORIGIN = "_source_file"
QUARANTINE = T.StructType([T.StructField("value", T.StringType()), T.StructField(ORIGIN, T.StringType())])


def text_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the files of a folder as a stream, with their file."""
    reader = limited(spark.readStream.format("text"), files_per_batch)
    return reader.load(path).select("value", F.col("_metadata.file_path").alias(ORIGIN))


def fields_of(line: str = "value") -> Column:
    """All fields of a JSON object as text; null for anything else."""
    return F.when(F.trim(F.col(line)).startswith("{"), F.from_json(line, "map<string,string>"))


def parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines with their fields in the known schema; ``_rescued`` holds the others. Lines that are no object are left out."""
    rows = lines.where(F.trim("value") != "").withColumns({"_fields": fields_of(), "_typed": F.from_json("value", schema)}).where(F.col("_fields").isNotNull())

    def lost(name: Column, value: Column) -> Column:
        known = F.lit(False)
        for f in schema.fields:
            known = known | ((name == f.name) & F.col("_typed")[f.name].isNotNull())
        return value.isNotNull() & ~known

    left = F.map_filter("_fields", lost)
    return rows.select(*[F.col("_typed")[f.name].alias(f.name) for f in schema.fields],
                       F.when(F.size(left) > 0, F.to_json(left)).alias(RESCUED), ORIGIN)


def broken(lines: DataFrame) -> DataFrame:
    """Lines that are no JSON object."""
    return lines.where((F.trim("value") != "") & fields_of().isNull()).select("value", ORIGIN)


def ingest(lines: DataFrame, schema: T.StructType, base: str | None = None) -> tuple[DataFrame, DataFrame, str]:
    """Run the lines there are now into a table and a quarantine under ``base``.

    Returns both and ``base``, which is given to go on with a later run; a wider
    ``schema`` may be given then, and earlier rows have nulls in the new columns.
    """
    spark = lines.sparkSession
    base = base or shared_dir(spark, "evolving")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            parsed(batch, schema).write.mode("overwrite").parquet(f"{base}/out/{BATCH}={epoch}")
            broken(batch).write.mode("overwrite").parquet(f"{base}/quarantine/{BATCH}={epoch}")
        finally:
            batch.unpersist()

    run_batches(lines, write, f"{base}/checkpoint")
    full = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType()), T.StructField(ORIGIN, T.StringType())])
    return written(spark, f"{base}/out", full).drop(BATCH), written(spark, f"{base}/quarantine", QUARANTINE).drop(BATCH), base


def widened(schema: T.StructType, table: DataFrame) -> T.StructType:
    """The schema with a text column for each rescued field that it does not know; the driver sees field names only."""
    names = table.select(F.explode(F.map_keys(F.from_json(RESCUED, "map<string,string>"))).alias("name")).distinct()
    new = sorted(r["name"] for r in names.collect() if r["name"] not in schema.fieldNames())
    return T.StructType([*schema.fields, *[T.StructField(n, T.StringType()) for n in new]])
