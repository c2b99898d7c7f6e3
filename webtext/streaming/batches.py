"""Tables that grow by one folder per micro-batch.

A micro-batch that is run again after a failure overwrites its own folder and
reads only the folders before it, so the result is the same as if it had run
once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader

from webtext.sources.readers import exists, is_folder


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(",")]


def read_before(spark: SparkSession, root: str, schema: str, batch_id: int) -> DataFrame:
    """Rows of the batches before ``batch_id``."""
    if not exists(spark, root):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, batch_id bigint").parquet(root)
    return rows.where(rows.batch_id < batch_id).select(*_columns(schema))


def read_batch(spark: SparkSession, root: str, schema: str, batch_id: int) -> DataFrame:
    """Rows of one batch; none when it was never written."""
    path = f"{root}/batch_id={batch_id}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_all(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Rows of all batches."""
    return spark.read.schema(schema).parquet(root).select(*_columns(schema))


def stream_table(
    spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of the parquet files that appear in ``folder``."""
    reader: DataStreamReader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def stream_of_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """Stream of a table that is one file or a folder of files, as batch readers take either."""
    if is_folder(spark, path):
        return spark.readStream.schema(schema).parquet(path)
    folder, name = path.rstrip("/").rsplit("/", 1)
    return stream_table(spark, folder, schema, name)
