"""Readers: page snapshots, URL manifests and folders of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "urls array<string>, count bigint, last_updated string"
MANIFEST_ROW = "pos bigint, url string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, html`` of a page snapshot table."""
    return spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark can reach."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path that is there is a folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop_path).isDirectory()


def manifest_worklist(spark: SparkSession, path: str) -> DataFrame:
    """``pos, url`` in manifest order, repeats kept.

    Reads both forms ``write_manifest`` writes: a folder of rows, or one JSON
    object with a ``urls`` array. A missing file, or an object without the
    array, gives no rows.
    """
    if exists(spark, f"{path}/urls"):
        return spark.read.schema(MANIFEST_ROW).json(f"{path}/urls")
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST_ROW)
    objects = spark.read.schema(MANIFEST).json(path, multiLine=True)
    return objects.select(F.posexplode("urls").alias("pos", "url")).select(
        F.col("pos").cast("bigint"), "url"
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``url`` of a manifest; empty when there is none."""
    return manifest_worklist(spark, path).select("url").where(F.col("url").isNotNull()).distinct()


def read_corpus(
    spark: SparkSession, path: str, pattern: str = "*.md", recursive: bool = False
) -> DataFrame:
    """``document_id, path, text``: one row per whole text file in ``path``.

    The id is the file name without its last suffix.
    """
    # Spark gives names as parts of a URI: percent escapes, but a plus sign as it is.
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))
    files = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=recursive)
    return files.select(
        F.regexp_replace(name, r"\.[^.]*\z", "").alias("document_id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("text"),
    )
