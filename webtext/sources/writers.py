"""Writers: manifests, documents, metadata, derived texts and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.functions import identity as I
from webtext.operators.ordering import sorted_urls
from webtext.sources.readers import exists
from webtext.sources.shared import absent_from, materialize

SINGLE_OBJECT_URLS = 1_000_000
METADATA = "id string, title string, url string, created_at timestamp"


def write_manifest(urls: DataFrame, path: str, stamp: Column, as_single_object: bool = False) -> str:
    """Overwrite a URL manifest; returns ``path``.

    Rows form (default): sorted ``pos, url`` JSON lines under ``urls`` and one
    ``count, last_updated`` object under ``summary``. ``as_single_object``
    writes one JSON object with everything; its size is checked, because one
    task has to hold it.
    """
    ordered = sorted_urls(urls)
    total = ordered.agg(F.count("*").alias("count"))
    summary = total.withColumn("last_updated", I.text_stamp(stamp))
    if not as_single_object:
        ordered.select("pos", "url").write.mode("overwrite").json(f"{path}/urls")
        summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
        return path
    if total.first()["count"] > SINGLE_OBJECT_URLS:
        raise ValueError(f"more than {SINGLE_OBJECT_URLS} URLs: write the manifest as rows")
    entries = F.array_sort(F.collect_list("url"))
    one = ordered.agg(
        entries.alias("urls"),
        F.count("*").alias("count"),
    ).withColumn("last_updated", I.text_stamp(stamp))
    one.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_failed(failed: DataFrame, path: str, stamp: Column) -> str | None:
    """Failed URLs as a manifest that can be read back; nothing when none failed."""
    return None if failed.isEmpty() else write_manifest(failed, path, stamp)


def write_documents(docs: DataFrame, path: str) -> str:
    """Documents as parquet keyed by ``document_id``."""
    docs.write.mode("overwrite").parquet(path)
    return path


def write_derived(docs: DataFrame, path: str) -> str:
    """Derived texts as parquet rows ``name, text``."""
    docs.select("name", "text").write.mode("overwrite").parquet(path)
    return path


def _new_metadata(metadata: DataFrame, present: DataFrame | None) -> DataFrame:
    """Earliest row per id, without ids already present."""
    rows = metadata.groupBy("id").agg(F.min(F.struct("created_at", "title", "url")).alias("m"))
    rows = rows.select("id", "m.title", "m.url", "m.created_at")
    if present is None:
        return rows
    return absent_from(materialize(rows, "metadata-batch"), present, "id")


def metadata_problems(metadata: DataFrame) -> DataFrame:
    """Rows that break the table's rules: a NULL column, or a repeated id."""
    empty = metadata.where(
        F.col("id").isNull() | F.col("title").isNull() | F.col("url").isNull() | F.col("created_at").isNull()
    ).select("id", F.lit("null column").alias("problem"))
    repeated = metadata.groupBy("id").count().where("count > 1").select(
        "id", F.lit("repeated id").alias("problem")
    )
    return empty.unionByName(repeated)


def append_metadata(metadata: DataFrame, path: str) -> str:
    """Append page metadata once per id; running it again adds nothing.

    The table is partitioned by day and range-partitioned before the write, so
    a day holds few files, a large day is shared by many tasks, and time-range
    reads skip the other days.
    """
    spark = metadata.sparkSession
    present = spark.read.parquet(path) if exists(spark, path) else None
    fresh = _new_metadata(metadata, present).withColumn("created_date", F.to_date("created_at"))
    (
        fresh.repartitionByRange("created_date", "id")
        .write.mode("append")
        .partitionBy("created_date")
        .parquet(path)
    )
    return path


def append_metadata_jdbc(
    metadata: DataFrame, url: str, table: str, properties: dict[str, str], batch_rows: int = 10_000
) -> None:
    """The same append to a database table, in batches of ``batch_rows``."""
    spark = metadata.sparkSession
    present = spark.read.jdbc(url, f"(select id from {table}) t", properties=properties)
    fresh = _new_metadata(metadata, present)
    fresh.write.option("batchsize", batch_rows).jdbc(url, table, mode="append", properties=properties)


def write_report(report: DataFrame, path: str) -> str:
    """A one-row report as one JSON object."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path
