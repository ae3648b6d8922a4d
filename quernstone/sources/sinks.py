"""Sinks: envelopes, upserts, logs, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.operators.dedupe import upsert


def write_envelope(rows: DataFrame, path: str) -> None:
    """Rows as Parquet under ``rows``, and one JSON line of totals under ``summary``."""
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    rows.sparkSession.read.parquet(f"{path}/rows").agg(F.count("*").alias("n_rows")).withColumn("columns", F.array(*map(F.lit, rows.columns))).coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def write_upsert(base_path: str, new: DataFrame, keys: list[str], version: str) -> str:
    """The table at ``base_path`` with ``new`` put in, written beside it as ``version``; readers switch when it is whole."""
    target = f"{base_path.rstrip('/')}-{version}"
    upsert(new.sparkSession.read.parquet(base_path), new, keys).write.mode("errorifexists").parquet(target)
    return target


def insert_batches(rows: DataFrame, url: str, name: str, size: int = 100, driver: str | None = None) -> None:
    """Add the rows to a table of a database, ``size`` to a statement, every partition on its own connection."""
    writer = rows.write.mode("append").option("batchsize", size)
    (writer.option("driver", driver) if driver else writer).jdbc(url, name)


def append_log(rows: DataFrame, path: str) -> None:
    rows.withColumn("logged_at", F.current_timestamp()).write.mode("append").json(path)


def write_partitions(rows: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions that ``rows`` has."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
