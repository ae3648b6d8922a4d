"""Content that was not seen before: in batch by anti-join, as a stream by state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quernstone.runtime import least_row


def new_content(rows: DataFrame, processed: DataFrame, text: str, force: bool = False) -> DataFrame:
    """One row for each content that ``processed`` (sha1) lacks; with ``force`` for every content."""
    hashed = rows.withColumn("sha1", F.sha1(F.coalesce(text, F.lit(""))))
    fresh = hashed if force else hashed.join(processed.select("sha1").distinct(), "sha1", "left_anti")
    return least_row(fresh, ["sha1"])


def rerun(existing: DataFrame, results: DataFrame, key: str, failed: str) -> DataFrame:
    """``existing`` after its failed rows were run again: a result takes the place of all rows of its key, failed or not; keys without a result stay."""
    again = existing.where(F.expr(failed)).select(key).distinct()
    new = results.join(again, key, "left_semi")
    return existing.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def gated(rows: DataFrame, failed: str, force: bool = False) -> DataFrame:
    """(status, n_ok, n_failed, written) of a run: one with failures writes nothing unless forced; one without any success has failed."""
    n = rows.agg(F.count_if(~F.coalesce(F.expr(failed), F.lit(False))).alias("n_ok"), F.count_if(F.coalesce(F.expr(failed), F.lit(False))).alias("n_failed"))
    status = F.when(F.col("n_failed") == 0, "completed").when(F.col("n_ok") == 0, "failed").otherwise("completed_with_errors")
    written = F.when((F.col("n_failed") == 0) | ((F.col("n_ok") > 0) & F.lit(force)), F.col("n_ok")).otherwise(F.lit(0))
    return n.select(status.alias("status"), "n_ok", "n_failed", written.alias("written"))


def applied(base: DataFrame, new: DataFrame, key: str, columns: list[str], apply: bool) -> DataFrame:
    """The rows that differ, each with what is done to it: with ``apply`` the change itself, else the plan of it, and nothing is altered."""
    both = new.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns)).join(base.select(key, *columns, F.lit(True).alias("_there")), key, "left")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    action = F.when(F.col("_there").isNull(), "insert").otherwise("update")
    return both.where(F.col("_there").isNull() | ~same).select(key, F.concat(F.lit("" if apply else "would "), action).alias("action"), *(F.col(f"_new_{c}").alias(c) for c in columns))


def stream_new_content(spark: SparkSession, folder: str, schema: str, text: str, sink: Callable[[DataFrame, int], None], checkpoint: str, within: tuple[str, str] | None = None) -> StreamingQuery:
    """The same over Parquet files that arrive in ``folder``: each content reaches ``sink`` once, across restarts.

    On a finite input the rows are those of ``new_content`` over all of it, up to which of
    several equal rows stands for them.

    Without ``within`` every hash ever seen is kept as state, 20 bytes and its overhead a content,
    spread over the shuffle partitions.  With ``within`` (a column of times and a delay such as
    ``30 days``) a repetition is recognised that long after the first, and older state is dropped.
    """
    rows = spark.readStream.schema(schema).parquet(folder).withColumn("sha1", F.sha1(F.coalesce(text, F.lit(""))))
    once = rows.dropDuplicates(["sha1"]) if within is None else rows.withWatermark(*within).dropDuplicatesWithinWatermark(["sha1"])
    return once.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
