"""Session facts every operator needs: tables, shared storage, partition counts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir``; a temporary one is set only where none is, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        context = spark.sparkContext
        if context._jsc.sc().getCheckpointDir().isDefined():
            return context._jsc.sc().getCheckpointDir().get()
        path = "file://" + tempfile.mkdtemp(prefix="quernstone-")
        context.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read and no recomputation, and
    several consumers read the same files with their own column pruning.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Keys with several rows, and bytes of them, up to which they are sent to every task.
FEW_KEYS, FEW_BYTES = 200_000, 16 << 20


def least_row(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key: the least by its other columns in their order, so the choice doesn't depend on the partitioning."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_least")).select(*(F.col(c) if c in keys else F.col("_least")[c].alias(c) for c in df.columns))


def one_row_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key, the least of several, without shuffling the rows whose key occurs once.

    A first pass reads the key columns alone.  If no key repeats the rows stay where they are;
    if at most ``FEW_KEYS`` do, of ``FEW_BYTES`` in all, only their rows are gathered; beyond that all are.
    """
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys)
    width = F.length(F.concat_ws("", *(F.col(k).cast("string") for k in keys)))
    facts = repeated.limit(FEW_KEYS + 1).agg(F.count("*").alias("n"), F.sum(width + 16).alias("size")).first()
    if facts.n == 0:
        return df
    if facts.n > FEW_KEYS or (facts.size or 0) > FEW_BYTES:
        return least_row(df, keys)
    few = F.broadcast(repeated.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))))
    same = [df[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(few, same, "left_anti").unionByName(least_row(df.join(few, same, "left_semi"), keys))


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once a context, so that they need no path to it.

    The archive lies in the shared folder where that is a mounted one; otherwise Spark itself
    carries it from the driver to the executors.
    """
    context = spark.sparkContext
    if getattr(context, "_quernstone_shipped", False):
        return
    shared = shared_dir(spark)
    folder = shared.removeprefix("file://").removeprefix("file:") if shared.startswith(("file:", "/")) else tempfile.mkdtemp(prefix="quernstone-")
    os.makedirs(folder, exist_ok=True)
    archive = os.path.join(folder, f"quernstone-{uuid.uuid4().hex}.zip")
    package = Path(__file__).resolve().parent
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, str(path.relative_to(package.parent)))
    context.addPyFile(archive)
    context._quernstone_shipped = True
