"""Sources: folders of files, JSON envelopes, JSON lines, tables of a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.functions.text import natural_key


def manifest(spark: SparkSession, root: str, extensions: tuple[str, ...] = ("pdf",)) -> DataFrame:
    """One row a file below ``root``: source (first folder), relative path, name, extension, size, time, and its place in natural order.

    Contents are not read: column pruning leaves the listing only.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")
    base = root.rstrip("/").removeprefix("file://").removeprefix("file:")
    relative = F.regexp_replace("path", "^.*?" + base.replace(".", r"\.") + "/", "")
    rows = files.select(relative.alias("relative_path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"))
    return described(rows, extensions)


def described(rows: DataFrame, extensions: tuple[str, ...]) -> DataFrame:
    """``rows`` (relative_path, ...) of the given extensions with file_name, extension, source (first folder) and ordinal, the place in the natural order of its source."""
    rows = rows.withColumn("file_name", F.element_at(F.split("relative_path", "/", -1), -1)).withColumn("extension", F.lower(F.regexp_extract("file_name", r"\.([^.]+)$", 1)))
    rows = rows.where(F.col("extension").isin(*extensions)).withColumn("source", F.element_at(F.split("relative_path", "/", -1), 1))
    return rows.withColumn("ordinal", F.row_number().over(Window.partitionBy("source").orderBy(natural_key(F.col("relative_path")), "relative_path")))


def of_folder(rows: DataFrame, folder: str) -> DataFrame:
    """The files right inside ``folder``, with k, their place by name whatever its letter case."""
    inside = rows.where(F.regexp_replace("relative_path", "/[^/]*$", "") == folder)
    return inside.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy(F.lower("file_name"), "file_name")))


def manifest_summary(files: DataFrame) -> DataFrame:
    """Files, folders and bytes of each source."""
    folder = F.regexp_replace("relative_path", "/[^/]*$", "")
    return files.groupBy("source").agg(F.count("*").alias("n_files"), F.countDistinct(folder).alias("n_folders"), F.sum("size_bytes").alias("n_bytes"))


def with_content_hash(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, sha1) of the files below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.sha1("content").alias("sha1"))


def json_rows(spark: SparkSession, path: str, element: str, keys: tuple[str, ...] = ("questions", "rows", "data")) -> DataFrame:
    """Rows of JSON files that hold a bare list or an envelope with the list under one of ``keys``; ``element`` is the DDL of a row."""
    whole = spark.read.text(path, wholetext=True)
    lists = [F.from_json("value", f"array<struct<{element}>>")]
    lists += [F.from_json(F.get_json_object("value", f"$.{key}"), f"array<struct<{element}>>") for key in keys]
    bare = F.when(F.trim("value").startswith("["), lists[0])
    return whole.select(F.explode(F.coalesce(bare, *lists[1:])).alias("row")).select("row.*")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a log of JSON lines; blank and malformed lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def settings(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of ``KEY=value`` lines; blank lines, comments and lines without a sign of equality are left out, quotes around a value go; the last line of a key holds."""
    lines = spark.read.text(path).select(F.trim("value").alias("line"), F.monotonically_increasing_id().alias("at")).where("line not like '#%' and instr(line, '=') > 1")
    cut = F.instr("line", "=")
    pairs = lines.select("at", F.trim(F.substr("line", F.lit(1), cut - 1)).alias("key"), F.regexp_replace(F.trim(F.substr("line", cut + 1)), "^[\"']|[\"']$", "").alias("value"))
    return pairs.groupBy("key").agg(F.max_by("value", "at").alias("value"))


def database_table(spark: SparkSession, url: str, name: str, key: str, low: int, high: int, parts: int) -> DataFrame:
    """A table of a database, read in ``parts`` ranges of a numeric key at once."""
    return spark.read.jdbc(url, name, column=key, lowerBound=low, upperBound=high, numPartitions=parts)


def latest(files: DataFrame, key: str) -> DataFrame:
    """The newest file of each key."""
    return files.groupBy(key).agg(F.max_by("relative_path", F.struct("modified_at", "relative_path")).alias("relative_path"))
