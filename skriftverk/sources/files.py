"""JSON lines, path lists, manifests of finished files, and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

GOLD = "id string, url string, html string, text string"
DOCUMENT = "id string, text string, metadata struct<url string, document_class string, lang string>"


def read_jsonl(spark: SparkSession, path: str, schema: str = DOCUMENT, glob: str = "*.jsonl*") -> tuple[DataFrame, DataFrame]:
    """(rows with line, file and modified, malformed lines). gz files are read as such; malformed lines are kept apart, not lost; ``line`` is
    the row as it stands in the file."""
    raw = spark.read.option("pathGlobFilter", glob).text(path).filter("trim(value) <> ''")
    raw = raw.select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("modified"))
    parsed = raw.withColumn("_r", F.from_json("value", schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    names = [f.name for f in parsed.schema["_r"].dataType.fields if f.name != "_corrupt"]
    good = parsed.filter("_r._corrupt is null").select(*(F.col(f"_r.`{n}`").alias(n) for n in names), F.col("value").alias("line"), "file", "modified")
    return good, parsed.filter("_r._corrupt is not null").select(F.col("value").alias("line"), "file")


def settled(df: DataFrame, seconds: int = 300, modified: str = "modified") -> DataFrame:
    """Rows of files that were last written ``seconds`` ago or earlier."""
    return df.filter(F.col(modified) < F.current_timestamp() - F.expr(f"interval {seconds} seconds"))


def path_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct shard paths of a list: stripped, blank and repeated lines out."""
    return lines.select(strip(F.col(column)).alias("path")).filter("path <> ''").distinct()


def unfinished(paths: DataFrame, manifest: DataFrame, column: str = "path") -> DataFrame:
    """Paths that the manifest of finished ones lacks."""
    return paths.join(manifest.select(column).distinct(), column, "left_anti")


def read_manifest(spark: SparkSession, path: str, column: str = "path") -> DataFrame:
    try:
        return spark.read.text(path).select(F.col("value").alias(column))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{column} string")  # no manifest yet


def mark_finished(paths: DataFrame, manifest: str, column: str = "path") -> None:
    paths.select(F.col(column).alias("value")).distinct().write.mode("append").text(manifest)


def write_jsonl(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "errorifexists") -> None:
    w = df.write.mode(mode).option("compression", "gzip")
    (w.partitionBy(*by) if by else w).json(path)


def write_lines(df: DataFrame, path: str, line: str = "line", file: str = "file") -> None:
    """Unchanged lines under the names of the files that they came from, gzipped."""
    df.select(file, line).write.partitionBy(file).option("compression", "gzip").text(path)


def every_nth(df: DataFrame, n: int = 500) -> DataFrame:
    """Every n-th row of each partition, to watch a long run by; no row is moved."""
    return df.filter(F.pmod(F.monotonically_increasing_id(), F.lit(n)) == n - 1)


def preview(df: DataFrame, id_col: str = "id", cls: str = "document_class", text: str = "text", chars: int = 500) -> DataFrame:
    return df.select(id_col, cls, F.substring(text, 1, chars).alias("preview"))


def removal_log(df: DataFrame, url: str = "url", text: str = "text", chars: int = 100) -> DataFrame:
    """Address and the beginning of the text of removed rows, on one line."""
    line = F.regexp_replace(F.substring(F.coalesce(text, F.lit("")), 1, chars), r"\n", " ")
    return df.select(F.coalesce(url, F.lit("")).alias("url"), line.alias("preview"))
