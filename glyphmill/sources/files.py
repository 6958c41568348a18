"""Files of encoded text as rows, and rows as files with just their bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import decode_text, guess_detail, transcode


def read_files(spark: SparkSession, *paths: str) -> DataFrame:
    """(arg, path, content): the files of each argument, in the arguments' order."""
    out = None
    for k, path in enumerate(paths):
        part = spark.read.format("binaryFile").load(path).select(F.lit(k).alias("arg"), "path", "content")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "arg int, path string, content binary")


def convert_files(spark: SparkSession, paths: Sequence[str], *options: str) -> DataFrame:
    """(arg, path, content) converted; without options the content passes unchanged."""
    files = read_files(spark, *paths)
    return files.withColumn("content", transcode("content", *options)) if options else files


def guess_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(arg, path, encoding, eol)"""
    return read_files(spark, *paths).select("arg", "path", guess_detail("content").alias("g")).select("arg", "path", "g.encoding", "g.eol")


#: Where lines end: after \n, or after each of the separators that str.splitlines knows.
NEWLINE, SEPARATORS = r"(?<=\n)", r"(?<=\n)|(?<=\r)(?!\n)|(?<=[\x0b\x0c\x1c\x1d\x1e\u0085\u2028\u2029])"


def read_lines(spark: SparkSession, paths: Sequence[str], *options: str, all_separators: bool = False) -> DataFrame:
    """(path, number, line): decoded files by line, at \\n, or at all that str.splitlines knows. Lines keep their ends."""
    text = read_files(spark, *paths).select("path", decode_text("content", *options).alias("text"))
    lines = F.filter(F.split("text", SEPARATORS if all_separators else NEWLINE), lambda x: x != "")
    return text.select("path", F.posexplode(lines).alias("number", "line"))


def read_pieces(spark: SparkSession, paths: Sequence[str], size: int, *options: str) -> DataFrame:
    """(path, number, piece): decoded files in pieces of ``size`` characters, the last one shorter."""
    if size < 1:
        raise ValueError("size must be positive")
    text = read_files(spark, *paths).select("path", decode_text("content", *options).alias("text")).where("text <> ''")
    pieces = text.withColumn("number", F.explode(F.expr(f"sequence(0, (char_length(text) - 1) div {size})")))
    return pieces.select("path", "number", F.expr(f"substring(text, cast(number * {size} + 1 as int), {size})").alias("piece"))


def write_files(df: DataFrame, folder: str, name: str = "name", content: str = "content") -> None:
    """Writes each row's bytes to ``folder``/name by the cluster's file system, each task its own rows."""
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() != "file":
        raise ValueError("write_files needs a mounted folder; elsewhere write a table")
    root = target.toUri().getPath()

    def save(rows) -> None:
        from pathlib import Path

        Path(root).mkdir(parents=True, exist_ok=True)
        for r in rows:
            (Path(root) / str(r[0])).write_bytes(bytes(r[1] or b""))

    df.select(name, content).foreachPartition(save)
