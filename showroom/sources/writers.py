"""Writers and converters between Parquet and delimited text."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showroom.sources.readers import infer_separator, read_header, read_rows

CODECS = ("snappy", "gzip", "zstd", "lz4")
DELIMITERS = {"comma": ",", "tab": "\t", "semicolon": ";", "pipe": "|"}
CONVERTIBLE = (".csv", ".tsv", ".txt")


def write_parquet(df: DataFrame, path: str, codec: str = "zstd", by: list[str] | None = None) -> None:
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}")
    writer = df.write.mode("overwrite").option("compression", codec)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_delimited(
    df: DataFrame, path: str, delimiter: str = "comma", columns: list[str] | None = None, header: bool = True
) -> None:
    """Column subset as text, quoting and escaping with ``"``."""
    df = df.select(*columns) if columns else df
    df.write.mode("overwrite").csv(
        path, sep=DELIMITERS.get(delimiter, delimiter), header=header, quote='"', escape='"', emptyValue="")


def parquet_to_delimited(spark: SparkSession, source: str, target: str, **options) -> None:
    write_delimited(spark.read.parquet(source), target, **options)


def text_to_parquet(
    spark: SparkSession, source: str, target: str, codec: str = "zstd", separator: str | None = None,
    columns: list[str] | None = None, header: bool = True,
) -> dict:
    """Convert one file or folder of text; bad lines are dropped. Returns row and column counts."""
    separator = separator or infer_separator(spark, source)
    if header:
        df = read_header(spark, source, separator, skip_bad=True)
    else:
        if not columns:
            raise ValueError("text without a header needs column names")
        df = read_rows(spark, source, columns, separator, False)
    write_parquet(df, target, codec)
    return {"rows": spark.read.parquet(target).count(), "columns": len(df.columns)}


def convertible_files(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = CONVERTIBLE) -> list[str]:
    """Files of a folder that can be converted. Only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    paths = files.select("path").where(F.lower("path").rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"))
    return sorted(r["path"] for r in paths.collect())


def convert_folder(spark: SparkSession, folder: str, target: str, codec: str = "zstd", at_once: int = 8) -> dict[str, dict]:
    """Every convertible file below a folder, each to its own Parquet table ``<path below the folder>.parquet``.

    The file's suffix stays in the name, so no two files share a table. ``at_once`` files are converted at a time.
    """
    paths = convertible_files(spark, folder)
    root = folder.rstrip("/").split(":", 1)[-1].lstrip("/")
    below = lambda path: path.split(root + "/", 1)[1]
    convert = lambda path: text_to_parquet(spark, path, f"{target}/{below(path)}.parquet", codec)
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(paths, pool.map(convert, paths), strict=True))
