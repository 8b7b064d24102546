"""Readers: delimited and Parquet lead tables, the behaviour log, and the full adapt chain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showroom import vocab as v
from showroom.functions.followups import add_followup_features
from showroom.functions.labels import creation_time_features, target_labels
from showroom.operators.contract import apply_alias_contract, require_columns
from showroom.session import use_utc


CORRUPT = "__bad_line"


@dataclass(frozen=True)
class Format:
    kind: str  # "parquet", "header" or "headerless"
    separator: str | None = None


def first_line(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path).limit(1).first()
    return row["value"] if row else ""


def infer_separator(spark: SparkSession, path: str) -> str:
    """By suffix; else tab if the first line has one, else comma, else tab."""
    lower = path.lower().rstrip("/")
    if lower.endswith(".tsv"):
        return "\t"
    if lower.endswith(".csv"):
        return ","
    line = first_line(spark, path)
    return "," if "," in line and "\t" not in line else "\t"


def separator_by_count(line: str) -> str:
    """The variant that compares how often tab and comma occur."""
    return "\t" if line.count("\t") > line.count(",") else ","


def detect_format(spark: SparkSession, path: str) -> Format:
    """Parquet by name; a tabbed first line with the lead mark is the headerless export; anything
    else is comma separated with a header."""
    if path.lower().rstrip("/").endswith(".parquet"):
        return Format("parquet")
    line = first_line(spark, path)
    if "\t" in line and line.startswith(v.LEAD_EXPORT_MARK):
        return Format("headerless", "\t")
    return Format("header", ",")


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_rows(spark: SparkSession, path: str, names: list[str], separator: str, header: bool) -> DataFrame:
    """Text columns under given names. A line with fewer fields is filled up with NULL, a line
    with more is dropped.

    Every line is parsed whole, whatever columns a query reads; otherwise the same line could be
    bad for one query and good for the next.
    """
    schema = _texts([*names, CORRUPT])
    raw = spark.read.schema(schema).option("columnPruning", "false").csv(
        path, sep=separator, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, quote='"', escape='"',
        enforceSchema=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    bad, first = F.col(CORRUPT), F.col("`" + names[0].replace("`", "``") + "`")
    fields = F.size(F.split(bad, "\\Q" + separator + "\\E", -1))
    # The first column takes part because a reader may not be asked for the bad-line column alone.
    keep = bad.isNull() | ((fields <= len(names)) & (first.isNotNull() | bad.isNotNull()))
    return raw.where(keep).drop(CORRUPT)


def read_header(spark: SparkSession, path: str, separator: str = ",", skip_bad: bool = False) -> DataFrame:
    """Text with a header line; every column is text."""
    plain = spark.read.csv(path, header=True, sep=separator, quote='"', escape='"')
    return read_rows(spark, path, plain.columns, separator, True) if skip_bad else plain


def export_names(fields: int) -> list[str]:
    """Names for a line with so many fields: extended by placeholders or cut short."""
    extra = [f"{v.UNNAMED_PREFIX}{i}" for i in range(fields - len(v.LEAD_EXPORT_COLUMNS))]
    return (v.LEAD_EXPORT_COLUMNS + extra)[:fields]


def read_lead_export(spark: SparkSession, path: str, separator: str = "\t") -> DataFrame:
    """Headerless lead export. The field count comes from the first line, trailing empty fields
    included."""
    return read_rows(spark, path, export_names(first_line(spark, path).count(separator) + 1), separator, False)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None, n_rows: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    return df.limit(n_rows) if n_rows else df


BEHAVIOR_SCHEMA = T.StructType([
    T.StructField(n, T.TimestampType() if n == v.BEHAVIOR_TIME else T.StringType()) for n in v.BEHAVIOR_COLUMNS])


def read_behavior_log(spark: SparkSession, path: str) -> DataFrame:
    """Headerless log of 11 fields; the phone stays text."""
    use_utc(spark)
    return spark.read.schema(BEHAVIOR_SCHEMA).csv(path, sep="\t", header=False)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, n_rows: int | None = None) -> DataFrame:
    """Format-aware read of any supported table."""
    found = detect_format(spark, path)
    if found.kind == "parquet":
        return read_parquet(spark, path, columns, n_rows)
    if found.kind == "headerless":
        df = read_lead_export(spark, path)
    else:
        df = read_header(spark, path, infer_separator(spark, path))
    df = df.select(*columns) if columns else df
    return df.limit(n_rows) if n_rows else df


def adapt(df: DataFrame) -> tuple[DataFrame, dict]:
    """Required columns → alias contract → labels → time features → follow-up features.

    A table whose follow-up column cannot be read keeps its other columns; the metadata says so.
    """
    df, contract = apply_alias_contract(require_columns(df, v.REQUIRED_COLUMNS))
    info: dict = {"schema_contract": contract.as_dict()}
    out = creation_time_features(target_labels(df))
    source = next((c for c in (v.FOLLOWUPS, v.FOLLOWUPS_TECHNICAL) if c in out.columns), None)
    if source:
        info["json_feature_source"] = source
        try:
            out = add_followup_features(out, source)
            info["json_extraction_status"] = "success"
        except Exception as error:  # noqa: BLE001 - the rest of the table is still useful
            info["json_extraction_status"] = "failed"
            info["json_extraction_error"] = str(error)
    return out, info


def load_leads(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    if not path or not path.strip():
        raise ValueError("the path is empty")
    use_utc(spark)
    return adapt(read_table(spark, path))


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty text as NULL, as the delimited readers give it."""
    texts = {f.name: F.nullif(F.col(f"`{f.name}`"), F.lit("")) for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns(texts) if texts else df
