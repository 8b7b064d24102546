"""Keyed store of prepared tables, JSON sidecars, and saved models."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showroom.operators.contract import excluded_columns

PARTS = ("train", "valid", "test")


def columns_version(target: str) -> str:
    return hashlib.sha256("|".join(sorted(excluded_columns(target))).encode()).hexdigest()[:16]


def source_fingerprint(spark: SparkSession, path: str) -> dict:
    """Files, bytes, latest change and an order-free hash of the listing. Contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = files.agg(
        F.count("*").alias("files"), F.sum("length").alias("size"),
        F.max(F.unix_micros("modificationTime")).alias("mtime_us"), F.sum(mark).cast("string").alias("listing")).first()
    return row.asDict()


def prep_key(
    spark: SparkSession, data_path: str, target_label: str, schema_version: str, split_mode: str,
    split_group_mode: str, label_mode: str, feature_profile: str, random_seed: int,
    excluded_columns_version: str | None = None, feature_pipeline_version: str = "1",
) -> str:
    """24 hex digits that change with the source or any setting."""
    payload = {
        "data_path": data_path, **source_fingerprint(spark, data_path), "target_label": target_label,
        "schema_version": schema_version, "split_mode": split_mode, "split_group_mode": split_group_mode,
        "label_mode": label_mode, "feature_profile": feature_profile, "random_seed": random_seed,
        "excluded_columns_version": excluded_columns_version or columns_version(target_label),
        "feature_pipeline_version": feature_pipeline_version,
    }
    return hashlib.sha256(json.dumps(payload, ensure_ascii=False, sort_keys=True).encode()).hexdigest()[:24]


def write_sidecar(spark: SparkSession, path: str, content: dict) -> None:
    """One JSON text next to a table or model, on the same file system."""
    text = json.dumps(content, ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_sidecar(spark: SparkSession, path: str) -> dict | None:
    try:
        row = spark.read.text(path).first()
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return json.loads(row["value"]) if row else None


class PrepStore:
    """Train, valid and test tables with metadata under one key.

    The metadata is written last, so a key is complete exactly when its metadata exists.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _at(self, key: str, name: str) -> str:
        return f"{self.root}/{key}/{name}"

    def save(self, key: str, tables: dict[str, DataFrame], metadata: dict[str, Any]) -> str:
        for part in PARTS:
            tables[part].write.mode("overwrite").parquet(self._at(key, part))
        write_sidecar(self.spark, self._at(key, "metadata"), metadata)
        return f"{self.root}/{key}"

    def load(self, key: str) -> dict[str, Any] | None:
        metadata = read_sidecar(self.spark, self._at(key, "metadata"))
        if metadata is None:
            return None
        tables = {p: self.spark.read.parquet(self._at(key, p)) for p in PARTS}
        return {**tables, "metadata": metadata}


def save_model(spark: SparkSession, model: PipelineModel, path: str, metadata: dict) -> None:
    model.write().overwrite().save(f"{path}/model")
    write_sidecar(spark, f"{path}/metadata", metadata)


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    metadata = read_sidecar(spark, f"{path}/metadata")
    if metadata is None:
        raise FileNotFoundError(f"no model at {path}")
    return PipelineModel.load(f"{path}/model"), metadata
