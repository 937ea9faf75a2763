"""Builders of hand-made rows: give the fields that matter, the rest is NULL."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgermill import schemas


def frame(spark: SparkSession, schema: str, rows: list[dict]) -> DataFrame:
    fields = T.StructType.fromDDL(schema)
    data = [tuple(row.get(f.name) for f in fields) for row in rows]
    return spark.createDataFrame(data, fields)


def landing(spark: SparkSession, rows: list[dict]) -> DataFrame:
    full = []
    for i, row in enumerate(rows):
        base = {
            "landing_id": i + 1,
            "batch_id": 1,
            "source_type": "GMAIL",
            "source_id": f"m{i}",
            "is_processed": False,
            "received_at": datetime.datetime(2025, 1, 15),
        }
        if "cls" in row:
            row = {**row, "raw_json": json.dumps({"classification": row["cls"]})}
        full.append({**base, **row})
    return frame(spark, schemas.LANDING_DOCUMENTS, full)


def core(spark: SparkSession, rows: list[dict]) -> DataFrame:
    full = []
    for i, row in enumerate(rows):
        base = {
            "doc_id": i + 1,
            "source_type": "GMAIL",
            "source_id": f"m{i}",
            "review_status": "PENDING",
            "line_items": [],
        }
        full.append({**base, **row})
    return frame(spark, schemas.CORE_DOCUMENTS, full)


def values(df: DataFrame, *columns: str) -> list[tuple]:
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))
