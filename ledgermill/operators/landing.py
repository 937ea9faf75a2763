"""Writing to the landing queue: new rows only, JSON assembly and JSON updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions.crypto import content_hash
from ledgermill.functions.text import drop_nul, preview
from ledgermill.operators.buckets import EPOCH, SLOT, BucketedLog
from ledgermill.operators.keys import first_per_key
from ledgermill.schemas import LANDING_DOCUMENTS
from ledgermill.sources.queue import landed_hashes

_FILE = "_file_key"
LANDING_KEY = ("source_type", "source_id", _FILE)


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn(_FILE, F.coalesce("file_name", F.lit("")))


def new_rows(landing: DataFrame, rows: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Rows whose key is not landed yet, one per key.

    The key treats a missing file name as empty text. Rows without a source id
    never conflict, as NULL is not equal to NULL. Both sides of the anti join
    are unique on the key, so it carries no hot key.
    """
    # The hash settles ties, so that a repeated task picks the same row again.
    order = order or [F.col("file_size_bytes").desc_nulls_last(), F.xxhash64(*rows.columns)]
    keyed = _keyed(rows)
    complete = F.col("source_type").isNotNull() & F.col("source_id").isNotNull()
    known = _keyed(landing).select(*LANDING_KEY)
    fresh = first_per_key(keyed.filter(complete), LANDING_KEY, order).join(
        known, list(LANDING_KEY), "left_anti"
    )
    return fresh.unionByName(keyed.filter(~complete)).drop(_FILE)


def append_new(landing: DataFrame, rows: DataFrame, path: str) -> dict[str, int]:
    """Append the new rows to ``path``; returns loaded and skipped counts."""
    offered, loaded = Observation("offered"), Observation("loaded")
    seen = rows.observe(offered, F.count(F.lit(1)).alias("n"))
    out = new_rows(landing, seen).observe(loaded, F.count(F.lit(1)).alias("n"))
    out.write.mode("append").parquet(path)
    return {"loaded": loaded.get["n"], "skipped": offered.get["n"] - loaded.get["n"]}


def drop_known_files(files: DataFrame, landing: DataFrame) -> DataFrame:
    """Files whose content is neither landed nor earlier in the same batch.

    The bytes are hashed in the scan and dropped: only the file facts travel.
    """
    hashed = files if "file_hash" in files.columns else files.withColumn(
        "file_hash", content_hash(F.col("content"))
    )
    facts = hashed.drop("content")
    order = [F.col("file_name").asc(), F.xxhash64(*facts.columns)]
    once = first_per_key(facts, ["file_hash"], order)
    return once.join(landed_hashes(landing).select("file_hash"), "file_hash", "left_anti")


def land_documents(files: DataFrame, processed_at: Column) -> DataFrame:
    """Landing rows from processed files.

    ``files`` has ``source_type, source_id, path, modified_at, size, text,
    filed_path, classification`` (struct) and the message metadata ``meta``
    (struct, NULL for a dropped file). Metadata fields win over file facts and
    are laid over the JSON object.
    """
    full_text = F.coalesce(drop_nul(F.col("text")), F.lit(""))
    name = F.coalesce("meta.file_name", F.substring_index("path", "/", -1))
    extension = F.coalesce("meta.file_ext", F.nullif(F.regexp_extract(name, r"\.([^.]+)$", 1), F.lit("")))
    received = F.coalesce(F.col("meta.received_at"), F.col("modified_at"))
    size = F.coalesce(F.nullif(F.col("meta.file_size_bytes"), F.lit(0)), F.col("size"))
    facts = [
        F.col("filed_path"),
        F.col("classification"),
        full_text.alias("full_text"),
        F.length(full_text).alias("text_length"),
        processed_at.alias("processed_at"),
    ]
    message = [F.col(f"meta.{field}").alias(field) for field in files.select("meta.*").columns]
    json = F.when(F.col("meta").isNull(), F.to_json(F.struct(*facts))).otherwise(
        F.to_json(F.struct(*facts, *message))
    )
    return files.select(
        "source_type",
        "source_id",
        drop_nul(F.col("meta.subject")).alias("subject"),
        drop_nul(F.col("meta.sender_email")).alias("sender_email"),
        received.alias("received_at"),
        name.alias("file_name"),
        F.lower(extension).alias("file_ext"),
        size.alias("file_size_bytes"),
        preview(F.col("text")).alias("content_preview"),
        F.replace(json, F.lit("\\u0000"), F.lit("")).alias("raw_json"),
    )


def classification_updates(updates: DataFrame, column: str = "updates") -> DataFrame:
    """``(landing_id, classification JSON)`` rows from a JSON array of updates."""
    each = F.explode(F.from_json(column, "array<struct<landing_id: bigint, classification: string>>"))
    return updates.select(each.alias("u")).select("u.landing_id", "u.classification")


def update_json(landing: DataFrame, updates: DataFrame) -> DataFrame:
    """Set ``classification`` inside ``raw_json`` for the given landing ids.

    The object is read as a map of variants, so unknown fields survive. Both
    sides are unique on the landing id.
    """
    new = updates.select(F.col("landing_id").alias("_id"), F.col("classification").alias("_cls"))
    joined = landing.join(new, F.col("landing_id") == F.col("_id"), "left")
    return joined.withColumn("raw_json", _rebuilt()).select(*landing.columns)


def _rebuilt() -> Column:
    """``raw_json`` with ``_cls`` as its classification, where ``_id`` is set."""
    fields = F.coalesce(
        F.from_json("raw_json", "map<string,variant>"),
        F.create_map().cast("map<string,variant>"),
    )
    kept = F.map_filter(fields, lambda key, _: key != "classification")
    added = F.create_map(F.lit("classification"), F.parse_json("_cls"))
    rebuilt = F.to_json(F.map_concat(kept, added))
    return F.when(F.col("_id").isNotNull(), rebuilt).otherwise(F.col("raw_json"))


ID_KEY = ("landing_id",)
UPDATE = "landing_id BIGINT, classification STRING"


def landing_log(spark: SparkSession, path: str) -> BucketedLog:
    """Landing rows, bucketed on their id."""
    return BucketedLog(spark, path, LANDING_DOCUMENTS, ID_KEY)


def update_log(spark: SparkSession, path: str) -> BucketedLog:
    """New classifications, a small table beside the landing rows; the latest epoch counts."""
    return BucketedLog(spark, path, UPDATE, ID_KEY)


def read_updated(rows: BucketedLog, updates: BucketedLog) -> DataFrame:
    """Landing rows with their latest classification put into ``raw_json``.

    An update writes its few rows only. They meet the landing rows here, bucket by
    bucket, so the JSON is not shuffled and nothing is rewritten.
    """
    rows.check_same_layout(updates)
    latest = first_per_key(updates.read(), [SLOT, *ID_KEY], [F.col(EPOCH).desc()])
    new = latest.select(
        F.col(SLOT).alias("_slot"),
        F.col("landing_id").alias("_id"),
        F.col("classification").alias("_cls"),
    )
    on = (F.col(SLOT) == F.col("_slot")) & (F.col("landing_id") == F.col("_id"))
    joined = rows.read().join(new, on, "left")
    return joined.withColumn("raw_json", _rebuilt()).select(*rows.columns)


def reset_landing(landing: DataFrame, path: str) -> None:
    """Empty the whole queue, processed or not. An explicit call only."""
    landing.limit(0).write.mode("overwrite").parquet(path)
