"""Exported mail messages (JSON) to landing rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.functions import text
from ledgermill.schemas import MESSAGE, MIME_DEPTH, message_part
from ledgermill.session import scratch_dir

# A MIME part without its children; every level is brought to this shape. ``rest`` is
# the raw text of children below the levels read so far.
_PART = (
    "STRUCT<mimeType: STRING, filename: STRING, "
    "body: STRUCT<attachmentId: STRING, data: STRING, size: BIGINT>, rest: STRING>"
)

# Levels that one pass over deeper messages reads.
LEVELS = 4 * (MIME_DEPTH + 1)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).json(path)


def parse_messages(json: DataFrame, column: str) -> DataFrame:
    """Message rows from a column of JSON texts."""
    return json.select(F.from_json(column, MESSAGE).alias("m")).select("m.*")


def _slim(part: Column, rest: Column | None = None) -> Column:
    return F.struct(
        part["mimeType"].alias("mimeType"),
        part["filename"].alias("filename"),
        part["body"].alias("body"),
        (F.lit(None) if rest is None else rest).cast("string").alias("rest"),
    ).cast(_PART)


def _tree(parts: Column, depth: int) -> Column:
    """Parts of a list and below, in document order. A missing list counts as empty."""

    def with_children(part: Column) -> Column:
        if depth == 0:
            rest = F.when(~F.trim(part["parts"]).isin("[]", "null", ""), part["parts"])
            return F.array(_slim(part, rest))
        return F.concat(F.array(_slim(part)), _tree(part["parts"], depth - 1))

    walk = F.flatten(F.transform(parts, with_children))
    return F.coalesce(walk, F.array().cast(f"array<{_PART}>"))


def _read_rest(parts: Column) -> Column:
    """Put the children that are raw text so far behind their parts."""
    level = f"ARRAY<{message_part(MIME_DEPTH)}>"

    def read(part: Column) -> Column:
        below = _tree(F.from_json(part["rest"], level), MIME_DEPTH)
        return F.when(part["rest"].isNull(), F.array(part)).otherwise(
            F.concat(F.array(part.withField("rest", F.lit(None).cast("string"))), below)
        )

    return F.flatten(F.transform(parts, read))


def _unread(parts: Column) -> Column:
    return F.exists(parts, lambda part: part["rest"].isNotNull())


def with_parts(messages: DataFrame) -> DataFrame:
    """Add ``_parts``: every part below the message itself, at any depth, in document order.

    The schema reads the first levels. Messages that nest deeper, and only they, are
    read again, :data:`LEVELS` levels a pass, until no part is left as text. Each pass is
    written to the scratch folder, so the next one starts from there.
    """
    spark = messages.sparkSession
    rows = messages.withColumn("_parts", _tree(F.col("payload.parts"), MIME_DEPTH - 1))
    unread = _unread(F.col("_parts"))
    done, pending = rows.filter(~unread), rows.filter(unread)
    while pending.limit(1).count():
        path = scratch_dir(spark, "parts")
        parts = F.col("_parts")
        for _ in range(LEVELS // (MIME_DEPTH + 1)):
            parts = _read_rest(parts)
        pending.withColumn("_parts", parts).write.parquet(path)
        stored = spark.read.schema(rows.schema).parquet(path)
        done = done.unionByName(stored.filter(~unread))
        pending = stored.filter(unread)
    return done


def all_parts() -> Column:
    """The message itself and all parts of :func:`with_parts`."""
    return F.concat(F.array(_slim(F.col("payload"))), F.col("_parts"))


def header(payload: Column, name: str, last: bool = False) -> Column:
    """Value of a header by case-insensitive name: the first, or the last one."""
    found = F.filter(payload["headers"], lambda h: F.lower(h["name"]) == name.lower())
    return F.try_element_at(found, F.lit(-1 if last else 1))["value"]


def received_at(messages_ms: Column) -> Column:
    return F.timestamp_millis(F.coalesce(messages_ms.try_cast("bigint"), F.lit(0)))


def is_pdf_name(name: Column) -> Column:
    return F.lower(F.coalesce(name, F.lit(""))).endswith(".pdf")


def pdf_parts() -> Column:
    """Parts with a PDF name and a size above zero, at any depth."""
    return F.filter(
        all_parts(),
        lambda p: is_pdf_name(p["filename"]) & (F.coalesce(p["body"]["size"], F.lit(0)) > 0),
    )


def flatten_messages(messages: DataFrame) -> DataFrame:
    """One landing row per PDF part; the kept JSON has no top-level body."""
    kept = F.to_json(F.struct("id", "internalDate", "snippet", F.col("payload").dropFields("body").alias("payload")))
    name = F.coalesce(F.col("part.filename"), F.lit(""))
    return (
        with_parts(messages)
        .withColumn("raw_json", kept)
        .withColumn("part", F.explode(pdf_parts()))
        .select(
            F.lit("GMAIL").alias("source_type"),
            F.col("id").alias("source_id"),
            header(F.col("payload"), "subject").alias("subject"),
            text.sender_address(header(F.col("payload"), "from")).alias("sender_email"),
            received_at(F.col("internalDate")).alias("received_at"),
            F.nullif(name, F.lit("")).alias("file_name"),
            text.file_extension(name).alias("file_ext"),
            F.col("part.body.size").alias("file_size_bytes"),
            "raw_json",
        )
    )


def first_pdf(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """Live variant: PDF by MIME type or name, with content; the first match only.

    The parts are searched first, the message itself only if none matches.
    Messages without a match come out with ``no_attachment`` set.
    """
    now = F.current_timestamp() if now is None else now

    def wanted(part: Column) -> Column:
        mime = F.lower(F.coalesce(part["mimeType"], F.lit("")))
        inline = F.length(F.coalesce(part["body"]["data"], F.lit(""))) > 0
        attached = F.coalesce(part["body"]["attachmentId"], F.lit("")) != ""
        return (mime.contains("pdf") | is_pdf_name(part["filename"])) & (inline | attached)

    payload = F.col("payload")
    nested = F.filter("_parts", wanted)
    root = F.filter(F.array(_slim(payload)), wanted)
    part = F.try_element_at(F.when(F.size(nested) > 0, nested).otherwise(root), F.lit(1))
    name = F.coalesce(F.nullif(F.col("part.filename"), F.lit("")), F.lit("attachment.pdf"))
    sent = F.col("internalDate").try_cast("bigint")
    return with_parts(messages).withColumn("part", part).select(
        F.lit("GMAIL").alias("source_type"),
        F.coalesce("id", F.lit("")).alias("source_id"),
        F.coalesce(header(payload, "subject", last=True), F.lit("")).alias("subject"),
        F.coalesce(header(payload, "from", last=True), F.lit("")).alias("sender_email"),
        F.coalesce(F.timestamp_millis(sent), now).alias("received_at"),
        name.alias("file_name"),
        F.lower(F.substring_index(name, ".", -1)).alias("file_ext"),
        F.lit(None).cast("bigint").alias("file_size_bytes"),
        F.concat(F.coalesce("id", F.lit("")), F.lit("_"), text.staged_name(name)).alias(
            "staged_name"
        ),
        F.col("part").isNull().alias("no_attachment"),
    )


def body_rows(messages: DataFrame) -> DataFrame:
    """Messages without a PDF: the body becomes the text, file fields stay NULL."""
    payload = F.col("payload")
    plain = F.filter(
        all_parts(), lambda p: F.length(F.coalesce(p["body"]["data"], F.lit(""))) > 0
    )
    data = F.try_element_at(plain, F.lit(1))["body"]["data"]
    body = text.body_text(data, F.col("snippet"))
    return (
        with_parts(messages)
        .filter(F.size(pdf_parts()) == 0)
        .withColumn("body", body)
        .select(
            F.lit("GMAIL").alias("source_type"),
            F.col("id").alias("source_id"),
            header(payload, "subject").alias("subject"),
            text.sender_address(header(payload, "from")).alias("sender_email"),
            received_at(F.col("internalDate")).alias("received_at"),
            F.lit(None).cast("string").alias("file_name"),
            F.lit(None).cast("string").alias("file_ext"),
            F.lit(None).cast("bigint").alias("file_size_bytes"),
            text.preview(F.col("body")).alias("content_preview"),
            F.length("body").alias("body_text_length"),
            F.col("body").alias("classifier_input"),
        )
    )


def keyword_pattern(keywords: tuple[str, ...] = seeds.MAIL_KEYWORDS) -> str:
    """Whole-word alternation, ignoring case."""
    return r"(?i)\b(" + "|".join(re.escape(k).replace(r"\ ", " ") for k in keywords) + r")\b"


def select_messages(
    rows: DataFrame,
    after: Column,
    before: Column,
    searched: Column | None = None,
    keywords: tuple[str, ...] = seeds.MAIL_KEYWORDS,
) -> DataFrame:
    """Rows received in ``[after, before + 1 day)`` that name one of the keywords."""
    window = (F.col("received_at") >= after) & (
        F.col("received_at") < F.date_add(before, 1).cast("timestamp")
    )
    searched = F.concat_ws(" ", "subject", "file_name") if searched is None else searched
    return rows.filter(window & searched.rlike(keyword_pattern(keywords)))


def select_since(rows: DataFrame, after: Column, today: Column) -> DataFrame:
    """Live variant: no keywords, from the high-water mark up to today, exclusive."""
    return rows.filter(
        (F.col("received_at") >= after) & (F.col("received_at") < today.cast("timestamp"))
    )
