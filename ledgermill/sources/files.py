"""Drop-folder listing: files of any size, hashed piece by piece.

The listing is a data source of its own. The driver lists the folder and deals the files
over partitions by their sizes; a task reads its files in chunks and keeps a digest, so
no file is ever held whole, however large it is.
"""

from __future__ import annotations

import datetime
import hashlib
import uuid
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgermill.functions.text import base_name, file_extension
from ledgermill.seeds import STAGING_EXTENSIONS

CHUNK_BYTES = 1 << 20
# Bytes of files that one task reads, and what opening a file counts as.
PARTITION_BYTES, OPEN_BYTES = 128 << 20, 4 << 20

# Spark's listing, without the content, which is never read through it.
BINARY_FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"

LISTED = (
    "path STRING, file_name STRING, file_size_bytes BIGINT, modified_at TIMESTAMP, "
    "file_hash STRING"
)


def file_system(path: str):
    """File system and inner path of a URI or of a local path."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def sha256_of(path: str, chunk_bytes: int = CHUNK_BYTES) -> str:
    """Digest of a file, read in chunks. A listing may give its name in URL form."""
    files, inner = file_system(path)
    if not files.get_file_info(inner).is_file:
        inner = unquote(inner)
    digest = hashlib.sha256()
    with files.open_input_stream(inner) as handle:
        while chunk := handle.read(chunk_bytes):
            digest.update(chunk)
    return digest.hexdigest()


def copy_beside(path: str, names: list[str], chunk_bytes: int = CHUNK_BYTES) -> None:
    """Copies of a file under other names in its folder, all filled in one reading.

    A copy is hidden until it is whole, and a repeated task replaces it.
    """
    files, inner = file_system(path)
    folder = inner.rpartition("/")[0]
    hidden = [f"{folder}/.{name}-{uuid.uuid4().hex}" for name in names]
    with ExitStack() as opened:
        given = opened.enter_context(files.open_input_stream(inner))
        copies = [opened.enter_context(files.open_output_stream(name)) for name in hidden]
        while chunk := given.read(chunk_bytes):
            for copy in copies:
                copy.write(chunk)
    for whole, name in zip(hidden, names, strict=True):
        files.move(whole, f"{folder}/{name}")


@dataclass
class Listed(InputPartition):
    """Files of one task: path, name, size and time."""

    files: list[tuple[str, str, int, datetime.datetime | None]]


class StagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.hashed = tuple(f".{e}" for e in options.get("hashed", "").split(",") if e)
        self.chunk_bytes = int(options.get("chunkbytes", CHUNK_BYTES))
        self.recursive = options.get("recursive", "false").lower() == "true"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))

    def partitions(self) -> list[Listed]:
        """Visible files of the folder, dealt by size, the largest first."""
        from pyarrow import fs

        files, inner = file_system(self.folder)
        prefix = self.folder[: len(self.folder) - len(inner.rstrip("/"))] if ":" in self.folder else ""
        found = [
            (prefix + info.path, info.base_name, info.size, info.mtime)
            for info in files.get_file_info(fs.FileSelector(inner, recursive=self.recursive))
            if info.is_file and not info.base_name.startswith((".", "_"))
        ]
        parts, held = [], self.partition_bytes
        for one in sorted(found, key=lambda f: (-f[2], f[1])):
            if held + one[2] + OPEN_BYTES > self.partition_bytes:
                parts.append(Listed([]))
                held = 0
            parts[-1].files.append(one)
            held += one[2] + OPEN_BYTES
        return parts or [Listed([])]

    def read(self, partition: Listed) -> Iterator[tuple]:
        for path, name, size, modified in partition.files:
            wanted = name.lower().endswith(self.hashed) if self.hashed else False
            yield path, name, size, modified, sha256_of(path, self.chunk_bytes) if wanted else None


class StagedFiles(DataSource):
    """``spark.read.format("staged_files")``: the visible files of a folder.

    Options: ``hashed`` (extensions, with commas, of files that get a digest; none by
    default), ``recursive`` (folders below as well), ``chunkBytes`` and ``partitionBytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "staged_files"

    def schema(self) -> str:
        return LISTED

    def reader(self, schema) -> StagedReader:
        return StagedReader({k.lower(): v for k, v in self.options.items()})


def _supported() -> Column:
    return F.coalesce(F.col("file_ext").isin(*STAGING_EXTENSIONS), F.lit(False))


def list_staging(
    spark: SparkSession,
    folder: str,
    hashed: tuple[str, ...] = (),
    chunk_bytes: int = CHUNK_BYTES,
    recursive: bool = False,
) -> DataFrame:
    """Every visible file of a folder; files are opened only for their digest."""
    spark.dataSource.register(StagedFiles)
    source = spark.read.format("staged_files").option("hashed", ",".join(hashed))
    source = source.option("chunkBytes", chunk_bytes).option("recursive", recursive)
    files = source.load(folder)
    return files.withColumn("file_ext", file_extension(F.col("file_name")))


def copy_staging(spark: SparkSession, folder: str, extensions: tuple[str, ...]) -> None:
    """Copy every visible file of a folder and those below it, once per extension, beside it."""

    def copied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, name in zip(frame["path"], frame["file_name"], strict=True):
                copy_beside(path, [f"copy-{i}-{name}.{e}" for i, e in enumerate(extensions)])
            yield frame[["path"]]

    listed = list_staging(spark, folder, recursive=True).select("path", "file_name")
    listed.mapInPandas(copied, "path STRING").write.format("noop").mode("overwrite").save()


def scan_staging(
    spark: SparkSession, folder: str, chunk_bytes: int = CHUNK_BYTES, recursive: bool = False
) -> DataFrame:
    """Files of a supported type with their content hash."""
    listed = list_staging(spark, folder, STAGING_EXTENSIONS, chunk_bytes, recursive)
    return listed.filter(_supported()).select(
        "path", "file_name", "file_ext", "file_size_bytes", "modified_at", "file_hash"
    )


def described(files: DataFrame) -> DataFrame:
    """Rows of Spark's own file listing in the shape of :func:`list_staging`, unhashed."""
    name = base_name(F.col("path"))
    return (
        files.withColumn("file_name", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))))
        .withColumn("file_ext", file_extension(F.col("file_name")))
        .filter(~F.col("file_name").startswith(".") & _supported())
        .select(
            "path",
            "file_name",
            "file_ext",
            F.col("length").alias("file_size_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def with_hashes(listed: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Listed files with the digest of what they hold, read in chunks by the tasks."""
    columns = "path STRING, file_name STRING, file_ext STRING, file_size_bytes BIGINT, modified_at TIMESTAMP"

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(file_hash=[sha256_of(p, chunk_bytes) for p in frame["path"]])

    names = [c.split(" ")[0] for c in columns.split(", ")]
    return listed.select(*names).mapInPandas(hashed, f"{columns}, file_hash STRING")


def unsupported_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Rejected files counted per extension."""
    return (
        list_staging(spark, folder, recursive=recursive)
        .filter(~_supported())
        .groupBy("file_ext")
        .agg(F.count(F.lit(1)).alias("files"))
    )
