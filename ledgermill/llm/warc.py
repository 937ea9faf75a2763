"""WARC archives: one gzip member per record, and a reader that splits files by byte ranges.

Writing: of pages with equal payloads the first is written in full (response), the
others as revisit records that name it. Every task writes its own files and
reports them; only reported files count, so a second attempt of a task or a lost
executor leaves at most files that nothing reads.

Reading: a task gets byte ranges. It looks for the gzip magic from the start of
its range on, accepts a candidate if the member decodes to a WARC header, and owns
the records whose first byte lies in its range. From an accepted record on, the
next one starts where the member before ends; what cannot be read there is reported
and the search goes on. Records of other writers are read as far as they say.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import numbered_copy, stored
from ledgermill.session import scratch_dir

MIN_REVISIT_BYTES = 0
FILE_BYTES = 1 << 30
RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 20
PIECE_BYTES = 1 << 14
BATCH_BYTES = 8 << 20
BATCH_ROWS = 1000

# Names of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:page"
DAMAGED = "no record can be read where one begins"
# Pages carry no time of their own; archives must be equal from run to run.
DATE = "2000-01-01T00:00:00Z"

FILES = "file string, bytes long, records long"
RECORDS = (
    "file string, at long, record_id string, page_id long, record_type string, "
    "target_uri string, payload_bytes long, payload_digest string, refers_to long, "
    "payload binary, error string"
)


def file_system(path: str):
    """File system and inner path of a URI; a bare path is local."""
    from pyarrow import fs

    if ":" in path.split("/")[0]:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode("ascii")


def record_name(page_id: int | None, row_no: int) -> str:
    return f"<{RECORD}:{'' if page_id is None else page_id}:{row_no}>"


def page_of(name: str | None) -> int | None:
    """The page id of a record name written by :func:`record_name`; None for other names."""
    parts = (name or "").strip("<>").rsplit(":", 2)
    if len(parts) < 3 or parts[0] != RECORD or not re.fullmatch(r"-?[0-9]+", parts[1]):
        return None
    return int(parts[1])


def record_bytes(
    page_id: int | None,
    row_no: int,
    url: str | None,
    payload: bytes,
    response: tuple[int | None, int] | None,
) -> bytes:
    """One gzip member; ``response`` names the record a revisit stands for."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode("ascii")
    block = http + (payload if response is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if response is None else 'revisit'}",
        f"WARC-Record-ID: {record_name(page_id, row_no)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest_text(hashlib.sha1(payload).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # White space, controls and non-ASCII cannot stand in a header line.
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    if response is not None:
        lines.append(f"WARC-Refers-To: {record_name(*response)}")
        lines.append(f"WARC-Profile: {REVISIT}")
    head = ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def report(file: str, size: int, records: int) -> pd.DataFrame:
    return pd.DataFrame([(file, size, records)], columns=["file", "bytes", "records"])


def _writer(folder: str, file_bytes: int):
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, path = file_system(folder)
        stream, name, size, records = None, "", 0, 0
        try:
            for frame in frames:
                for row in frame.itertuples(index=False):
                    if stream is None:
                        part = TaskContext.get().partitionId()
                        name = f"pages-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                        files.create_dir(path, recursive=True)
                        # The name's ending must not make it compress a second time.
                        stream = files.open_output_stream(f"{path}/{name}", compression=None)
                        size = records = 0
                    response = None
                    if row.first_row is not None and not pd.isna(row.first_row):
                        first = None if pd.isna(row.first_page) else int(row.first_page)
                        response = (first, int(row.first_row))
                    data = record_bytes(
                        None if pd.isna(row.page_id) else int(row.page_id),
                        int(row.row_no),
                        row.url if isinstance(row.url, str) else None,
                        bytes(row.payload),
                        response,
                    )
                    stream.write(data)
                    size += len(data)
                    records += 1
                    if size >= file_bytes:
                        stream.close()
                        stream = None
                        yield report(f"{folder}/{name}", size, records)
            if stream is not None:
                stream.close()
                stream = None
                yield report(f"{folder}/{name}", size, records)
        finally:
            if stream is not None:
                stream.close()

    return write


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write one record per row below ``folder``; returns the files: file, bytes, records.

    Null payloads are empty. Of rows with equal payloads of at least ``min_bytes``
    bytes the one with the smallest id is the response, a null id only where there
    is no other, and of rows repeated with one id the first. An empty table writes
    no file; other columns are ignored.
    """
    needed = pages.select(*dict.fromkeys([id_column, url_column, html_column]))
    rows = numbered_copy(needed, "row__no").select(
        F.col("row__no").alias("row_no"),
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).alias("url"),
        F.encode(F.coalesce(F.col(html_column), F.lit("")), "UTF-8").alias("payload"),
    )
    slim = stored(
        rows.select(
            "row_no",
            "page_id",
            # Payloads are equal if two digests of different kinds and their sizes are.
            F.concat(F.sha1("payload"), F.hex(F.xxhash64("payload"))).alias("digest"),
            F.octet_length("payload").alias("size"),
        ).where(F.col("size") >= min_bytes),
        "payload-digests",
    )
    rank = F.coalesce("page_id", F.lit(2**63 - 1))
    # The first row of the smallest id: combined before the shuffle in two steps.
    smallest = slim.groupBy("digest", "size").agg(
        F.min(rank).alias("first_rank"), F.count(F.lit(1)).alias("copies")
    )
    smallest = stored(smallest.where("copies > 1").drop("copies"), "repeated-payloads")
    named = stored(
        slim.join(smallest, ["digest", "size"]).select(
            "digest", "size", "row_no", "page_id", (rank == F.col("first_rank")).alias("is_first")
        ),
        "repeated-pages",
    )
    first = stored(
        named.where("is_first")
        .groupBy("digest", "size")
        .agg(F.min("row_no").alias("first_row"), F.first("page_id").alias("first_page")),
        "first-pages",
    )
    revisits = stored(
        named.join(first, ["digest", "size"])
        .where("row_no != first_row")
        .select(F.col("row_no").alias("again"), "first_row", "first_page"),
        "revisits",
    )
    decided = rows.join(revisits, F.col("row_no") == F.col("again"), "left").drop("again")
    return stored(decided.mapInPandas(_writer(folder, file_bytes), FILES), "archive-files")


class RangeReader:
    """Records of one file whose first byte lies in a byte range."""

    def __init__(self, handle, start: int, end: int):
        self.handle, self.place, self.end = handle, start, end
        self.buffer, self.buffer_at = b"", 0

    def _read(self, at: int, size: int) -> memoryview:
        """``size`` bytes from ``at`` on, fewer at the end of the file, through one buffer."""
        inside = at - self.buffer_at
        if inside < 0 or inside + size > len(self.buffer):
            self.handle.seek(at)
            self.buffer, self.buffer_at, inside = self.handle.read(max(size, READ_BYTES)), at, 0
        return memoryview(self.buffer)[inside : inside + size]

    def _next_magic(self, at: int) -> int:
        """First place from ``at`` on, before the end of the range, that holds the magic; or -1."""
        while at < self.end:
            data = bytes(self._read(at, PIECE_BYTES + len(MAGIC) - 1))
            found = data.find(MAGIC)
            if found >= 0:
                return at + found if at + found < self.end else -1
            if len(data) < PIECE_BYTES:
                return -1
            at += PIECE_BYTES
        return -1

    def _member(self, at: int) -> tuple[bytes, int] | None:
        """Content and end of the member at ``at``; None if it is no WARC record."""
        inflate = zlib.decompressobj(31)
        parts: list[bytes] = []
        checked, place = False, at
        while not inflate.eof:
            data = self._read(place, PIECE_BYTES)
            if not len(data):
                return None
            place += len(data)
            try:
                parts.append(inflate.decompress(data))
            except zlib.error:
                return None
            if not checked and sum(map(len, parts)) >= len(VERSION):
                if not b"".join(parts).startswith(VERSION):
                    return None
                checked = True
        if not checked:
            return None
        return b"".join(parts), place - len(inflate.unused_data)

    def records(self) -> Iterator[tuple[int, bytes | None]]:
        """Place and content of every record; no content where one must begin and none does.

        A record begins at the start of the file and where another one ends. The range in
        which the record before lies reports it, also if the place is beyond its end.
        """
        known = 0 if self.place == 0 and len(self._read(0, 1)) else None
        at = self._next_magic(self.place)
        while True:
            found = self._member(at) if 0 <= at < self.end else None
            if known is not None and (at != known or found is None):
                # Beyond the range's end it is somebody else's, unless it is damaged.
                if known < self.end or self._member(known) is None:
                    yield known, None
            known = None
            if not 0 <= at < self.end:
                return
            if found is None:
                at = self._next_magic(at + 1)
                continue
            content, after = found
            yield at, content
            known = after if len(self._read(after, 1)) else None
            at = self._next_magic(after)


def headers_of(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def parsed(content: bytes) -> dict[str, object] | None:
    """Fields of a response or revisit record of any writer; None for other kinds.

    What a record does not say is None, but for the payload's size and digest, which are
    taken from the payload of a response. ``error`` says that they contradict it.
    """
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = headers_of(head)
    kind = headers.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    length = headers.get("content-length", "")
    error = None
    if not length.isdigit() or int(length) > len(rest):
        error = "the block is shorter than its length"
    block = rest[: int(length)] if length.isdigit() else rest
    http, _, payload = block.partition(b"\r\n\r\n")
    said = headers.get("warc-payload-digest")
    said = said.removeprefix("sha1:") if said and said.startswith("sha1:") else None
    size = headers_of(http).get("content-length", "")
    size = int(size) if size.isdigit() else None
    if kind == "response":
        found = digest_text(hashlib.sha1(payload).digest())
        if said not in (None, found) or size not in (None, len(payload)):
            error = error or "the payload does not match its digest or size"
        said, size = found, len(payload)
    return {
        "record_id": headers.get("warc-record-id"),
        "page_id": page_of(headers.get("warc-record-id")),
        "record_type": kind,
        "target_uri": headers.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": said,
        "refers_to": page_of(headers.get("warc-refers-to")),
        "payload": payload if kind == "response" else None,
        "error": error,
    }


def _reader(payloads: bool):
    names = [part.split()[0] for part in RECORDS.split(", ")]

    def frame_of(rows: list[dict[str, object]]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        for name in ("page_id", "payload_bytes", "refers_to"):
            out[name] = pd.array(out[name], dtype="Int64")
        return out

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for split in frame.itertuples(index=False):
                files, path = file_system(split.file)
                rows, held = [], 0
                with files.open_input_file(path) as handle:
                    for at, content in RangeReader(handle, split.start, split.end).records():
                        fields = {"error": DAMAGED} if content is None else parsed(content)
                        if fields is None:
                            continue
                        if not payloads:
                            fields["payload"] = None
                        held += len(fields.get("payload") or b"")
                        rows.append({"file": split.file, "at": at, **fields})
                        if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                            yield frame_of(rows)
                            rows, held = [], 0
                if rows:
                    yield frame_of(rows)

    return read


def read_archives(
    files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True
) -> DataFrame:
    """Records of the ``file, bytes`` rows, read in byte ranges.

    A record belongs to the range its first byte lies in, so ranges of any size
    give every record once. Without ``payloads`` the payload column stays null;
    payloads are checked against their digests either way. A record that contradicts
    itself, and a place where a record must begin and none can be read, is a row with
    ``error`` set; reading goes on at the next record.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))
    ranges = files.where("bytes > 0").select("file", "bytes", F.explode(starts).alias("start"))
    ranges = ranges.select(
        "file", "start", F.least(F.col("start") + range_bytes, F.col("bytes")).alias("end")
    )
    tasks = max(1, ranges.count())
    return ranges.repartition(tasks, "file", "start").mapInPandas(_reader(payloads), RECORDS)


def checked(records: DataFrame, files: DataFrame) -> DataFrame:
    """``records``, after a look at them: none has an error, and each file has all of its own."""
    found = records.groupBy("file").agg(
        F.count(F.lit(1)).alias("found"), F.max("error").alias("error")
    )
    wrong = files.join(found, "file", "left").where(
        "error IS NOT NULL OR coalesce(found, 0) != records"
    )
    for r in wrong.limit(1).collect():
        raise ValueError(f"{r['file']}: {r['found']} of {r['records']} records, {r['error']}")
    return records


def archived(pages: DataFrame, folder: str | None = None, **columns: str) -> DataFrame:
    """Write ``pages`` to archives and read them back: the records without payloads.

    Every record that was written must be read, else this raises.
    """
    folder = folder or scratch_dir(pages.sparkSession, "archives")
    files = write_archives(pages, folder, **columns)
    return checked(stored(read_archives(files, payloads=False), "records"), files)
