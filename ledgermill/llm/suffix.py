"""Suffix-array deduplication by bucket-pointer refinement.

Every string of ``span`` bytes is a bucket of the places where it starts; of a bucket
all places but the first are repeats, and the bytes they cover go. Buckets are found
by refinement, and only what is still undecided is refined further:

1. *q-gram buckets.* Every window of ``span`` bytes names one place in it, that of its
   least q-gram. Equal windows name the same place, so a place and the run of windows
   that name it stand for all of them. Places start in the bucket of their q-gram.
2. *Sorting on later buckets.* Inside a bucket, places are sorted on the identifiers of
   the q-grams at the later offsets that cover all their windows. Places that agree
   hold the same windows: all but the first are repeats. A bucket in which nothing
   differs, or which has one place, is settled.
3. *Recursion.* Where a bucket holds different places, their runs are cut into chunks
   of a few windows. A chunk's bucket is what its windows share, its identifier
   being made from those of its q-grams; inside it chunks are sorted on the few bytes
   on both sides. Chunks that are still undecided are cut into single windows, whose
   place in the bucket is exact.

An identifier of 2k bytes is made from those of k bytes at i and i + k, so each
refinement uses the identifiers of the one before. Identifiers are 64-bit digests;
windows are told apart by two of them (and the bytes at their sides), places of one
q-gram bucket by one more.

A sort is a range partitioning by bucket and class, so a q-gram that stands nearly
everywhere is dealt over many tasks. Before each sort a task settles what its own
batch repeats: a passage of many documents sends one row per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import ARROW_ROWS, fresh, numbered_copy, stored

SPAN = 100
GRAM = 32
CHUNK = 9
# Bytes of text, and places, that a task works on at once.
SEGMENT = 1 << 22
BLOCK = 1 << 13
NARROW_ROWS = "16384"
LAST = 2**63 - 1

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _mixed(value: np.ndarray) -> np.ndarray:
    value ^= value >> np.uint64(29)
    value *= _B
    value ^= value >> np.uint64(32)
    return value


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Identifiers of strings from those of two parts."""
    value = left * _A
    value += right
    return _mixed(value)


def identifiers(data: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Identifier of the ``length`` bytes at every place of ``data`` where they fit."""
    places = len(data) - length + 1
    if places <= 0:
        return np.zeros(0, dtype=np.uint64)
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    width = min(8, length)
    eights = np.ndarray((len(data) - width + 1,), dtype="<u8", buffer=padded, strides=(1,))
    ids = _mixed((eights & _LOW_BYTES[width]) + np.uint64(2 * seed + 1) * _A)
    while 2 * width <= length:
        ids = _paired(ids[:-width], ids[width:])
        width *= 2
    return ids if width == length else _paired(ids[: places], ids[length - width :])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _covering(span: int, gram: int) -> list[int]:
    """Offsets of q-grams that cover ``span`` bytes."""
    return [*range(0, span - gram, gram), span - gram]


def named_places(
    data: np.ndarray, offsets: np.ndarray, span: int, gram: int, segment: int = SEGMENT
) -> dict[str, np.ndarray]:
    """Places that windows of the documents in ``data`` name.

    Document i is ``data[offsets[i]:offsets[i + 1]]``. Per place: at (of the first window
    that names it), lead (from there to the place), count (of windows), core (the q-gram's
    identifier) and whole (that of all its windows' text).
    """
    found = []
    ends = offsets[1:]
    for low in range(0, max(0, len(data) - span + 1), segment):
        part = data[low : low + segment + span - 1]
        grams = identifiers(part, gram)
        # The order of q-grams is that of their upper halves, then of their places.
        packed = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
        place = (_least(packed, span - gram + 1) & ~_HIGH).astype(np.int64)
        begins = np.empty(len(place), dtype=bool)
        begins[0] = True
        np.not_equal(place[1:], place[:-1], out=begins[1:])
        edges = np.concatenate([offsets, np.maximum(ends - span + 1, 0)]) - low
        begins[edges[(edges >= 0) & (edges < len(place))]] = True
        at = np.flatnonzero(begins)
        count = np.diff(np.append(at, len(place)))
        doc = np.searchsorted(ends, at + low, side="right")
        inside = at + low + span <= ends[doc]
        at, count = at[inside], count[inside]
        chosen = place[at]
        last = at + count - 1
        whole = ((chosen - at).astype(np.uint64) << np.uint64(32)) + count.astype(np.uint64)
        for start in (at, last):
            for offset in _covering(span, gram):
                whole = _paired(whole, grams[start + offset])
        found.append((at + low, chosen - at, count, grams[chosen], whole))
    names = ("at", "lead", "count", "core", "whole")
    if not found:
        return {n: np.zeros(0, np.uint64 if n in ("core", "whole") else np.int64) for n in names}
    return {n: np.concatenate([f[i] for f in found]) for i, n in enumerate(names)}


def _repeats(keys: list[np.ndarray], order: list[np.ndarray]) -> np.ndarray:
    """Whether another row with equal keys comes earlier in ``order``."""
    by = np.lexsort([*order[::-1], *keys[::-1]])
    again = np.zeros(len(by), dtype=bool)
    if len(by) > 1:
        same = np.ones(len(by) - 1, dtype=bool)
        for key in keys:
            ordered = key[by]
            same &= ordered[1:] == ordered[:-1]
        again[by[1:]] = same
    return again


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _column(batch, name).to_numpy(zero_copy_only=False)


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The batch's texts as one buffer, and the offsets of the documents in it."""
    text = _column(batch, "text").cast(pa.large_binary())
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[text.offset :][: batch.num_rows + 1]
    view = np.frombuffer(data or b"", dtype=np.uint8)
    return view[offsets[0] : offsets[-1]], offsets - offsets[0]


def _batch(columns: dict[str, np.ndarray], again: np.ndarray) -> pa.RecordBatch:
    arrays = [
        pa.array(v.view(np.int64) if v.dtype == np.uint64 else v, pa.int64())
        for v in columns.values()
    ]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array(again, pa.bool_())], names=[*columns, "again"]
    )


PLACES = ("core", "whole", "doc", "row", "at", "lead", "count")
CHUNKS = ("core", "check", "left_bytes", "right_bytes", "edge", "doc", "row", "at", "count")
ORDER = ("doc", "row", "at")


def _schema(columns: tuple[str, ...]) -> str:
    return ", ".join(f"`{c}` long" for c in columns) + ", again boolean"


def _place_finder(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            by = np.lexsort([_longs(batch, "row"), _longs(batch, "doc")])
            batch = batch.take(pa.array(by))
            data, offsets = _texts(batch)
            found = named_places(data, offsets, span, gram)
            doc = np.searchsorted(offsets[1:], found["at"], side="right")
            again = _repeats([found["core"], found["whole"]], [found["at"]])
            # Neighbouring repeats become one row.
            at, count = found["at"], found["count"]
            joins = np.zeros(len(at), dtype=bool)
            if len(at) > 1:
                joins[1:] = again[1:] & again[:-1] & (doc[1:] == doc[:-1])
                joins[1:] &= at[1:] == at[:-1] + count[:-1]
            keep = np.flatnonzero(~joins)
            total = np.add.reduceat(count, keep) if len(keep) else count
            columns = {
                "core": found["core"][keep],
                "whole": found["whole"][keep],
                "doc": _longs(batch, "doc")[doc[keep]],
                "row": _longs(batch, "row")[doc[keep]],
                "at": (at - offsets[:-1][doc])[keep],
                "lead": found["lead"][keep],
                "count": total,
            }
            yield _batch(columns, again[keep])

    return run


def _chunker(span: int, gram: int, chunk: int):
    """Chunks of the windows of undecided places, with what surrounds their shared bytes."""
    sides = chunk - 1
    chunks = -(-(span - gram + 1) // chunk)
    left = chunks * chunk
    width = left + span

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = _texts(batch)
            lists = _column(batch, "places")
            per_doc = lists.value_lengths().to_numpy()
            flat = lists.flatten()
            all_docs = np.repeat(np.arange(batch.num_rows), per_doc)
            fields = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
            for low in range(0, len(all_docs), BLOCK):
                doc = all_docs[low : low + BLOCK]
                at, lead, count = (f[low : low + BLOCK] for f in fields)
                anchor = offsets[:-1][doc] + at + lead
                places = anchor[:, None] + np.arange(-left, span)
                inside = (places >= offsets[:-1][doc][:, None]) & (places < offsets[1:][doc][:, None])
                around = np.where(inside, data[np.clip(places, 0, len(data) - 1)], 0)
                around = np.ascontiguousarray(around, dtype=np.uint8)
                ids = [identifiers(around.reshape(-1), span - sides, seed) for seed in (1, 2)]
                parts = []
                for number in range(chunks):
                    least = np.maximum(lead - count + 1, number * chunk)
                    most = np.minimum(lead, number * chunk + sides)
                    has = np.flatnonzero(least <= most)
                    least, most = least[has] - number * chunk, most[has] - number * chunk
                    begin = left - number * chunk
                    eight = np.zeros((2, len(has), 8), dtype=np.uint8)
                    eight[0, :, 8 - sides :] = around[has, begin - sides : begin]
                    eight[1, :, :sides] = around[has, begin + span - sides : begin + span]
                    before = eight[0].view(">u8").reshape(-1).astype(np.uint64)
                    behind = eight[1].view("<u8").reshape(-1).astype(np.uint64)
                    parts.append(
                        {
                            "core": ids[0][has * width + begin],
                            "check": ids[1][has * width + begin],
                            # Bytes that no window of the chunk has don't count.
                            "left_bytes": before & _LOW_BYTES[most],
                            "right_bytes": behind & _LOW_BYTES[sides - least],
                            "edge": least * 16 + most,
                            "doc": _longs(batch, "doc")[doc[has]],
                            "row": _longs(batch, "row")[doc[has]],
                            "at": (at + lead)[has] - number * chunk - most,
                            "count": most - least + 1,
                        }
                    )
                rows = {c: np.concatenate([p[c] for p in parts]) for c in CHUNKS}
                yield _batch(
                    rows, _repeats([rows[c] for c in CHUNKS[:5]], [rows[c] for c in ORDER])
                )

    return run


def _splitter(chunk: int):
    """The single windows of undecided chunks."""
    sides = chunk - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            given = {c: _longs(batch, c) for c in CHUNKS}
            edge = given["edge"]
            parts = []
            for number in range(chunk):
                has = np.flatnonzero((edge // 16 <= number) & (number <= edge % 16))
                part = {c: given[c][has] for c in CHUNKS}
                part["left_bytes"] = part["left_bytes"].view(np.uint64) & _LOW_BYTES[number]
                part["right_bytes"] = (
                    part["right_bytes"].view(np.uint64) & _LOW_BYTES[sides - number]
                )
                part["at"] = part["at"] + edge[has] % 16 - number
                part["edge"] = np.full(len(has), 17 * number)
                part["count"] = np.ones(len(has), dtype=np.int64)
                parts.append(part)
            rows = {c: np.concatenate([p[c] for p in parts]) for c in CHUNKS}
            yield _batch(rows, _repeats([rows[c] for c in CHUNKS[:5]], [rows[c] for c in ORDER]))

    return run


def _scanner(columns: tuple[str, ...], bucket: int, keys: int):
    """Repeats, and the first rows of classes whose bucket holds others, of sorted rows.

    The first ``bucket`` columns name the bucket, the first ``keys`` the class. What
    stands at a partition's border counts as undecided.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # keys of the row before
        held = None  # first row of the last class, and whether its bucket holds others
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: _longs(batch, c) for c in columns}
            count = batch.num_rows
            other_bucket = np.zeros(count, dtype=bool)
            other_class = np.zeros(count, dtype=bool)
            for i, c in enumerate(columns[:keys]):
                differs = np.empty(count, dtype=bool)
                differs[0] = last is None or rows[c][0] != last[i]
                np.not_equal(rows[c][1:], rows[c][:-1], out=differs[1:])
                other_class |= differs
                if i < bucket:
                    other_bucket |= differs
            border = last is None
            last = [rows[c][-1] for c in columns[:keys]]
            first = np.flatnonzero(other_class)
            mixed = ~other_bucket[first]
            if border:
                mixed[0] = True
            if len(first):
                # The next class belongs to the same bucket.
                mixed[:-1] |= ~other_bucket[first[1:]]
                if held is not None:
                    row, others = held
                    if others or not other_bucket[first[0]]:
                        yield _batch(row, np.zeros(1, dtype=bool))
                held = ({c: rows[c][first[-1:]] for c in columns}, bool(mixed[-1]))
            undecided = np.zeros(count, dtype=bool)
            undecided[first[:-1]] = mixed[:-1]
            take = np.flatnonzero(undecided | ~other_class)
            if len(take):
                yield _batch({c: rows[c][take] for c in columns}, ~other_class[take])
        if held is not None:
            yield _batch(held[0], np.zeros(1, dtype=bool))

    return run


def _settled(
    rows: DataFrame, columns: tuple[str, ...], bucket: int, keys: int, name: str
) -> DataFrame:
    """Repeats and undecided rows among the first rows of their batches."""
    ranged = rows.where("NOT again").select(*columns).repartitionByRange(*columns[:keys])
    ranged = ranged.sortWithinPartitions(*columns[:keys], *ORDER)
    return stored(ranged.mapInArrow(_scanner(columns, bucket, keys), _schema(columns)), name)


class _Settings:
    """Session settings for as long as rows without texts are worked on."""

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf
        self.wanted = {
            "spark.sql.execution.arrow.maxRecordsPerBatch": NARROW_ROWS,
            # What a step shuffled is not needed once its table is written.
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        }

    def __enter__(self) -> None:
        self.before = {k: self.conf.get(k, None) for k in self.wanted}
        for key, value in self.wanted.items():
            self.conf.set(key, value)

    def __exit__(self, *_) -> None:
        for key, value in self.before.items():
            if value is None:
                self.conf.unset(key)
            else:
                self.conf.set(key, value)


def repeats(slim: DataFrame, span: int = SPAN, gram: int = GRAM, chunk: int = CHUNK) -> DataFrame:
    """row, at, count: runs of windows whose ``span`` bytes start earlier somewhere.

    ``slim``: row and doc (long, not null), text (not null); documents are ordered by
    doc, then row.
    """
    if not 0 < gram < span or not 1 < chunk <= 9:
        raise ValueError("the q-gram must be shorter than the span, a chunk 2 to 9 windows")
    spark = slim.sparkSession
    settings = _Settings(spark)
    places = stored(slim.mapInArrow(_place_finder(span, gram), _schema(PLACES)), "places")
    with settings:
        sorted_places = _settled(places, PLACES, 1, 2, "sorted-places")
    by_row = sorted_places.where("NOT again").groupBy("row").agg(
        F.collect_list(F.struct("at", "lead", "count")).alias("places")
    )
    with settings:
        # Texts come along here: small batches.
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
        chunks = stored(
            slim.join(by_row, "row").mapInArrow(_chunker(span, gram, chunk), _schema(CHUNKS)),
            "chunks",
        )
    with settings:
        sorted_chunks = _settled(chunks, CHUNKS, 2, 5, "sorted-chunks")
        windows = stored(
            sorted_chunks.where("NOT again")
            .select(*CHUNKS)
            .mapInArrow(_splitter(chunk), _schema(CHUNKS)),
            "windows",
        )
        sorted_windows = _settled(windows, CHUNKS, 5, 5, "sorted-windows")
    found = [places, sorted_places, chunks, sorted_chunks, windows, sorted_windows]
    again = [f.where("again").select("row", "at", "count") for f in found]
    result = again[0]
    for one in again[1:]:
        result = result.unionAll(one)
    return result


def _cutter(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = _texts(batch)
            lists = _column(batch, "runs")
            flat = lists.flatten()
            doc = np.repeat(
                np.arange(batch.num_rows), np.nan_to_num(lists.value_lengths().to_numpy(False))
                .astype(np.int64)
            )
            at = offsets[:-1][doc] + flat.field(0).to_numpy(zero_copy_only=False)
            end = at + flat.field(1).to_numpy(zero_copy_only=False) + span - 1
            by = np.lexsort([end, at])
            at, end, doc = at[by], end[by], doc[by]
            # A run begins where nothing before it in its document reaches.
            reach = np.maximum.accumulate(end) if len(end) else end
            begins = np.ones(len(at), dtype=bool)
            begins[1:] = (at[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(begins)
            low, doc = at[first], doc[first]
            high = reach[np.append(first[1:], len(at)) - 1] if len(first) else low
            kept = np.ones(len(data) + 1, dtype=bool)
            step = np.zeros(len(data) + 1, dtype=np.int8)
            step[low] += 1
            # A span may begin where one of the document before ended.
            np.subtract.at(step, high, 1)
            kept = np.cumsum(step, dtype=np.int8)[:-1] == 0
            per_doc = np.bincount(doc, minlength=batch.num_rows)
            rest = np.concatenate([[0], np.cumsum(kept)])[offsets]
            spans = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32()),
                pa.StructArray.from_arrays(
                    [
                        pa.array(low - offsets[:-1][doc], pa.int64()),
                        pa.array(high - offsets[:-1][doc], pa.int64()),
                    ],
                    names=["start", "end"],
                ),
            )
            rest_bytes = data[kept].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    _column(batch, "doc_id"),
                    pa.array(np.diff(offsets), pa.int64()),
                    spans,
                    pa.array(
                        [rest_bytes[a:b] for a, b in zip(rest[:-1], rest[1:], strict=True)],
                        pa.binary(),
                    ),
                ],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return run


def without_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    row_column: str | None = None,
    span: int = SPAN,
    gram: int = GRAM,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (start, end) removed, kept bytes.

    A byte goes if it lies in a string of ``span`` bytes that also starts earlier: in a
    document with a smaller id, or earlier in the same one. Texts are UTF-8 bytes, and a
    cut may fall inside a character. Null texts are empty; null ids come after all
    others; rows that share an id are ordered by their place in the table, and the
    later row's copies go. Texts may have any length. An empty table gives no rows.
    ``row_column`` names a unique number of each row that a second read of ``docs``
    gives again; without it a numbered copy is written. Other columns are ignored.
    """
    if row_column is None:
        row_column = fresh(docs.columns, "row_no")
        docs = numbered_copy(docs, row_column)
    slim = docs.select(
        F.col(row_column).cast("long").alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    runs = repeats(
        slim.select("row", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text"),
        span,
        gram,
        chunk,
    )
    by_row = runs.groupBy("row").agg(F.collect_list(F.struct("at", "count")).alias("runs"))
    return slim.join(by_row, "row", "left").select("doc_id", "text", "runs").mapInArrow(
        _cutter(span),
        "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary",
    )
