"""Bank and share statement CSV files to raw landing rows.

Files of any size take one path: Spark splits them into blocks of lines, and a line's
number is the line count of the blocks before plus its place in the block. Whether a line
begins inside a quoted field is carried the same way, so that it is joined to the record
it belongs to, also across blocks; a quote opens at the start of a field only. A record's
fields are kept as an array of any width, and columns are named by their place.

The text is scanned once: lines are written with their block, place and state, and all
that follows reads this copy, so a scan that would be split in another way changes nothing.
A block lies in one scan task and in order, so places and states are counted along the scan
and lines are not shuffled; only lines of records of several lines are, to be joined. What
is known of a block or of a file is one row, written as well, so that Spark knows its size
and broadcasts it.
A record of several lines must be well formed and no longer than a documented bound;
otherwise a quote was left open by mistake, and its lines are read one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill import seeds
from ledgermill.session import kept_copy

# Longest record of several lines.
MOST_LINES, MOST_CHARACTERS = 1000, 1 << 20
# A record whose quoted fields all end right before a comma or the end.
_STRICT = r'(?s)(?:\s*"[^"]*+(?:""[^"]*+)*+"\s*|(?!\s*")[^,]*)(?:,(?:\s*"[^"]*+(?:""[^"]*+)*+"\s*|(?!\s*")[^,]*))*'

# A field behind the comma before it: quoted with doubled quotes inside, or plain.
_FIELD = r'(?:^|,)(\s*(?:"[^"]*(?:""[^"]*)*"[^,]*|[^,]*))'
# The fields of a line from its start on that end in the line, with the comma behind.
_ENDED = r'\G(?:\s*+"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!\s*+")[^,]*+)(?:,|\z)'


@dataclass(frozen=True)
class Layout:
    """Column mapping of one provider."""

    provider: str
    date_col: str
    amount_col: str | None
    debit_col: str | None
    credit_col: str | None
    description_col: str
    balance_col: str | None
    skip_rows: int

    @property
    def mapped(self) -> tuple[str, ...]:
        columns = (
            self.date_col, self.amount_col, self.debit_col, self.credit_col,
            self.description_col, self.balance_col,
        )
        return tuple(c for c in columns if c)


def seeded_layouts() -> tuple[Layout, ...]:
    return tuple(
        Layout(name, date, amount, debit, credit, description, balance, int(skip or 0))
        for _, name, date, _, amount, debit, credit, description, balance, skip in seeds.rows_of(
            seeds.STATEMENT_PROVIDERS
        )
    )


def detect_provider(
    file: Column, header: Column, layouts: tuple[Layout, ...] | None = None
) -> Column:
    """Provider by a word of the file name, else by the header.

    By the header it is the layout with the most columns among those whose columns
    are all there. Layouts that cannot be told apart leave the provider NULL.
    """
    layouts = layouts or seeded_layouts()
    name = F.lower(F.substring_index(file, "/", -1))
    # A name may hold signs itself, so its words are looked for between signs.
    words = F.concat(F.lit(" "), F.regexp_replace(name, r"[^a-z0-9]+", " "), F.lit(" "))

    def named(layout: Layout) -> Column:
        wanted = "".join(c if c.isalnum() else " " for c in layout.provider.lower())
        return words.contains(f" {wanted} ")

    by_name = [F.when(named(x), x.provider) for x in layouts]
    sizes = {x.mapped: len(x.mapped) for x in layouts}
    by_header = []
    for mapped in sorted(sizes, key=lambda m: -sizes[m]):
        owners = [x.provider for x in layouts if x.mapped == mapped]
        fits = F.size(F.array_except(F.array(*[F.lit(c) for c in mapped]), header)) == 0
        by_header.append((fits, F.lit(owners[0] if len(owners) == 1 else None).cast("string")))
    choice = F.lit(None).cast("string")
    for fits, provider in reversed(by_header):
        choice = F.when(fits, provider).otherwise(choice)
    return F.coalesce(*by_name, choice)


def _cut(line: Column) -> Column:
    """The fields of a record as they stand between its commas."""
    return F.regexp_extract_all(line, F.lit(_FIELD), F.lit(1))


def csv_fields(line: Column) -> Column:
    """The fields of a record: trimmed, unquoted, empty ones NULL."""
    return _unquoted(_cut(line))


def _unquoted(parts: Column) -> Column:
    """Fields as cut: trimmed, unquoted, empty ones NULL."""

    def clean(bare: Column) -> Column:
        inner = F.regexp_extract(bare, r'(?s)^"(.*)"[^"]*$', 1)
        value = F.when(bare.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"')))
        return F.nullif(F.coalesce(value, bare), F.lit(""))

    # Trimmed first, as what is used several times in a function is worked out each time.
    return F.transform(F.transform(parts, lambda part: F.trim(part)), clean)


def column_names(header: Column) -> Column:
    """Names by place: a blank one is numbered, a repeated one gets its number added."""

    def numbered(names: Column) -> Column:
        return F.transform(
            names,
            lambda name, i: F.when(
                F.array_contains(F.slice(names, F.lit(1), i), name),
                F.concat(name, F.lit("#"), (i + 1).cast("string")),
            ).otherwise(name),
        )

    filled = F.transform(
        header,
        lambda name, i: F.coalesce(name, F.concat(F.lit("column_"), (i + 1).cast("string"))),
    )
    return numbered(numbered(filled))


def _carried(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """State before and after each row, given the rows' ``if_closed`` and ``if_open``.

    A row's columns are the states (1 is inside quotes) it leaves if it is begun
    closed and open: it settles the state, keeps it or flips it. The state before a
    row is thus the one last settled, or the first one, and the flips since;
    ``before_closed`` and ``before_open`` hold it for both first states, and
    ``after_closed`` and ``after_open`` the state behind the row.
    """
    through = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    settles = F.col("if_closed") == F.col("if_open")
    flips = (F.col("if_closed") > F.col("if_open")).cast("long")
    rows = rows.withColumn("_flips", F.sum(flips).over(through))
    settled = F.when(settles, F.col("if_closed") - F.col("_flips"))
    rows = rows.withColumn("_settled", F.last(settled, ignorenulls=True).over(through))
    after = {
        f"after_{name}": F.pmod(F.coalesce("_settled", F.lit(first)) + F.col("_flips"), F.lit(2))
        for name, first in (("closed", 0), ("open", 1))
    }
    rows = rows.withColumns(after)
    own = Window.partitionBy(*keys).orderBy(order)
    before = {
        f"before_{name}": F.coalesce(F.lag(f"after_{name}").over(own), F.lit(first))
        for name, first in (("closed", 0), ("open", 1))
    }
    return rows.withColumns(before).drop("_flips", "_settled")


# What a scan task adds to a line: its place in the block, the state before and behind it and
# the place its record starts at (0: in an earlier block), for both first states of the block.
_STATES = ("place", "before_closed", "after_closed", "start_closed", "before_open", "after_open", "start_open")


def _along_the_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of ``_STATES`` for lines that come in order, block by block."""
    at, place, after, start = None, 0, [0, 1], [0, 0]
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file"), batch.column("block").to_numpy(zero_copy_only=False)
        codes = np.asarray(files.dictionary_encode().indices)
        changes = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
        closed = batch.column("if_closed").to_numpy(zero_copy_only=False)
        opened = batch.column("if_open").to_numpy(zero_copy_only=False)
        out = {name: np.empty(batch.num_rows, dtype=np.int64) for name in _STATES}
        bounds = [0, *changes.tolist(), batch.num_rows]
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            here = (files[begin].as_py(), int(blocks[begin]))
            if here != at:
                at, place, after, start = here, 0, [0, 1], [0, 0]
            own = slice(begin, end)
            places = place + 1 + np.arange(end - begin)
            flips = np.cumsum(closed[own] > opened[own])
            settled = np.where(closed[own] == opened[own], np.arange(end - begin), -1)
            settled = np.maximum.accumulate(settled)
            base = closed[own][settled] - flips[settled]
            out["place"][own] = places
            for i, name in enumerate(("closed", "open")):
                behind = (np.where(settled >= 0, base, after[i]) + flips) % 2
                before = np.concatenate([[after[i]], behind[:-1]])
                starts = np.maximum.accumulate(np.where(before == 0, places, start[i]))
                out[f"before_{name}"][own], out[f"after_{name}"][own] = before, behind
                out[f"start_{name}"][own] = starts
                after[i], start[i] = int(behind[-1]), int(starts[-1])
            place = int(places[-1])
        kept = {name: batch.column(name) for name in ("file", "block", "value", "if_closed")}
        yield pa.RecordBatch.from_pydict({**kept, **{n: pa.array(v) for n, v in out.items()}})


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their number in the file and the number of the line their record starts in.

    A block's lines keep their order in the scan, and a block is at most one scan
    partition; what is known about a block is one row. The lines of a record that is
    not closed before its file ends are ``unclosed`` and stay single.
    """
    bare = F.regexp_replace("value", "^\ufeff", "")

    def left_open(line: Column) -> Column:
        return (F.regexp_replace(line, _ENDED, "") != "").cast("long")

    quoted = F.col("value").contains('"')
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        F.when(quoted, left_open(bare)).otherwise(F.lit(0).cast("long")).alias("if_closed"),
        F.when(quoted, left_open(F.concat(F.lit('"'), "value")))
        .otherwise(F.lit(1).cast("long"))
        .alias("if_open"),
    )
    states = ", ".join(f"{name} LONG" for name in _STATES)
    # Blocks and places hold for this scan only, so what follows reads what it wrote.
    placed = kept_copy(
        lines.mapInArrow(
            _along_the_scan, f"file STRING, block LONG, value STRING, if_closed LONG, {states}"
        ),
        "lines",
    )
    blocks = placed.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("after_closed", "place").alias("if_closed"),
        F.max_by("after_open", "place").alias("if_open"),
        F.nullif(F.max("start_closed"), F.lit(0)).alias("last_closed"),
        F.nullif(F.max("start_open"), F.lit(0)).alias("last_open"),
    )
    blocks = _carried(blocks.withColumn("_id", F.monotonically_increasing_id()), ["file"], "block")
    earlier = (
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = blocks.withColumn("lines_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    blocks = blocks.withColumn("begun", F.col("before_closed"))
    own_last = F.when(F.col("begun") == 0, F.col("last_closed")).otherwise(F.col("last_open"))
    blocks = blocks.withColumn("last_start", F.col("lines_before") + own_last)
    whole = Window.partitionBy("file")
    at_end = F.max_by("after_closed", "block").over(whole)
    blocks = blocks.select(
        "file",
        "block",
        # A number for the path, which is long; it holds as this is written once.
        F.min("_id").over(whole).alias("file_no"),
        "lines_before",
        "begun",
        F.when(at_end == 1, F.max("last_start").over(whole)).alias("unclosed_from"),
        F.last("last_start", ignorenulls=True).over(earlier).alias("start_before"),
    )
    line_no = F.col("lines_before") + F.col("place")
    unclosed = F.coalesce(line_no >= F.col("unclosed_from"), F.lit(False))

    def of_block(name: str) -> Column:
        return F.when(F.col("begun") == 0, F.col(f"{name}_closed")).otherwise(F.col(f"{name}_open"))

    begun_here = F.col("lines_before") + F.nullif(of_block("start"), F.lit(0))
    return placed.join(kept_copy(blocks, "blocks"), ["file", "block"]).select(
        "file",
        "file_no",
        "value",
        line_no.alias("line_no"),
        unclosed.alias("unclosed"),
        ((of_block("before") == 0) | unclosed).alias("starts"),
        ((of_block("after") == 1) & ~unclosed).alias("goes_on"),
        (F.col("if_closed") == 1).alias("open_alone"),
        F.when(unclosed, line_no)
        .otherwise(F.coalesce(begun_here, "start_before", F.lit(1)))
        .alias("record_no"),
    )


def _joined_records(lines: DataFrame) -> DataFrame:
    """One row per record: file, file_no, line_no (of its first line), value, unclosed, parts.

    Only records of several lines are shuffled and collected, up to the bound; ``parts``
    are their lines. They go by the file's number, so that no line takes its path along
    unless ``file`` is read. Where a quote is never closed, every line from it to the end of its
    file is a row of its own, and so is every line of a record beyond the bound.
    """
    keys = ["file_no", "record_no"]
    one = F.col("starts") & ~F.col("goes_on")
    alone = lines.where(one).select(
        "file",
        "file_no",
        "line_no",
        "value",
        "unclosed",
        F.lit(None).cast("array<struct<line_no:bigint,value:string,open_alone:boolean>>").alias("parts"),
    )
    record, later = Window.partitionBy(*keys), ~F.col("starts")
    fits = (F.count_if(later).over(record) < MOST_LINES) & (
        F.sum(F.when(later, F.length("value")).otherwise(0)).over(record) < MOST_CHARACTERS
    )
    part = F.struct("line_no", "value", "open_alone")
    several = (
        lines.where(~one)
        .withColumn("apart", F.when(~fits, F.col("line_no")))
        .groupBy(*keys, "apart")
        .agg(F.any_value("file").alias("file"), F.array_sort(F.collect_list(part)).alias("parts"))
        .select(
            "file",
            "file_no",
            F.coalesce("apart", "record_no").alias("line_no"),
            F.array_join(F.transform("parts", lambda x: x["value"]), "\n").alias("value"),
            (F.col("apart").isNotNull() & F.col("parts")[0]["open_alone"]).alias("unclosed"),
            F.when(F.col("apart").isNull(), F.col("parts")).alias("parts"),
        )
    )
    return alone.unionByName(several)


def _line_by_line(data: DataFrame) -> DataFrame:
    """Records of several lines that are not well formed, as single lines.

    A quote that closes inside a field, or more fields than the header has, says that
    the quote before was never meant to span lines.
    """
    formed = F.col("value").rlike(rf"\A{_STRICT}\z") & (F.size("_cut") <= F.size("names"))
    whole = F.array(F.struct("line_no", "value", F.col("unclosed").alias("open_alone")))
    kept = F.when(F.col("parts").isNull() | formed, whole).otherwise(F.col("parts"))
    return (
        data.withColumn("_cut", _cut(F.col("value")))
        .withColumn("_line", F.explode(kept))
        # What was cut is the whole record, also where it is its only line.
        .withColumn("_cut", F.when(F.col("value") == F.col("_line.value"), F.col("_cut")))
        .withColumn("line_no", F.col("_line.line_no"))
        .withColumn("value", F.col("_line.value"))
        .withColumn("unclosed", F.col("_line.open_alone"))
        .drop("_line", "parts")
    )


def _described(
    lines: DataFrame, layouts: tuple[Layout, ...], file_name: Column | None = None
) -> DataFrame:
    """file, file_no, provider, header_line, names: one row per file, from its first lines.

    Lines above the header are counted as lines of the file. Only lines of records that
    start among the first ones are joined.
    """
    most = max(x.skip_rows for x in layouts) + 1
    records = _joined_records(lines.where(F.col("record_no") <= most))
    heads = records.where(F.col("line_no") <= most).select(
        "file",
        "file_no",
        "line_no",
        csv_fields(F.regexp_replace("value", "^\ufeff", "")).alias("fields"),
    )
    firsts = heads.groupBy("file", "file_no").agg(
        F.map_from_entries(F.collect_list(F.struct("line_no", "fields"))).alias("head")
    )
    none = F.array().cast("array<string>")
    first = F.coalesce(F.try_element_at("head", F.lit(1).cast("long")), none)
    named = F.col("file") if file_name is None else file_name
    found = firsts.withColumn("provider", detect_provider(named, first, layouts))
    skip = F.coalesce(
        *[F.when(F.col("provider") == x.provider, F.lit(x.skip_rows)) for x in layouts], F.lit(0)
    )
    found = found.withColumn("header_line", (skip + 1).cast("long"))
    header = F.coalesce(F.try_element_at("head", F.col("header_line")), none)
    return found.select(
        "file", "file_no", "provider", "header_line", column_names(header).alias("names")
    )


def read_records(
    spark: SparkSession,
    path: str,
    layouts: tuple[Layout, ...],
    file_name: Column | None = None,
) -> DataFrame:
    """``(file, provider, row_num, record)``: data records as name -> text maps.

    The lines are read and written to the scratch folder when this is called.

    ``file_name`` stands for the path where the provider is told by other means.

    ``row_num`` counts lines after the header. Fields beyond the header's are kept
    under their place; fields a short record lacks are NULL. Where a quote is never
    closed, every line to the end of the file is a record whose only value is the
    line, at the place after the header's, so that it is rejected and not lost. A
    record of several lines that is not well formed is taken line by line: of these,
    lines that leave a quote open are such records, the others are read as they are.
    """
    lines = _numbered_lines(spark, path)
    described = kept_copy(_described(lines, layouts, file_name), "described")
    records = _joined_records(lines).drop("file")
    data = records.where(F.trim("value") != "").join(described, "file_no")
    data = _line_by_line(data.where(F.col("line_no") > F.col("header_line")))
    data = data.where(F.trim("value") != "")
    unread = F.concat(
        F.array_repeat(F.lit(None).cast("string"), F.size("names")), F.array("value")
    )
    cut = F.coalesce("_cut", _cut(F.col("value")))
    parsed = data.withColumn("fields", F.when(F.col("unclosed"), unread).otherwise(_unquoted(cut)))
    width = F.greatest(F.size("names"), F.size("fields"))
    named = F.transform(
        F.sequence(F.lit(1), width),
        lambda i: F.struct(
            F.coalesce(
                F.try_element_at("names", i), F.concat(F.lit("column_"), i.cast("string"))
            ).alias("key"),
            F.try_element_at("fields", i).alias("value"),
        ),
    )
    as_wide = F.size("names") == F.size("fields")
    record = F.when(as_wide, F.map_from_arrays("names", "fields")).otherwise(
        F.map_from_entries(named)
    )
    return parsed.select(
        "file",
        "provider",
        (F.col("line_no") - F.col("header_line")).cast("int").alias("row_num"),
        record.alias("record"),
    )


def read_statement(
    spark: SparkSession,
    path: str,
    account_id: Column | None = None,
    layouts: tuple[Layout, ...] | None = None,
    file_name: Column | None = None,
) -> DataFrame:
    """Raw landing rows: mapped columns as text, the rest of each row as JSON."""
    layouts = layouts or seeded_layouts()
    rows = read_records(spark, path, layouts, file_name)

    def mapped(field: str) -> Column:
        branches = [
            F.when(F.col("provider") == x.provider, F.try_element_at("record", F.lit(getattr(x, field))))
            for x in layouts
            if getattr(x, field)
        ]
        return F.coalesce(*branches, F.lit(None).cast("string"))

    def unmapped(layout: Layout) -> Column:
        return F.to_json(F.map_filter("record", lambda k, _: ~k.isin(*layout.mapped)))

    extras = F.coalesce(
        *[F.when(F.col("provider") == x.provider, unmapped(x)) for x in layouts],
        F.to_json("record"),
    )
    return rows.select(
        F.col("file").alias("source_file"),
        "provider",
        (F.lit(None).cast("int") if account_id is None else account_id).alias("account_id"),
        "row_num",
        mapped("date_col").alias("txn_date_raw"),
        mapped("amount_col").alias("amount_raw"),
        mapped("debit_col").alias("debit_raw"),
        mapped("credit_col").alias("credit_raw"),
        mapped("balance_col").alias("balance_raw"),
        mapped("description_col").alias("description_raw"),
        extras.alias("raw_json"),
    )


# Columns of a share-trade export (ours: the broker layout is left open).
TRADE_COLUMNS = {
    "trade_date_raw": "Trade Date",
    "security_raw": "Security",
    "quantity_raw": "Quantity",
    "price_raw": "Price",
    "value_raw": "Value",
    "trade_type_raw": "Type",
    "brokerage_raw": "Brokerage",
}


def read_share_trades(
    spark: SparkSession,
    path: str,
    account_id: Column | None = None,
    columns: dict[str, str] | None = None,
) -> DataFrame:
    """Trade rows as text, with the columns that are not mapped as JSON."""
    columns = columns or TRADE_COLUMNS
    rows = read_records(spark, path, seeded_layouts())
    names = list(columns.values())
    return rows.select(
        F.col("file").alias("source_file"),
        (F.lit(None).cast("int") if account_id is None else account_id).alias("account_id"),
        "row_num",
        *[F.try_element_at("record", F.lit(c)).alias(out) for out, c in columns.items()],
        F.to_json(F.map_filter("record", lambda k, v: ~k.isin(*names))).alias("raw_json"),
    )
