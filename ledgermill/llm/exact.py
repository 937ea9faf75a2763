"""Exact deduplication by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes. All blocks of
the corpus are sorted and the k-th distinct block gets a name in sort order, so
equal blocks, and only those, share an integer. Adjacent names of a document are
then paired, all pairs are sorted and named in the same way, and so on until one
name is left. Two documents have equal texts exactly when they end after the
same number of rounds with the same name; no digest is trusted.

Sorting is a range partitioning with the row's own place as the last key, so a
block that a third of all documents share is dealt over many partitions. A task
names its own run of the order; a run that goes on from the partition before
takes that partition's last name. What is known about the borders is one row per
partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import fresh, levels_for, numbered_rows, stored, with_row_id

BLOCK_BYTES = 8192

# Names of one partition: at most 2^40 rows, 2^23 partitions.
NAME_BITS = 40

# A run of white space other than one single space; single spaces stay as they are.
_SPACES = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACES, " ")


def _differs(column: pa.Array, before) -> pa.Array:
    """Per row whether the value is another than the row's before; nulls are equal."""
    earlier = pa.concat_arrays([pa.array([before], column.type), column.slice(0, len(column) - 1)])
    unequal = pc.not_equal(column, earlier)
    nulls = pc.xor(pc.is_null(column), pc.is_null(earlier))
    return pc.or_(pc.fill_null(unequal, False), nulls)


def _namer(keys: list[str], carry: list[str]):
    """Names for the sorted rows of one partition, and a last row on its borders."""

    def name_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offset = TaskContext.get().partitionId() << NAME_BITS
        first = last = None
        count = -1
        types = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            types = [c.type for c in columns]
            heads = [c[0].as_py() for c in columns]
            if first is None:
                first = last = heads
                count = 0
            new = None
            for column, before in zip(columns, last, strict=True):
                step = _differs(column, before)
                new = step if new is None else pc.or_(new, step)
            local = pc.add(pc.cumulative_sum(pc.cast(new, pa.int64())), count)
            count = local[len(local) - 1].as_py()
            last = [c[len(c) - 1].as_py() for c in columns]
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in carry]
                + [pc.add(local, offset)]
                + [pa.nulls(rows, pa.int64())]
                + [pa.nulls(rows, t) for t in types * 2],
                names=[*carry, "name", "names", *_edges(keys)],
            )
        if first is not None:
            schema = batch.schema
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, schema.field(c).type) for c in carry]
                + [pa.array([offset], pa.int64()), pa.array([count + 1], pa.int64())]
                + [pa.array([v], t) for v, t in zip(first + last, types * 2, strict=True)],
                names=[*carry, "name", "names", *_edges(keys)],
            )

    return name_rows


def _edges(keys: list[str]) -> list[str]:
    return [f"first_{k}" for k in keys] + [f"last_{k}" for k in keys]


def sorted_names(
    rows: DataFrame, keys: list[str], carry: list[str], deal: dict[str, Column] | None = None
) -> DataFrame:
    """``carry`` columns of every row and ``name``, equal exactly for equal ``keys``.

    ``deal`` names short columns that follow from the keys and lead the sort order.
    A range partitioning samples its keys on the driver, which long keys would
    fill; the names themselves come from comparing the keys.

    Names follow the sort order of the keys. The first two ``carry`` columns must
    identify the row, as they settle where a run of equal keys is split.
    """
    lead = list(deal or {})
    ranged = rows.select(*keys, *carry).withColumns(deal or {})
    ranged = ranged.repartitionByRange(*(lead or keys), *carry[:2])
    ranged = ranged.sortWithinPartitions(*lead, *keys).select(*keys, *carry)
    schema = ", ".join(
        [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry]
        + ["name long", "names long"]
        + [f"first_{k} {rows.schema[k].dataType.simpleString()}" for k in keys]
        + [f"last_{k} {rows.schema[k].dataType.simpleString()}" for k in keys]
    )
    named = stored(ranged.mapInArrow(_namer(keys, carry), schema), "names")
    named_rows = named.where("names IS NULL").select(*carry, "name")

    # One row per partition: which partitions go on with the run before them.
    order = Window.orderBy("name")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"first_{k}").eqNullSafe(F.lag(f"last_{k}").over(order))
    borders = named.where("names IS NOT NULL")
    borders = borders.withColumn(
        "goes_on", same & (F.row_number().over(order) > 1)
    ).withColumn(
        "own_last",
        F.when(~(F.col("goes_on") & (F.col("names") == 1)), F.col("name") + F.col("names") - 1),
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    moved = borders.withColumn("to", F.last("own_last", ignorenulls=True).over(before))
    moved = moved.where("goes_on").select(F.col("name").alias("from_name"), "to")
    # At most one row per partition of the sort.
    return named_rows.join(F.broadcast(moved), F.col("name") == F.col("from_name"), "left").select(
        *carry, F.coalesce("to", "name").alias("name")
    )


def blocks(
    docs: DataFrame,
    row: str,
    text: str,
    block_bytes: int = BLOCK_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """row, pos, n (blocks of the row), sha and ``keep`` (on the first block), block."""
    flat = docs.select(F.col(row), *keep, normalised(F.col(text)).alias("flat"))
    flat = flat.select(
        row,
        *keep,
        F.sha2(F.col("flat"), 256).alias("sha"),
        F.encode("flat", "UTF-8").alias("flat"),
    )
    size = F.octet_length("flat")
    flat = flat.withColumn(
        "n", F.greatest(F.lit(1), F.ceil(size / F.lit(block_bytes)).cast("int"))
    )
    parts = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.substring(F.col("flat"), i * block_bytes + 1, F.lit(block_bytes)),
    )
    cut = flat.select(row, *keep, "n", "sha", F.posexplode(parts).alias("pos", "block"))
    return cut.withColumns({c: F.when(F.col("pos") == 0, F.col(c)) for c in (*keep, "sha")})


def text_identities(
    docs: DataFrame,
    row: str,
    text: str,
    block_bytes: int = BLOCK_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """row, ``keep``, sha (of the normalised text), rounds, name: the identity of each text.

    ``docs`` is read once, so ``keep`` names what else is needed of it.
    """
    first = stored(
        sorted_names(
            blocks(docs, row, text, block_bytes, keep),
            ["block"],
            [row, "pos", "n", "sha", *keep],
            {
                "lead": F.substring("block", 1, 16),
                "digest": F.xxhash64("block"),
                "digest_2": F.xxhash64(F.lit("second"), "block"),
            },
        ),
        "blocks",
    )
    heads = first.where("pos = 0").select(
        row, *keep, "sha", "n", F.lit(0).alias("rounds"), "name"
    )
    most = heads.agg(F.max("n")).first()[0] or 1
    ended = None
    current = first.where("n > 1").select(row, "pos", "n", "name")
    for rounds in range(1, levels_for(most) + 1):
        pairs = current.groupBy(row, F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left_name"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("right_name"),
            F.ceil(F.max("n") / 2).cast("int").alias("n"),
        )
        current = stored(
            sorted_names(pairs, ["left_name", "right_name"], [row, "pos", "n"]), "pairs"
        )
        done = current.where("n = 1").select(row, F.lit(rounds).alias("rounds"), "name")
        ended = done if ended is None else ended.unionByName(done)
        current = current.where("n > 1")
    if ended is None:
        return heads.drop("n")
    long = heads.where("n > 1").select(row, *keep, "sha").join(ended, row)
    return heads.where("n = 1").drop("n").unionByName(long)


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    row_column: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space became a space.
    Null counts as the empty text, and empty texts are equal to each other. Of
    equal texts the row with the smallest id stays; a null id stays only where
    no equal text has one. Rows repeated with the same id are rows of their own,
    and one of them stays. ``docs`` may be empty and may hold any other columns.
    With ``row_column`` the row numbers of ``docs`` are kept in the result.
    """
    row = row_column or fresh(docs.columns, "row_no")
    numbered = docs if row_column else with_row_id(docs, row)
    ids = numbered.select(
        F.col(row).alias("row_no"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text_"),
    )
    members = stored(
        text_identities(ids, "row_no", "text_", block_bytes, ("doc_id",)), "identities"
    )
    rank = F.coalesce("doc_id", F.lit(2**63 - 1))
    # Stored, so that the join below shuffles both sides and a hot group can be split.
    groups = stored(
        members.groupBy("rounds", "name").agg(
            F.min("doc_id").alias("keep_id"),
            F.count(F.lit(1)).alias("group_size"),
            F.min_by("row_no", rank).alias("keep_row"),
        ),
        "groups",
    )
    result = members.join(groups, ["rounds", "name"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_no") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.col("row_no").alias(row_column or "row_no"),
    )
    return result if row_column else result.drop("row_no")


def deduplicated(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scanned: bool = False
) -> DataFrame:
    """``docs`` without the rows whose text an earlier row has; columns unchanged.

    ``scanned`` says that ``docs`` is the direct read of files, so that its rows can be
    numbered by their places in the scan and nothing is copied.
    """
    row = fresh([*docs.columns, "doc_id", "kept"], "row_no")
    numbered = numbered_rows(docs, row, scanned)
    found = exact_duplicates(numbered, id_column, text_column, row)
    dropped = stored(found.where("NOT kept").select(row), "dropped")
    return numbered.join(dropped, row, "left_anti").drop(row)
