"""Filter interaction audit: what quality filters remove alone, together and in every order.

A table-driven byte transducer reads the UTF-8 bytes of a batch of texts once. Its
alphabet is five byte classes, its states are "between words" and "inside a word",
and its output table says for a state and a class whether a word begins or ends and
whether the byte is a capital, a symbol or goes on with a code point. The state after
a byte follows from the byte's class alone, so the states of a batch are one lookup,
and documents are kept apart by setting the state at their first bytes.

The word spans it gives out go into one open-addressing hash table for the batch. A
span that finds its slot taken is compared with the owner byte by byte, in words of
eight bytes: equal spans are the same word, others move on to the next slot. So equal
hashes of different words never merge, and no word is copied out of the buffer.

What leaves a document is its counts and the digest of its text. Everything after
that is grouping: failures become a mask per document, documents are counted per part
and mask, and the orders of the filters are played through on these few counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import stored

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
SYMBOLS = b"#$%&*|"

# Byte classes of the transducer's alphabet.
SPACE, CAPITAL, SYMBOL, LEAD, CONTINUES = range(5)
BETWEEN, INSIDE = range(2)
# Bits of its output.
BEGINS, ENDS, IS_CAPITAL, IS_SYMBOL, GOES_ON = 1, 2, 4, 8, 16


def _classes() -> np.ndarray:
    table = np.full(256, LEAD, dtype=np.uint8)
    table[list(b" \t\n\x0b\x0c\r")] = SPACE
    table[ord("A") : ord("Z") + 1] = CAPITAL
    table[list(SYMBOLS)] = SYMBOL
    table[0x80:0xC0] = CONTINUES
    return table


def _outputs() -> np.ndarray:
    table = np.zeros((2, 5), dtype=np.uint8)
    table[BETWEEN, SPACE + 1 :] |= BEGINS
    table[INSIDE, SPACE] |= ENDS
    table[:, CAPITAL] |= IS_CAPITAL
    table[:, SYMBOL] |= IS_SYMBOL
    table[:, CONTINUES] |= GOES_ON
    return table


CLASS_OF = _classes()
NEXT_STATE = np.array([BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE], dtype=np.uint8)
OUTPUT = _outputs()

_ODD = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(29)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


class WordTable:
    """Open-addressing table of word spans of one buffer, told apart by document."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, doc: np.ndarray):
        padded = np.zeros(len(data) + 8, dtype=np.uint8)
        padded[: len(data)] = data
        # The eight bytes from every place of the buffer.
        self.eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        self.begins, self.sizes, self.doc = begins, sizes, doc

    def part(self, spans: np.ndarray, number: int) -> np.ndarray:
        """Bytes ``8 * number`` on of the spans, zero past their ends."""
        left = np.minimum(self.sizes[spans] - 8 * number, 8)
        return self.eights[self.begins[spans] + 8 * number] & _LOW_BYTES[left]

    def hashes(self) -> np.ndarray:
        value = self.doc.astype(np.uint64) * _ODD + self.sizes.astype(np.uint64)
        spans, number = np.arange(len(self.sizes)), 0
        while len(spans):
            mixed = (value[spans] ^ self.part(spans, number)) * _ODD
            value[spans] = mixed ^ (mixed >> _FOLD)
            number += 1
            spans = spans[self.sizes[spans] > 8 * number]
        return value

    def equal(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether spans are the same bytes of the same document."""
        same = (self.doc[left] == self.doc[right]) & (self.sizes[left] == self.sizes[right])
        at, number = np.flatnonzero(same), 0
        while len(at):
            differ = self.part(left[at], number) != self.part(right[at], number)
            same[at[differ]] = False
            number += 1
            at = at[~differ & (self.sizes[left[at]] > 8 * number)]
        return same

    def distinct(self, docs: int, slots: int | None = None) -> np.ndarray:
        """Distinct words of every document."""
        found = np.zeros(docs, dtype=np.int64)
        size = slots or 1 << max(1, int(2 * len(self.sizes)).bit_length())
        table = np.full(size, -1, dtype=np.int64)
        slot = (self.hashes() & np.uint64(size - 1)).astype(np.int64)
        waiting = np.arange(len(self.sizes))
        while len(waiting):
            at = slot[waiting]
            free = table[at] < 0
            table[at[free]] = waiting[free]
            owner = table[at]
            new = owner == waiting
            found += np.bincount(self.doc[waiting[new]], minlength=docs)
            known = ~new
            known[known] = self.equal(waiting[known], owner[known])
            waiting = waiting[~new & ~known]
            slot[waiting] = (slot[waiting] + 1) & (size - 1)
        return found


def transduce(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of every document of a buffer; document i is ``data[offsets[i]:offsets[i + 1]]``."""
    docs = len(offsets) - 1
    starts, ends = offsets[:-1], offsets[1:]
    classes = CLASS_OF[data]
    after = NEXT_STATE[classes]
    state = np.empty_like(after)
    state[1:] = after[:-1]
    state[starts[starts < len(data)]] = BETWEEN
    out = OUTPUT[state, classes]

    def per_doc(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(places, ends) - np.searchsorted(places, starts)

    begins = np.flatnonzero(out & BEGINS)
    closing = np.zeros(len(data) + 1, dtype=bool)
    closing[:-1] = out & ENDS
    # A word that is open where its document ends, ends there.
    last = ends[ends > starts]
    closing[last[after[last - 1] == INSIDE]] = True
    sizes = np.flatnonzero(closing) - begins
    words = per_doc(begins)
    spans = WordTable(data, begins, sizes, np.repeat(np.arange(docs), words))
    return {
        "words": words,
        "distinct_words": spans.distinct(docs),
        "capitals": per_doc(np.flatnonzero(out & IS_CAPITAL)),
        "symbols": per_doc(np.flatnonzero(out & IS_SYMBOL)),
        "code_points": ends - starts - per_doc(np.flatnonzero(out & GOES_ON)),
    }


COUNTS = ("words", "distinct_words", "capitals", "symbols", "code_points")


def _profiler(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
            _, offsets, data = text.buffers()
            offsets = np.frombuffer(offsets, dtype=np.int64)[text.offset :][: batch.num_rows + 1]
            size = int(offsets[-1] - offsets[0])
            view = np.frombuffer(data or b"", dtype=np.uint8)[offsets[0] : offsets[0] + size]
            found = transduce(view, offsets - offsets[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(found[c], pa.int64()) for c in COUNTS],
                names=[*keep, *COUNTS],
            )

    return run


def profiles(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "lang",
) -> DataFrame:
    """doc_id, part, digest (sha256 of the text) and the counts of every row of ``docs``.

    Null texts count as empty, a null part is the empty string.
    """
    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    ).select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return slim.mapInArrow(
        _profiler(["doc_id", "part", "digest"]),
        f"doc_id long, part string, digest binary, {counts}",
    )


def failures(found: DataFrame) -> DataFrame:
    """``found`` with ``mask``: one bit for each filter that the document fails.

    A document repeats an earlier one if a smaller id has the same text; a null id is
    neither smaller nor larger than another. The first ids are joined back on text and
    id, so that a text which many documents share is no hot key.
    """
    firsts = found.where("doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id")
    )
    marked = found.join(firsts.withColumn("is_first", F.lit(True)), ["digest", "doc_id"], "left")
    conditions = [
        F.col("words") < LEAST_WORDS,
        100 * F.col("distinct_words") < LEAST_DISTINCT_PERCENT * F.col("words"),
        100 * F.col("capitals") > MOST_CAPITALS_PERCENT * F.col("code_points"),
        F.col("symbols") > 0,
        F.col("doc_id").isNotNull() & F.col("is_first").isNull(),
    ]
    mask = F.lit(0)
    for place, fails in enumerate(conditions):
        mask = mask + F.when(fails, 1 << place).otherwise(0)
    return marked.select(*found.columns, mask.alias("mask"))


def interactions(cells: DataFrame) -> DataFrame:
    """Every order of the filters played through on counts per part and mask.

    ``cells``: part, mask, documents, good, toxic; one row per part and mask at most.
    """
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    steps = cells.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders)))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )

    bits = F.create_map(*[F.lit(x) for i, c in enumerate(FILTERS) for x in (c, 1 << i)])

    def bit(place: Column) -> Column:
        letter = F.substring("filter_order", place, F.lit(1))
        return F.element_at(bits, letter)

    before = F.lit(0)
    for place in range(1, len(FILTERS)):
        before = before + F.when(F.col("step") > place, bit(F.lit(place))).otherwise(0)
    steps = steps.withColumns({"own": bit(F.col("step")), "before": before})
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0

    def total(condition: Column, column: str, name: str) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(F.lit(0))).cast("long").alias(name)

    played = steps.groupBy("part", "filter_order", "step", "own").agg(
        total(~gone & ~fails, "documents", "kept"),
        total(~gone & fails, "documents", "removed"),
        total(gone & fails, "documents", "redundant"),
        total(F.col("mask") == F.col("own"), "documents", "unique_fails"),
        total(~gone & fails, "good", "good_lost"),
        total(~gone & fails, "toxic", "toxic_lost"),
    )
    # A filter stands once in every order: a window holds as many rows as there are orders.
    shapley = F.sum("removed").over(Window.partitionBy("part", "own"))
    return played.withColumn("shapley", shapley).drop("own")


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "lang",
) -> DataFrame:
    """One row per part, order of the five filters and step, with counts of documents.

    Filters: A under 200 words, B under half of the words distinct, C over 3 % of the
    code points capitals, D a symbol of ``#$%&*|``, E the text of a smaller id again.
    A null text is empty (it fails A and, with a smaller empty one, E); a null part is
    the empty string. Rows that repeat an id are rows of their own, and equal ids do
    not make each other fail E. Labels are joined by id; a label row may be repeated,
    and any that says 1 counts. An empty table has no part, so it gives no row.
    """
    masked = failures(stored(profiles(docs, id_column, text_column, part_column), "profiles"))
    marks = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).cast("int").alias("good_doc"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).cast("int").alias("toxic_doc"),
        )
    )
    cells = masked.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum("good_doc"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic_doc"), F.lit(0)).alias("toxic"),
    )
    return interactions(cells)
