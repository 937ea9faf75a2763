"""SimHash near-deduplication with pigeonring filtering.

A fingerprint of 64 bits is cut into five segments on a ring. If two fingerprints
differ in at most three bits, some segment starts a chain whose first l segments
differ in at most floor(l * 3 / 5) bits, for every l: 0, 1, 1, 2, 3. So the
starting segment is equal and, of the two after it, one at least is equal too.
Fingerprints meet on such pairs of equal segments, 25 or 26 bits; the chain's
budgets prune what meets, and the full distance is checked last.

Equal fingerprints are one node. Before pairs are looked for, every key's most
frequent fingerprint is linked to the others of that key in a star, and the stars
are joined to components; afterwards only pairs between different components are
kept. A dense cloud of near copies around one text thus gives links in proportion
to its size and not to its square, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import fresh, numbered_rows, stored, with_row_id
from ledgermill.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 5
# (first bit, width) of the segments of the ring.
RING = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
_CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a text: XXH64 of its word shingles, repeats included; 0 without words."""
    # bytes.lower() touches A-Z only and bytes.split() the six ASCII spaces only.
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = iter([b" ".join(tokens)])
        count = 1
    else:
        shingles = map(b" ".join, zip(*[tokens[i:] for i in range(words)], strict=False))
        count = len(tokens) - words + 1
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, count, _CHUNK):
        size = min(_CHUNK, count - start)
        hashes = np.fromiter(
            (digest(next(shingles), seed) for _ in range(size)), dtype="<u8", count=size
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1).sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * ones > count).view("<u8")[0])


def _fingerprinter(words: int, seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            prints = np.array(
                [fingerprint(t, words, seed) for t in frame["text"]], dtype=np.uint64
            )
            yield pd.DataFrame(
                {
                    "row_no": frame["row_no"],
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "print": prints.view(np.int64),
                }
            )

    return run


def _mask(segments: list[int]) -> int:
    bits = 0
    for s in segments:
        first, width = RING[s % SEGMENTS]
        bits |= ((1 << width) - 1) << first
    return bits - (1 << 64) if bits >> 63 else bits


def _segment(value: Column, number: int) -> Column:
    first, width = RING[number % SEGMENTS]
    return F.shiftrightunsigned(value, first).bitwiseAND(F.lit((1 << width) - 1))


def _keys(prints: DataFrame) -> DataFrame:
    """Ten rows per fingerprint: chain start, and the key of two equal segments of the chain."""
    value = F.col("print")
    keys = []
    for start in range(SEGMENTS):
        for step in (1, 2):
            kind = 2 * start + step - 1
            key = F.shiftleft(F.lit(kind).cast("long"), 32)
            key = key.bitwiseOR(F.shiftleft(_segment(value, start), 13))
            key = key.bitwiseOR(_segment(value, start + step))
            keys.append(F.struct(F.lit(start).alias("start"), key.alias("key")))
    return prints.select("*", F.explode(F.array(*keys)).alias("k")).select(
        *prints.columns, "k.start", "k.key"
    )


def _within(left: Column, right: Column, start: Column, max_bits: int) -> Column:
    """The chain from ``start`` keeps its budgets and the whole distance holds."""
    differing = left.bitwiseXOR(right)

    def chain(length: int) -> Column:
        masks = F.lit(_mask(list(range(length))))
        for s in range(1, SEGMENTS):
            masks = F.when(start == s, F.lit(_mask([s + j for j in range(length)]))).otherwise(
                masks
            )
        return F.bit_count(differing.bitwiseAND(masks)) <= max_bits * length // SEGMENTS

    return chain(3) & chain(4) & (F.bit_count(differing) <= max_bits)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``left, right`` that join the fingerprints of ``prints`` to their components.

    ``prints`` has one row per fingerprint: print, copies.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the ring's keys hold for at most 3 differing bits")
    keyed = _keys(prints)
    hubs = keyed.groupBy("key").agg(
        F.max_by("print", "copies").alias("hub"), F.count(F.lit(1)).alias("members")
    )
    stars = (
        keyed.join(hubs.where("members > 1"), "key")
        .where(F.col("print") != F.col("hub"))
        .where(_within(F.col("print"), F.col("hub"), F.col("start"), max_bits))
    )
    stars = stored(
        stars.select(F.col("print").alias("left"), F.col("hub").alias("right")).distinct(), "stars"
    )
    roots = components(stars)
    labelled = stored(
        prints.join(roots, F.col("print") == F.col("node"), "left").select(
            "print", F.coalesce("root", "print").alias("root")
        ),
        "labelled",
    )
    a, b = _keys(labelled).alias("a"), _keys(labelled).alias("b")
    pairs = a.join(
        b,
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.print") < F.col("b.print"))
        & (F.col("a.root") != F.col("b.root"))
        & _within(F.col("a.print"), F.col("b.print"), F.col("a.start"), max_bits),
    ).select(F.col("a.root").alias("left"), F.col("b.root").alias("right"))
    return stars.unionAll(stored(pairs.distinct(), "pairs"))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    row_column: str | None = None,
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    root_column: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other. ``component_id`` is the smallest id reachable over links; null ids
    count only where a component has no other. Repeated rows stay repeated.
    Empty input gives no rows; other columns are ignored. With ``row_column``
    the row numbers of ``docs`` are kept in the result, with ``root_column`` a
    fingerprint that names the component, as ids may be null or repeated.
    """
    row = row_column or fresh(docs.columns, "row_no")
    numbered = docs if row_column else with_row_id(docs, row)
    slim = numbered.select(
        F.col(row).alias("row_no"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
    )
    printed = stored(
        slim.mapInPandas(_fingerprinter(words, SEED), "row_no long, doc_id long, print long"),
        "prints",
    )
    prints = stored(
        printed.groupBy("print").agg(
            F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("smallest")
        ),
        "distinct-prints",
    )
    roots = components(links(prints, max_bits))
    rooted = stored(
        prints.join(roots, F.col("print") == F.col("node"), "left").select(
            "print", "smallest", F.coalesce("root", "print").alias("root")
        ),
        "rooted",
    )
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    classes = rooted.join(smallest, "root").select("print", "component_id", "root")
    return printed.join(classes, "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
        *([F.col("row_no").alias(row_column)] if row_column else []),
        *([F.col("root").alias(root_column)] if root_column else []),
    )


def one_per_group(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scanned: bool = False
) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, that of the smallest id.

    ``scanned`` says that ``docs`` is the direct read of files, so that its rows can be
    numbered by their places in the scan and nothing is copied.
    """
    taken = [*docs.columns, "doc_id", "component_id", "fingerprint"]
    row, root = fresh(taken, "row_no"), fresh(taken, "root")
    numbered = numbered_rows(docs, row, scanned)
    found = stored(
        near_duplicates(numbered, id_column, text_column, row, root_column=root),
        "near-duplicates",
    )
    best = found.groupBy(root).agg(
        F.min_by(row, F.coalesce("doc_id", F.lit(2**63 - 1))).alias("stays")
    )
    dropped = found.join(best, root).where(F.col(row) != F.col("stays"))
    dropped = stored(dropped.select(row), "dropped")
    return numbered.join(dropped, row, "left_anti").drop(row)
