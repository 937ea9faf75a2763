"""Packing token pieces into windows by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows and a rest; the rest is cut into
pieces of a bounded length. Pieces are dealt over blocks of a bounded number of
rows by a hash of their document, and each block is packed on its own.

In a block every piece starts as a partial partition of k windows that holds the
piece in one of them. The two partial partitions with the largest difference
between their fullest and emptiest window are merged, the fullest windows of one
onto the emptiest of the other, until one partition is left. Where a window of it
holds more than the capacity, the block is packed again with one window more.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import fresh, stored, with_row_id

WINDOW = 2048
PIECE = 512
END_ID = 1
BLOCK_ROWS = 1024

PIECES = (
    "row_no long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
)
PLACED = f"{PIECES}, sequence_id long, offset long"

_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """The ids of a tokenizer file, those of the file's own library.

    The file's merges rank by id, so a byte-level encoder with these ranks gives the
    same ids in a third of the time. Only a text that spells out one of the file's added
    tokens is given to the library itself, which reads them as such; with
    ``special_as_text`` they are text like any other.
    """

    def __init__(self, path: str, fast, special: set[str]):
        from tokenizers import Tokenizer

        self.fast, self.library = fast, Tokenizer.from_file(path)
        self.special = re.compile("|".join(map(re.escape, sorted(special)))) if special else None

    def ids(self, text: str, special_as_text: bool = False) -> list[int]:
        if special_as_text or self.special is None or not self.special.search(text):
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids


def encoder(path: str) -> Encoder:
    """The byte-level BPE of a tokenizer file, read once per worker process."""
    if path not in _ENCODERS:
        import tiktoken

        with open(path, encoding="utf-8") as handle:
            spec = json.load(handle)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        # Byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {
            bytes(byte[c] for c in word): rank
            for word, rank in spec["model"]["vocab"].items()
            if word not in special
        }
        import public_tokenizers

        fast = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        _ENCODERS[path] = Encoder(path, fast, special)
    return _ENCODERS[path]


def cuts(length: int, window: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: full windows, then near-equal parts of the rest."""
    full = length // window
    out = [(i * window, window) for i in range(full)]
    rest = length - full * window
    if rest:
        parts = -(-rest // piece)
        edges = [full * window + rest * i // parts for i in range(parts + 1)]
        out += [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return out


def _cutter(path: str, window: int, piece: int, end_id: int, special_as_text: bool):
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path).ids
        for frame in frames:
            rows = []
            for row_no, doc_id, text in zip(
                frame["row_no"], frame["doc_id"], frame["text"], strict=True
            ):
                ids = encode(text if isinstance(text, str) else "", special_as_text)
                ids.append(end_id)
                data = memoryview(np.array(ids, dtype="<u4").tobytes())
                for start, length in cuts(len(ids), window, piece):
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    rows.append((row_no, doc_id, start, length, crc, len(ids)))
            out = pd.DataFrame(
                rows,
                columns=["row_no", "doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
            yield out

    return cut


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    row: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    piece: int = PIECE,
    end_id: int = END_ID,
    special_as_text: bool = False,
) -> DataFrame:
    """Pieces of every document, the end id in the last one."""
    slim = docs.select(
        F.col(row).alias("row_no"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    return slim.mapInPandas(_cutter(tokenizer_path, window, piece, end_id, special_as_text), PIECES)


def difference(lengths: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: items of each window, windows in order of falling load.

    A partial partition is kept as its loaded windows only, in falling order.
    """
    loads = [np.array([n], dtype=np.int64) for n in lengths]
    nodes = [np.array([i], dtype=np.int64) for i in range(len(lengths))]
    children: list[tuple[int, int]] = []
    base = len(lengths)
    heap = [(-n if windows > 1 else 0, i) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        if len(loads[a]) < len(loads[b]):
            a, b = b, a
        load, node = loads[a], nodes[a]
        other, other_node = loads[b], nodes[b]
        clash = len(load) + len(other) - windows
        if clash > 0:
            # Windows of b in falling order lie on the windows of a in rising order: its
            # largest go to empty windows, the others onto a's least loaded, last first.
            free = len(other) - clash
            meets = np.arange(len(load) - 1, len(load) - 1 - clash, -1)
            load, node = load.copy(), node.copy()
            load[meets] += other[free:]
            fresh_nodes = base + len(children) + np.arange(clash)
            children.extend(
                zip(node[meets].tolist(), other_node[free:].tolist(), strict=True)
            )
            node[meets] = fresh_nodes
            other, other_node = other[:free], other_node[:free]
        load = np.concatenate([load, other])
        node = np.concatenate([node, other_node])
        order = np.argsort(-load, kind="stable")
        loads[a], nodes[a] = load[order], node[order]
        loads[b] = nodes[b] = None
        low = loads[a][-1] if len(load) == windows else 0
        heapq.heappush(heap, (-int(loads[a][0] - low), a))
    if not heap:
        return []
    out = []
    for top in nodes[heap[0][1]].tolist():
        stack, members = [top], []
        while stack:
            x = stack.pop()
            if x < base:
                members.append(x)
            else:
                stack.extend(children[x - base])
        out.append(members)
    return out


def windows_for(lengths: list[int], capacity: int) -> list[list[int]]:
    """Difference with the fewest windows, rising until none is over capacity."""
    if not lengths:
        return []
    windows = -(-sum(lengths) // capacity)
    while True:
        packed = difference(lengths, windows)
        if max(sum(lengths[i] for i in members) for members in packed) <= capacity:
            return packed
        windows += 1


def _packer(window: int):
    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["row_no", "start"], kind="stable").reset_index(drop=True)
        lengths = frame["length"].to_numpy()
        sequence = np.zeros(len(frame), dtype=np.int64)
        offset = np.zeros(len(frame), dtype=np.int64)
        full = np.flatnonzero(lengths == window)
        sequence[full] = np.arange(len(full))
        rest = np.flatnonzero(lengths != window)
        packed = windows_for(lengths[rest].tolist(), window)
        for number, members in enumerate(packed, len(full)):
            at = 0
            for i in sorted(members):
                sequence[rest[i]] = number
                offset[rest[i]] = at
                at += lengths[rest[i]]
        frame["sequence_id"] = (int(key[0]) << 32) + sequence
        frame["offset"] = offset
        frame["doc_id"] = pd.array(frame["doc_id"], dtype="Int64")
        return frame.drop(columns="block")

    return pack


def packed(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    piece: int = PIECE,
    end_id: int = END_ID,
    block_rows: int = BLOCK_ROWS,
    special_as_text: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A further column, document_row, is the same for all pieces of one row of ``docs``: it
    tells copies of a document apart.

    Ids are those the tokenizer file's library gives; a text that spells out one of the
    file's special tokens has that token's id there, unless ``special_as_text`` is set.
    Null and empty texts have one id, the end id. Repeated rows and repeated or
    null ids are documents of their own. A block holds about ``block_rows``
    pieces; it is the only thing packed in one task, and the number of blocks
    grows with the pieces. Empty input gives no rows; other columns are ignored.
    """
    row = fresh(docs.columns, "row_no")
    cut = stored(
        pieces(
            with_row_id(docs, row),
            tokenizer_path,
            row,
            id_column,
            text_column,
            window,
            piece,
            end_id,
            special_as_text,
        ),
        "pieces",
    )
    blocks = max(1, -(-cut.count() // block_rows))
    # Full windows of one long document are dealt by their start, so that no block
    # grows with a document; a rest stays together.
    dealt = F.xxhash64("row_no", F.expr(f"IF(length = {window}, start, -1)"))
    cut = cut.withColumn("block", F.pmod(dealt, F.lit(blocks)))
    placed = cut.groupBy("block").applyInPandas(_packer(window), PLACED)
    return placed.withColumnRenamed("row_no", "document_row")
