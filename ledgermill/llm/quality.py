"""Quality classifier: supervised subword embeddings with a softmax output.

A document is the average of learned vectors of its hashed words, word pairs and
byte n-grams inside words; a softmax over two classes reads the average. Vectors
and output are trained together by stochastic gradient descent in numpy, on a
bounded sample of labelled documents that arrive as sparse bags of buckets.

The output is linear in the average, so scoring needs one number per bucket: the
bucket's vector times the difference of the two output rows. That table has a
fixed size and is what tasks receive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import fresh, quoted

# At most 16, as bucket numbers travel as two bytes.
BUCKET_BITS = 16
WIDTH = 8
SAMPLE_ROWS = 3000
EPOCHS = 6
RATE = 0.5
THRESHOLD = 0.3

# A long text is read in parts, so arrays stay small.
PART_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SALTS = [np.uint64(s) for s in (0x51ED270B, 0x8F1BBCDC5, 0xCA62C1D6A1, 0x6ED9EBA1F3)]
_POWERS: list[np.ndarray] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and their inverses modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < size:
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        count = max(size, 1 << 14)
        _POWERS[:] = [
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(count - 1, base, dtype=np.uint64))])
            for base in (_P, inverse)
        ]
    return _POWERS[0][:size], _POWERS[1][:size]


def _bucket(hashes: np.ndarray, salt: int, bits: int) -> np.ndarray:
    mixed = (hashes ^ _SALTS[salt]) * _MIX
    mixed ^= mixed >> np.uint64(32)
    return ((mixed * _P) >> np.uint64(64 - bits)).astype(np.int64)


def buckets(text: str | None, bits: int = BUCKET_BITS) -> Iterator[np.ndarray]:
    """Arrays of bucket numbers of a text: words, pairs of words, 3- and 4-byte n-grams.

    A long text is read in parts; what crosses their borders is carried over: the last
    three bytes, the hash of a word that goes on, and the last whole word for the pair.
    """
    if not text:
        return
    data = text.encode("utf-8", "surrogatepass") + b" "
    tail = np.array([32], dtype=np.uint64)
    open_hash, open_size = np.uint64(0), 0
    last_word = np.zeros(0, dtype=np.uint64)
    shift = np.uint64(8)
    for start in range(0, len(data), PART_BYTES):
        raw = np.frombuffer(data, dtype=np.uint8)[start : start + PART_BYTES]
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        codes = np.where(space, np.uint8(32), raw).astype(np.uint64)
        before = np.concatenate([[open_size == 0], space[:-1]])
        starts = np.flatnonzero(~space & before)
        ends = np.flatnonzero(space & ~before)
        up, down = _powers(len(raw) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * up[:-1])])
        if open_size:
            # The word that was open goes on to its end, or through the whole part.
            size = int(ends[0]) if len(ends) else len(raw)
            power = np.uint64(pow(int(_P), open_size, 1 << 64))
            carried = open_hash + sums[size : size + 1] * power
            open_size += size
            first = carried if len(ends) else carried[:0]
            open_hash = carried[0]
            ends = ends[1:]
        else:
            first = np.zeros(0, dtype=np.uint64)
        whole = starts[: len(ends)]
        words = np.concatenate([first, (sums[ends] - sums[whole]) * down[whole]])
        if len(starts) > len(ends):
            at = int(starts[-1])
            open_hash = ((sums[-1:] - sums[at : at + 1]) * down[at : at + 1])[0]
            open_size = len(raw) - at
        elif len(first) or len(ends):
            open_size = 0
        yield _bucket(words, 0, bits)
        paired = np.concatenate([last_word, words])
        if len(paired) > 1:
            pairs = paired[:-1] * _P + paired[1:]
            # A word that follows itself is one event, whichever word it is.
            yield _bucket(np.where(paired[:-1] == paired[1:], np.uint64(1), pairs), 1, bits)
        last_word = paired[-1:]
        # N-grams that end in this part.
        codes = np.concatenate([tail, codes])
        inner = codes != 32
        known = len(tail)
        tail = codes[-3:]
        if len(codes) < 3:
            continue
        three = (((codes[:-2] << shift) | codes[1:-1]) << shift) | codes[2:]
        new = max(0, known - 2)
        yield _bucket(three[new:][inner[1:-1][new:]], 2, bits)
        if len(codes) > 3:
            four = (three[:-1] << shift) | codes[3:]
            yield _bucket(four[inner[1:-2] & inner[2:-1]], 3, bits)


@dataclass
class Model:
    """One number per bucket and the offset of the log odds of class 1."""

    table: np.ndarray
    offset: float
    bits: int = BUCKET_BITS

    def score(self, text: str | None) -> float:
        total, count = 0.0, 0
        for found in buckets(text, self.bits):
            total += float(self.table[found].sum(dtype=np.float64))
            count += len(found)
        odds = self.offset + (total / count if count else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30))))


def train(
    bags: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    bits: int = BUCKET_BITS,
    width: int = WIDTH,
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = 42,
) -> Model:
    """Stochastic gradient descent over (bucket numbers, counts) bags, one document a step.

    Without rows, or with one class only, the score is the class share.
    """
    share = float((labels.sum() + 0.5) / (len(labels) + 1))
    prior = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(1 << bits, dtype=np.float32), prior, bits)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32)
    output = rng.uniform(-1, 1, (width, 2)).astype(np.float32)
    bias = np.array([0.0, prior], dtype=np.float32)
    steps, step = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            ids, counts = bags[i]
            now = rate * (1 - step / steps)
            step += 1
            if not len(ids):
                continue
            weights = counts.astype(np.float32) / counts.sum()
            rows = vectors[ids]
            hidden = weights @ rows
            logits = hidden @ output + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[int(labels[i])] -= 1
            back = output @ error
            output -= now * np.outer(hidden, error)
            bias -= 0.1 * now * error
            # Weights are shares of a document; scaled up as a bag has thousands of buckets.
            vectors[ids] = rows - now * 50.0 * weights[:, None] * back
    table = vectors @ (output[:, 1] - output[:, 0])
    return Model(table.astype(np.float32), float(bias[1] - bias[0]), bits)


def training_rows(
    labels: DataFrame, label: str, modulus: int, left_out: int, rows: int, id_column: str = "doc_id"
) -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out remainder, in hash order: id, label.

    Null ids and labels other than 0 and 1 are left out; an id labelled twice has
    its larger label.
    """
    usable = labels.select(
        F.col(id_column).cast("long").alias("label_id"), F.col(label).cast("int").alias("label")
    ).where("label_id IS NOT NULL AND label IN (0, 1)")
    usable = usable.where(remainder(F.col("label_id"), modulus) != left_out)
    return (
        usable.groupBy("label_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(rows)
    )


def remainder(identity: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id has remainder 0 of ''."""
    return F.pmod(
        F.crc32(F.coalesce(identity.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)
    )


def _bagger(bits: int):
    def bag(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, counts = [], []
            for text in frame["text"]:
                total = np.zeros(1 << bits, dtype=np.int64)
                for found in buckets(text if isinstance(text, str) else None, bits):
                    total += np.bincount(found, minlength=1 << bits)
                used = np.flatnonzero(total)
                ids.append(used.astype("<u2").tobytes())
                counts.append(total[used].astype("<u4").tobytes())
            yield pd.DataFrame({"label": frame["label"], "ids": ids, "counts": counts})

    return bag


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    modulus: int = 5,
    left_out: int = 0,
    rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
    bits: int = BUCKET_BITS,
) -> Model:
    """Model learned from at most ``rows`` labelled documents.

    The sample reaches the driver as bags of at most 2^bits buckets a row.
    """
    chosen = training_rows(labels, label, modulus, left_out, rows)
    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    # The sample has a fixed number of ids, and of rows that share one, one text is read.
    sample = (
        slim.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
    bags = sample.mapInPandas(_bagger(bits), "label int, ids binary, counts binary")
    found = bags.toPandas()
    found = found.sort_values(["label", "ids", "counts"], kind="stable")
    # Views of the collected bytes: six bytes a bucket and no copies on the driver.
    read = [
        (np.frombuffer(i, "<u2"), np.frombuffer(c, "<u4"))
        for i, c in zip(found["ids"], found["counts"], strict=True)
    ]
    return train(read, found["label"].to_numpy(dtype=np.int64), bits)


def scored(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``; null texts score as empty ones."""
    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for frame in frames:
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "score": [
                        known.score(t if isinstance(t, str) else None) for t in frame["text"]
                    ],
                }
            )

    return slim.mapInPandas(run, "doc_id long, score double")


def quality(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    modulus: int = 5,
    left_out: int = 0,
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Empty, blank and null texts get the model's offset as their score. Repeated
    rows have equal scores. Without usable labels every score is the same share.
    An empty table gives no rows; other columns are ignored.
    """
    model = fit(docs, labels, "quality", modulus, left_out, rows)
    found = scored(docs, model)
    return found.select(
        "doc_id",
        (remainder(F.col("doc_id"), modulus) == left_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    text_column: str = "text",
) -> DataFrame:
    """``docs`` without the rows the classifier rejects; columns unchanged."""
    model = fit(docs, labels, text_column=text_column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    score = fresh(docs.columns, "score")

    @F.pandas_udf("double")
    def score_of(texts: pd.Series) -> pd.Series:
        known = shared.value
        return pd.Series([known.score(t if isinstance(t, str) else None) for t in texts])

    return docs.withColumn(score, score_of(F.col(quoted(text_column)))).where(
        F.col(score) >= threshold
    ).drop(score)
