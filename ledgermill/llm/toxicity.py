"""Toxicity: gradient-boosted trees over dense features with isotonic calibration.

The labelled sample is cut by hash into three parts. The first, a half, gives the
lexicon: words that are far more frequent in toxic documents. The second grows the trees
on the dense features below, the third fits the isotonic map from tree output to
probability. So no row is judged by a lexicon or a tree it helped to make.

Features of a document: density of lexicon words and of lexicon
stems, their number, density of words found only after obfuscation is undone, share of lexicon words near a word
of address, density of words of address, of capitals, of shouted words, of
punctuation, of exclamation marks, of words with signs or digits inside, of
stretched letters, and the number of words.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import stored
from ledgermill.llm.quality import remainder, training_rows

SAMPLE_ROWS = 12000
THRESHOLD = 0.7
LEXICON_WORDS = 4096
LEXICON_CONTEXTS = 6
LEXICON_SHARE = 0.03
LEXICON_ODDS = 3.0
STEMS = (4, 5)
NEAR_WORDS = 5
TREES = 40
DEPTH = 3
BINS = 32
RATE = 0.2

# Words of address in the languages of the corpus.
ADDRESS = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer sie tu te toi ton ta tes "
    "vous votre vos usted ustedes tú ti tus vosotros vuestro".split()
)

# Signs that stand for letters.
PLAIN = str.maketrans(
    {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
)

_WORD = re.compile(r"[^\W_]+")
_SIGNS_INSIDE = "0123456789@$!*._-"

# Character classes up to the end of Latin Extended-B; all above count as letters.
_TOP = 0x250
_SPACE, _LETTER, _CAPITAL, _SIGN, _DIGIT = range(5)
_CLASSES = np.array(
    [
        _SPACE
        if c.isspace()
        else _CAPITAL
        if c.isupper()
        else _LETTER
        if c.isalpha()
        else _DIGIT
        if c.isalnum()
        else _SIGN
        for c in map(chr, range(_TOP))
    ]
    + [_LETTER],
    dtype=np.uint8,
)
_INSIDE = np.array([c in _SIGNS_INSIDE for c in map(chr, range(_TOP))] + [False])
_PART_CHARS = 1 << 20
_STEP_CHARS = 256
_RUN = re.compile(r"\S*")

FEATURES = (
    "lexicon_density",
    "stem_density",
    "lexicon_words",
    "hidden_density",
    "near_address",
    "address_density",
    "capitals",
    "shouted",
    "signs",
    "exclamations",
    "masked",
    "stretched",
    "words",
)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def stems_of(word: str) -> list[str]:
    """Beginnings of a longer word, marked as such: a lexicon may hold them for all its forms."""
    return [f"{word[:n]}*" for n in STEMS if len(word) > n]


def unmasked(word: str) -> str:
    """A masked word with signs read as letters and the others taken out."""
    return "".join(_WORD.findall(word.lower().translate(PLAIN)))


def run_at(text: str, place: int) -> tuple[str, int]:
    """The whole run without white space around a place, and where it ends."""
    low = place
    while low:
        before = text[max(0, low - _STEP_CHARS) : low]
        size = _RUN.match(before[::-1]).end()
        low -= size
        if size < len(before):
            break
    end = _RUN.match(text, place).end()
    return text[low:end], end


def surface(text: str) -> tuple[np.ndarray, list[str]]:
    """Counts of capitals, shouted letters, signs, masked places and stretched letters.

    The second value holds the words around the masked places.
    """
    totals = np.zeros(5, dtype=np.int64)
    masked: list[str] = []
    for start in range(0, len(text), _PART_CHARS):
        # Two more characters, as a place is judged by three in a row.
        part = text[start : start + _PART_CHARS + 2]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        known = np.minimum(codes, _TOP)
        kinds = _CLASSES[known]
        capital = kinds == _CAPITAL
        own = min(len(codes), _PART_CHARS)
        totals[0] += np.count_nonzero(capital[:own])
        totals[2] += np.count_nonzero(kinds[:own] == _SIGN)
        if len(codes) < 3:
            continue
        letter = capital | (kinds == _LETTER)
        totals[1] += np.count_nonzero(capital[:-2] & capital[1:-1] & capital[2:])
        odd = letter[:-2] & _INSIDE[known[1:-1]] & letter[2:]
        if odd.any():
            places = np.flatnonzero(odd) + 1
            totals[3] += len(places)
            # Places of one run of signs without a space belong to one word.
            end, word = -1, ""
            for place in places.tolist():
                if start + place >= end:
                    word, end = run_at(text, start + place)
                masked.append(word)
        equal = codes[1:] == codes[:-1]
        totals[4] += np.count_nonzero(equal[1:] & equal[:-1] & letter[2:])
    return totals, masked


def features(text: str | None, lexicon: frozenset[str]) -> list[float]:
    """The dense features of a text; all zero for null, empty and blank texts."""
    if not text:
        return [0.0] * len(FEATURES)
    words = words_of(text)
    count = max(1, len(words))
    size = max(1, len(text))
    hits, forms, near, address = 0, 0, 0, 0
    distinct = set(words)
    if not ADDRESS.isdisjoint(distinct):
        spoken = [i for i, w in enumerate(words) if w in ADDRESS]
        address = len(spoken)
    known = lexicon.intersection(distinct)
    formed = {w for w in distinct if not lexicon.isdisjoint(stems_of(w))}
    if known or formed:
        at = [i for i, w in enumerate(words) if w in known or w in formed]
        hits = sum(words[i] in known for i in at)
        forms = len(at)
        if address:
            near = sum(
                bisect_right(spoken, i + NEAR_WORDS) > bisect_left(spoken, i - NEAR_WORDS)
                for i in at
            )
    (capitals, shouted, signs, places, stretched), masked = surface(text)
    hidden = sum(unmasked(w) in lexicon for w in masked)
    return [
        hits / count,
        forms / count,
        float(min(forms, 20)),
        hidden / count,
        near / max(1, forms),
        address / count,
        capitals / size,
        shouted / size,
        signs / size,
        text.count("!") / size,
        places / count,
        stretched / count,
        float(np.log1p(len(words))),
    ]


@dataclass
class Forest:
    """Boosted regression trees on binned features; nodes as (feature, bin, left, right, value)."""

    edges: list[np.ndarray]
    base: float
    trees: list[np.ndarray] = field(default_factory=list)

    def binned(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(rows.shape, dtype=np.int64)
        for j, edge in enumerate(self.edges):
            out[:, j] = np.searchsorted(edge, rows[:, j], side="left")
        return out

    def raw(self, binned: np.ndarray) -> np.ndarray:
        total = np.full(len(binned), self.base)
        for tree in self.trees:
            total += tree_values(tree, binned)
        return total


def tree_values(tree: np.ndarray, binned: np.ndarray) -> np.ndarray:
    at = np.zeros(len(binned), dtype=np.int64)
    for _ in range(DEPTH):
        feature = tree[at, 0].astype(np.int64)
        inner = feature >= 0
        low = binned[np.arange(len(binned)), np.maximum(feature, 0)] <= tree[at, 1]
        after = np.where(low, tree[at, 2], tree[at, 3]).astype(np.int64)
        at = np.where(inner, after, at)
    return tree[at, 4]


def grow_tree(binned: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """One tree of DEPTH by second-order gain, with histograms of BINS."""
    nodes: list[list[float]] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        place = len(nodes)
        g, h = slope[rows].sum(), curve[rows].sum()
        nodes.append([-1, 0, 0, 0, -RATE * g / (h + 1.0)])
        if depth == DEPTH or len(rows) < 20:
            return place
        best = (1e-6, -1, 0)
        for j in range(binned.shape[1]):
            column = binned[rows, j]
            left_g = np.cumsum(np.bincount(column, slope[rows], BINS + 1))[:-1]
            left_h = np.cumsum(np.bincount(column, curve[rows], BINS + 1))[:-1]
            gain = (
                left_g**2 / (left_h + 1.0)
                + (g - left_g) ** 2 / (h - left_h + 1.0)
                - g**2 / (h + 1.0)
            )
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), j, k)
        if best[1] < 0:
            return place
        low = binned[rows, best[1]] <= best[2]
        if low.all() or not low.any():
            return place
        left = grow(rows[low], depth + 1)
        right = grow(rows[~low], depth + 1)
        nodes[place][:4] = [best[1], best[2], left, right]
        return place

    grow(np.arange(len(binned)), 0)
    return np.array(nodes)


def boost(rows: np.ndarray, labels: np.ndarray, trees: int = TREES) -> Forest:
    """Boosting on the logistic loss."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = []
    for j in range(rows.shape[1]):
        known = rows[:, j]
        # Zero is a value of its own: most features are zero in most documents.
        some = known[known > 0]
        cuts = np.quantile(some, shares) if len(some) else np.zeros(0)
        edges.append(np.unique(np.concatenate([[0.0], cuts]))[: BINS - 1])
    forest = Forest(edges, float(np.log(share / (1 - share))))
    if not len(labels) or labels.min() == labels.max():
        return forest
    binned = forest.binned(rows)
    raw = forest.raw(binned)
    for _ in range(trees):
        odds = 1 / (1 + np.exp(-raw))
        tree = grow_tree(binned, odds - labels, odds * (1 - odds))
        forest.trees.append(tree)
        raw += tree_values(tree, binned)
    return forest


def isotonic(raw: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising steps (raw value, probability)."""
    values, place = np.unique(raw, return_inverse=True)
    weight = np.bincount(place).astype(float)
    total = np.bincount(place, labels)
    pools: list[list[float]] = []
    for value, w, t in zip(values, weight, total, strict=True):
        pools.append([value, value, w, t])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            low, high = pools[-2], pools.pop()
            low[1] = high[1]
            low[2] += high[2]
            low[3] += high[3]
    x = [v for p in pools for v in (p[0], p[1])]
    y = [p[3] / p[2] for p in pools for _ in (0, 1)]
    return np.array(x), np.array(y)


@dataclass
class Model:
    lexicon: frozenset[str]
    forest: Forest
    steps: np.ndarray
    chances: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        rows = np.array([features(t, self.lexicon) for t in texts])
        raw = self.forest.raw(self.forest.binned(rows))
        if not len(self.steps):
            return 1 / (1 + np.exp(-raw))
        return np.interp(raw, self.steps, self.chances)


def word_contexts(text: str) -> set[tuple[str, str]]:
    """Distinct pairs of a word, or of its stems, and the word before it."""
    words = words_of(text)
    pairs = set(zip(words, ["", *words[:-1]], strict=True))
    return pairs | {(stem, before) for word, before in pairs for stem in stems_of(word)}


def lexicon_of(sample: DataFrame) -> frozenset[str]:
    """Words far more frequent in toxic texts of the sample; at most LEXICON_WORDS.

    A word counts once for every word that stands before it, so a passage that is
    copied over many documents counts once.
    """

    def distinct(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                (word, before, label)
                for text, label in zip(frame["text"], frame["label"], strict=True)
                for word, before in sorted(word_contexts(text if isinstance(text, str) else ""))
            ]
            yield pd.DataFrame(rows, columns=["word", "before", "label"])

    sizes = sample.groupBy("label").count().collect()
    of = {r["label"]: r["count"] for r in sizes}
    if not of.get(1) or not of.get(0):
        return frozenset()
    found = (
        sample.select("text", "label")
        .mapInPandas(distinct, "word string, before string, label int")
        .groupBy("word", "before")
        .agg(F.max("label").alias("toxic"), F.max(F.lit(1) - F.col("label")).alias("clean"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= max(LEXICON_CONTEXTS, LEXICON_SHARE * of[1]))
        .withColumn(
            "odds",
            F.log((F.col("toxic") + 0.5) / (of[1] + 1))
            - F.log((F.col("clean") + 0.5) / (of[0] + 1)),
        )
        .where(F.col("odds") >= LEXICON_ODDS)
        .orderBy((F.col("odds") * F.sqrt("toxic")).desc(), "word")
        .limit(LEXICON_WORDS)
    )
    return frozenset(r["word"] for r in found.collect())


def feature_rows(sample: DataFrame, lexicon: frozenset[str]) -> pd.DataFrame:
    """Features of the sampled documents, one row per sampled id."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "part": frame["part"],
                    "label": frame["label"],
                    "row": [
                        features(t if isinstance(t, str) else None, lexicon)
                        for t in frame["text"]
                    ],
                }
            )

    found = sample.mapInPandas(run, "doc_id long, part int, label int, row array<double>")
    return found.toPandas().sort_values("doc_id", kind="stable")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    modulus: int = 3,
    left_out: int = 1,
    rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Model:
    """Model learned from at most ``rows`` labelled documents: half lexicon, quarter trees and quarter map."""
    chosen = training_rows(labels, label, modulus, left_out, rows)
    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    # The sample has a fixed number of ids, and of rows that share one, one text is read.
    sample = (
        slim.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .withColumn(
            "part",
            F.greatest(
                F.lit(0), F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).cast("int") - 1
            ),
        )
    )
    sample = stored(sample, "sample")
    lexicon = lexicon_of(sample.where("part = 0"))
    found = feature_rows(sample.where("part > 0"), lexicon)
    matrix = np.array(found["row"].tolist(), dtype=float).reshape(len(found), len(FEATURES))
    truth = found["label"].to_numpy(dtype=float)
    grown, tuned = (found["part"] == 1).to_numpy(), (found["part"] == 2).to_numpy()
    forest = boost(matrix[grown], truth[grown])
    steps, chances = np.zeros(0), np.zeros(0)
    if tuned.any() and forest.trees:
        steps, chances = isotonic(forest.raw(forest.binned(matrix[tuned])), truth[tuned])
    return Model(lexicon, forest, steps, chances)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    modulus: int = 3,
    left_out: int = 1,
    rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null, empty and blank texts have all features zero and the score of such.
    Repeated rows have equal scores. Without labels of both classes the score is
    the share of toxic rows. An empty table gives no rows; other columns are
    ignored.
    """
    model = fit(docs, labels, "toxic", modulus, left_out, rows, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for frame in frames:
            texts = [t if isinstance(t, str) else None for t in frame["text"]]
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"].astype("Int64"), "score": known.scores(texts)}
            )

    return slim.mapInPandas(run, "doc_id long, score double").select(
        "doc_id",
        (remainder(F.col("doc_id"), modulus) == left_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"),
    )
