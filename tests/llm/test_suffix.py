"""Suffix-array deduplication against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from ledgermill.llm import suffix
from ledgermill.llm.common import stored

SCHEMA = "doc_id long, text string, spans int, row string, kept double"


def brute_repeats(rows: list[tuple], span: int) -> list[tuple]:
    """Rows are ordered by id (none last), then by their place."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, found = set(), []
    for i in order:
        data = (rows[i][1] or "").encode()
        covered = np.zeros(len(data), bool)
        for p in range(len(data) - span + 1):
            window = data[p : p + span]
            if window in seen:
                covered[p : p + span] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
        spans = [tuple(e) for e in edges.reshape(-1, 2).tolist()]
        kept = bytes(np.frombuffer(data, np.uint8)[~covered])
        found.append((rows[i][0], len(data), spans, kept))
    return found


def found_rows(docs, **options) -> list[tuple]:
    rows = suffix.without_repeats(docs, **options).collect()
    return [
        (r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in rows
    ]


def messy(seed: int, count: int, alphabet: str, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, longest))) for _ in range(6)]
    texts = [None, "", "a", alphabet[0] * longest, alphabet[:2] * longest]
    for _ in range(count):
        parts = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.5:
                piece = rng.choice(shared)
                cut = rng.randint(0, len(piece))
                parts.append(piece[cut:] if rng.random() < 0.5 else piece[: cut + 20])
            else:
                parts.append("".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))))
        texts.append("".join(parts))
    texts += [shared[0] * 3] * 5 + ["".join(shared)] * 4
    rng.shuffle(texts)
    rows = [(i, t, i, "r", 0.5) for i, t in enumerate(texts)]
    return rows + [(3, texts[5], 1, "", 1.0), (3, texts[3], 1, "", 1.0), (None, texts[2], 0, None, None)]


@pytest.mark.parametrize("span, gram, chunk, alphabet", [(12, 4, 3, "ab"), (20, 8, 9, "abü"), (9, 8, 2, "abc")])
def test_removed_spans_match_brute_force(spark, span, gram, chunk, alphabet):
    rows = messy(span, 60, alphabet, 60)
    docs = stored(spark.createDataFrame(rows, SCHEMA).coalesce(1), "fixture")
    found = found_rows(docs, span=span, gram=gram, chunk=chunk)
    assert sorted(found, key=repr) == sorted(brute_repeats(rows, span), key=repr)


def test_production_parameters_and_small_segments(spark, monkeypatch):
    rows = messy(3, 120, "abcdefghij ", 400)
    docs = stored(spark.createDataFrame(rows, SCHEMA).coalesce(1), "fixture")
    expected = sorted(brute_repeats(rows, 100), key=repr)
    assert any(r[2] for r in expected)
    assert sorted(found_rows(docs), key=repr) == expected
    # Batches of few rows: what a batch repeats differs, the result does not.
    monkeypatch.setattr(suffix, "NARROW_ROWS", "7")
    monkeypatch.setattr(suffix, "ARROW_ROWS", "3")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    assert sorted(found_rows(docs), key=repr) == expected
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def test_places_cover_every_window_once_in_any_segment():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    data[500:900] = 97
    offsets = np.array([0, 0, 40, 1500, 1500, 1529, 2990, 3000])
    for segment in (64, 500, 1 << 20):
        found = suffix.named_places(data, offsets, 30, 8, segment)
        windows = [p for a, c in zip(found["at"], found["count"], strict=True) for p in range(a, a + c)]
        valid = [p for a, b in zip(offsets, offsets[1:]) for p in range(a, b - 29)]
        assert sorted(windows) == valid
        # Equal windows name the same place.
        named = {}
        for a, c, lead in zip(found["at"], found["count"], found["lead"], strict=True):
            for p in range(a, a + c):
                assert named.setdefault(bytes(data[p : p + 30]), a + lead - p) == a + lead - p


def test_a_long_text_and_a_hot_passage(spark):
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefgh ") for _ in range(200_000))
    passage = "a passage that a third of all documents hold, longer than a hundred bytes by itself, " * 2
    rows = [(1, base, 0, "", 0.0), (2, base[50_000:150_000], 0, "", 0.0)]
    rows += [(10 + i, f"{i * 7919} {passage} {i * 104729}", 0, "", 0.0) for i in range(300)]
    docs = stored(spark.createDataFrame(rows, SCHEMA).coalesce(1), "fixture")
    expected = brute_repeats(rows, 100)
    assert sorted(found_rows(docs), key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    assert suffix.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_derives_its_columns(spark, folder):
    from ledgermill.llm.queries import op12_suffix

    rows = messy(8, 40, "ab ", 300)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    found = op12_suffix(spark, folder).collect()
    expected = [
        (i, n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest())
        for i, n, s, k in brute_repeats(rows, 100)
    ]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
