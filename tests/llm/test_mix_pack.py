"""Mixing and packing against brute force and round trips."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgermill.llm import mixing, packing
from ledgermill.llm.common import stored
from ledgermill.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, source string, n_chars long, size long, part_n int"


def documents(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        source = rng.choice(["b", "b", "b", "b", "a", "é", "Z", None, "one"])
        text = " ".join(["w"] * rng.choice([0, 1, 5, 40, 300]))
        rows.append((i, text, source, len(text), 0, 0))
    rows += [(301, None, "b", None, None, None), (None, "a b", "void", 3, 1, 1)]
    rows += [(400, None, "none", 0, 0, 0), (400, "", "none", 0, 0, 0)]
    return rows, stored(spark.createDataFrame(rows, SCHEMA), "fixture")


def brute_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    capped, left = set(), float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return target
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 3 * sizes[s] or sizes[s] == 0]
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            capped.add(s)
            left -= target[s]


def test_mixture_meets_the_water_level(spark):
    rows, docs = documents(spark)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    targets = brute_targets(sizes)
    source_of = {r[0]: r[2] for r in rows}
    found = mixing.mixture(docs).collect()
    assert len(found) == len(rows)
    taken = defaultdict(int)
    for r in found:
        source = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, words in taken.items():
        assert words == pytest.approx(targets[source], abs=0.51)
    again = mixing.mixture(docs.repartition(7)).select("doc_id", "taken").collect()
    once = {(r["doc_id"], r["taken"]) for r in found}
    assert {tuple(r) for r in again} == once


def test_mixed_repeats_and_cuts_texts(spark):
    rows, docs = documents(spark)
    out = mixing.mixed(docs)
    assert out.schema == docs.schema
    words = defaultdict(int)
    for r in out.collect():
        words[r["doc_id"]] += len((r["text"] or "").split())
        assert r["n_chars"] in (None, len(r["text"] or ""))
    taken = defaultdict(int)
    for r in mixing.mixture(docs).collect():
        taken[r["doc_id"]] += r["taken"]
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in taken.items() if v}


def test_mixture_of_nothing(spark):
    assert mixing.mixture(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = stored(spark.createDataFrame([(1, " ", "a", 1, 1, 1)], SCHEMA), "blank")
    row = mixing.mixture(blank).first()
    assert (row["size"], row["target"], row["taken"]) == (0, 0.0, 0)
    assert mixing.mixed(blank).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_difference_places_every_item_once(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 512) for _ in range(rng.randint(1, 400))]
    windows = packing.windows_for(lengths, 2048)
    assert sorted(i for w in windows for i in w) == list(range(len(lengths)))
    loads = [sum(lengths[i] for i in w) for w in windows]
    assert max(loads) <= 2048
    if len(lengths) > 100:
        assert len(loads) <= -(-sum(loads) // 2048) + 1
        assert max(loads) - min(loads) < 512


def test_difference_matches_the_two_way_rule():
    # 8,7,6,5,4: 8-7, 6-5, then 4 with 1, 3 with 1 -> loads 16 and 14.
    loads = sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.difference([8, 7, 6, 5, 4], 2))
    assert loads == [14, 16]


def test_cuts_cover_a_document():
    for length in (1, 511, 512, 513, 2047, 2048, 2049, 9000):
        cuts = packing.cuts(length, 2048, 512)
        assert cuts[0][0] == 0 and sum(n for _, n in cuts) == length
        assert all(a + n == b for (a, n), (b, _) in zip(cuts, cuts[1:], strict=False))
        assert all(0 < n <= 2048 for _, n in cuts)


def test_rows_without_an_id_are_dealt_by_their_text(spark):
    rows = [(None, f"text number {i} " * (1 + i % 5), "abc"[i % 3], 1, 1, 1) for i in range(600)]
    docs = stored(spark.createDataFrame(rows, SCHEMA), "fixture")
    runs = []
    for given in (docs, stored(docs.repartition(5), "other")):
        mixed = mixing.mixed(given).select("text", "source")
        runs.append(sorted(map(tuple, mixed.collect())))
    # Rows are told apart by their texts, wherever they lie in the table.
    assert runs[0] == runs[1]
    assert len({t for t, _ in runs[0]}) > 300


def test_packed_ids_are_those_of_the_library(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    alphabet = "ab c\n\t'sé²Ⅷ  \x1c\U0001f600<|endoftext|>12"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(60)]
    texts += [None, "", "<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>é", "long word " * 3000, "z" * 5000]
    rows = [(i, t, "s", 0, 0, 0) for i, t in enumerate(texts)] + [(0, texts[0], "s", 0, 0, 0)]
    docs = stored(spark.createDataFrame(rows, SCHEMA), "fixture")
    tokenizer = Tokenizer.from_file(tokenizer_path())
    found = packing.packed(docs, tokenizer_path(), block_rows=16).toPandas()
    for doc_id, group in found.groupby("doc_id"):
        ids = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [1]
        copies = 2 if doc_id == 0 else 1
        assert group["length"].sum() == copies * len(ids)
        for r in group.itertuples():
            piece = np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes()
            assert zlib.crc32(piece) == r.ids_crc32 and r.doc_tokens == len(ids)
    for _, group in found.groupby("sequence_id"):
        ends = 0
        for r in group.sort_values("offset").itertuples():
            assert r.offset == ends
            ends += r.length
        assert ends <= 2048
    assert packing.packed(spark.createDataFrame([], SCHEMA), tokenizer_path()).count() == 0
    known = packing.encoder(tokenizer_path())
    assert known.ids("a <|endoftext|> b") == [64, 220, 50256, 275]
    tokenizer.encode_special_tokens = True
    plain = tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids
    assert known.ids("a <|endoftext|> b", special_as_text=True) == plain
