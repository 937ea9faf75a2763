"""Toxicity and quality scores recomputed in plain Python."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from ledgermill.llm import quality, toxicity

# --- toxicity ----------------------------------------------------------------


def plain_features(text: str | None, lexicon: frozenset[str]) -> list[float]:
    """The thirteen features, one rule after the other."""
    if not text:
        return [0.0] * 13
    words = re.findall(r"[^\W_]+", text.lower())

    def stems(w):
        return [w[:n] + "*" for n in (4, 5) if len(w) > n]

    def kind(c):
        if ord(c) >= 0x250:
            return "letter"
        if c.isspace():
            return "space"
        return "capital" if c.isupper() else "letter" if c.isalpha() else "digit" if c.isalnum() else "sign"

    kinds = [kind(c) for c in text]
    letter = [k in ("letter", "capital") for k in kinds]
    near, forms = 0, 0
    for i, w in enumerate(words):
        if w in lexicon or any(s in lexicon for s in stems(w)):
            forms += 1
            near += any(v in toxicity.ADDRESS for v in words[max(0, i - 5) : i + 6])
    masked = [
        i for i in range(1, len(text) - 1)
        if letter[i - 1] and letter[i + 1] and text[i] in "0123456789@$!*._-"
    ]
    hidden = 0
    for i in masked:
        low, high = i, i
        while low > 0 and not text[low - 1].isspace():
            low -= 1
        while high < len(text) and not text[high].isspace():
            high += 1
        signs = dict(zip("013457@$!", "oieastasi", strict=True))
        said = "".join(signs.get(c, c) for c in text[low:high].lower())
        hidden += "".join(re.findall(r"[^\W_]+", said)) in lexicon
    count, size = max(1, len(words)), max(1, len(text))
    three = range(len(text) - 2)
    return [
        sum(w in lexicon for w in words) / count,
        forms / count,
        float(min(forms, 20)),
        hidden / count,
        near / max(1, forms),
        sum(w in toxicity.ADDRESS for w in words) / count,
        kinds.count("capital") / size,
        sum(all(kinds[i + j] == "capital" for j in range(3)) for i in three) / size,
        kinds.count("sign") / size,
        text.count("!") / size,
        len(masked) / count,
        sum(text[i] == text[i + 1] == text[i + 2] and letter[i + 2] for i in three) / count,
        math.log1p(len(words)),
    ]


def test_features_match_plain_rules(monkeypatch):
    rng = random.Random(1)
    lexicon = frozenset(["idiot", "fool", "stup*", "moron", "àb"])
    pieces = ["you", "idiot", "id1ot", "f@@l", "f*ol", "stupidest", "STOP", "sooo", "!!", "Äb", "e.g.", "3.5",
              "ok", "dein", "Ωμ", "x-y", "moron,", "a_b", "m0ron", "世界", " ", "\n"]
    texts = [None, "", " ", "a", "AAA", "!!!"]
    texts += [rng.choice(" \t").join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(200)]
    for size in (1 << 20, 7):
        monkeypatch.setattr(toxicity, "_PART_CHARS", size)
        for text in texts:
            assert toxicity.features(text, lexicon) == pytest.approx(plain_features(text, lexicon)), text


def plain_isotonic(raw: list[float], labels: list[float]) -> dict[float, float]:
    """The min-max form of the rising fit: no pooling."""
    at = sorted(set(raw))
    sums = [(sum(l for r, l in zip(raw, labels, strict=True) if r == v), raw.count(v)) for v in at]

    def mean(a, b):
        return sum(s for s, _ in sums[a : b + 1]) / sum(n for _, n in sums[a : b + 1])

    return {
        v: max(min(mean(a, b) for b in range(i, len(at))) for a in range(i + 1)) for i, v in enumerate(at)
    }


def test_isotonic_step_matches_the_min_max_form():
    rng = random.Random(2)
    for _ in range(20):
        raw = [round(rng.gauss(0, 1), 1) for _ in range(40)]
        labels = [float(rng.random() < 1 / (1 + math.exp(-2 * r))) for r in raw]
        steps, chances = toxicity.isotonic(np.array(raw), np.array(labels))
        for value, chance in plain_isotonic(raw, labels).items():
            assert np.interp(value, steps, chances) == pytest.approx(chance)


def test_scores_match_trees_followed_by_hand():
    rng = random.Random(4)
    lexicon = frozenset(["bad", "awful"])
    texts = [" ".join(rng.choice(["bad", "awful", "good", "you", "DAY!", "b4d"]) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    rows = np.array([toxicity.features(t, lexicon) for t in texts])
    labels = np.array([float("bad" in t and rng.random() < 0.9) for t in texts])
    forest = toxicity.boost(rows[:200], labels[:200], trees=12)
    steps, chances = toxicity.isotonic(forest.raw(forest.binned(rows[200:])), labels[200:])
    model = toxicity.Model(lexicon, forest, steps, chances)

    def follow(tree, bins):
        at = 0
        while tree[at][0] >= 0:
            at = int(tree[at][2] if bins[int(tree[at][0])] <= tree[at][1] else tree[at][3])
        return tree[at][4]

    found = model.scores(texts)
    assert len(set(found)) > 3
    for text, score in zip(texts, found, strict=True):
        row = plain_features(text, lexicon)
        bins = [sum(e < v - 1e-12 for e in edges) for v, edges in zip(row, forest.edges, strict=True)]
        raw = forest.base + sum(follow(tree, bins) for tree in forest.trees)
        if raw <= steps[0] or raw >= steps[-1]:
            wanted = chances[0] if raw <= steps[0] else chances[-1]
        else:
            k = next(i for i in range(len(steps) - 1) if steps[i] <= raw <= steps[i + 1] and steps[i] < steps[i + 1])
            share = (raw - steps[k]) / (steps[k + 1] - steps[k])
            wanted = chances[k] + share * (chances[k + 1] - chances[k])
        assert score == pytest.approx(wanted, abs=1e-9)


def test_a_split_is_the_best_of_all():
    """The root of a tree has the largest gain over every feature and bin."""
    rng = np.random.default_rng(3)
    binned = rng.integers(0, 6, (80, 4))
    labels = (binned[:, 2] > 2) ^ (rng.random(80) < 0.2)
    slope, curve = 0.5 - labels, np.full(80, 0.25)
    tree = toxicity.grow_tree(binned, slope, curve)

    def gain(j, k):
        low = binned[:, j] <= k
        parts = [(slope[m].sum(), curve[m].sum()) for m in (low, ~low)]
        return sum(g * g / (h + 1) for g, h in parts) - slope.sum() ** 2 / (curve.sum() + 1)

    best = max((gain(j, k), -j, -k) for j in range(4) for k in range(5))
    assert (-best[1], -best[2]) == (int(tree[0][0]), int(tree[0][1]))


# --- quality -----------------------------------------------------------------


def plain_training(bags, labels, bits, width, epochs, rate, seed):
    """The same descent on lists of floats; returns vectors, output and bias."""
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / width, 1 / width, (1 << bits, width)).astype(np.float32).tolist()
    output = rng.uniform(-1, 1, (width, 2)).astype(np.float32).tolist()
    bias, step = [0.0, math.log(share / (1 - share))], 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            now = rate * (1 - step / (epochs * len(bags)))
            step += 1
            bag = bags[i]
            if not bag:
                continue
            total = sum(bag.values())
            hidden = [sum(n / total * vectors[b][d] for b, n in bag.items()) for d in range(width)]
            logits = [sum(hidden[d] * output[d][c] for d in range(width)) + bias[c] for c in (0, 1)]
            odds = [math.exp(z - max(logits)) for z in logits]
            error = [o / sum(odds) - (c == labels[i]) for c, o in enumerate(odds)]
            back = [sum(output[d][c] * error[c] for c in (0, 1)) for d in range(width)]
            for d in range(width):
                for c in (0, 1):
                    output[d][c] -= now * hidden[d] * error[c]
            bias = [bias[c] - 0.1 * now * error[c] for c in (0, 1)]
            for b, n in bag.items():
                for d in range(width):
                    vectors[b][d] -= now * 50.0 * n / total * back[d]
    return vectors, output, bias


def test_quality_scores_match_averaged_vectors_and_a_softmax():
    rng = random.Random(6)
    bits, width = 7, 3
    texts = [" ".join(rng.choice(["fine", "text", "of", "good", "kind"] if i % 2 else ["spam", "BUY", "now", "of"])
                      for _ in range(rng.randint(0, 12))) for i in range(40)]
    labels = [i % 2 for i in range(40)]
    bags = []
    for text in texts:
        bag: dict[int, int] = {}
        for found in quality.buckets(text, bits):
            for b in found.tolist():
                bag[b] = bag.get(b, 0) + 1
        bags.append(dict(sorted(bag.items())))
    model = quality.train(
        [(np.array(list(b), dtype=np.int64), np.array(list(b.values()), dtype=np.int64)) for b in bags],
        np.array(labels), bits, width, epochs=3, rate=0.5, seed=9,
    )
    vectors, output, bias = plain_training(bags, labels, bits, width, 3, 0.5, 9)
    for text, bag in zip(texts, bags, strict=True):
        total = sum(bag.values()) or 1
        mean = [sum(n / total * vectors[b][d] for b, n in bag.items()) for d in range(width)]
        logits = [sum(mean[d] * output[d][c] for d in range(width)) + bias[c] for c in (0, 1)]
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(logits[0] - logits[1])), abs=2e-4)
    right = sum((model.score(t) > 0.5) == bool(l) for t, l in zip(texts, labels, strict=True))
    assert right > 30
