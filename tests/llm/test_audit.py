"""Filter interaction audit against brute force."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np

from ledgermill.llm import audit

SCHEMA = "doc_id long, text string, lang string, mask int, part string"
LABELS = "doc_id long, quality int, toxic int"


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def brute_mask(row: tuple, rows: list[tuple]) -> str:
    text = row[1] or ""
    words = words_of(text)
    fails = ""
    fails += "A" if len(words) < 200 else ""
    fails += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
    fails += "D" if re.search(r"[#$%&*|]", text) else ""
    if row[0] is not None:
        again = any(r[0] is not None and r[0] < row[0] and (r[1] or "") == text for r in rows)
        fails += "E" if again else ""
    return fails


def brute_audit(rows: list[tuple], labels: list[tuple]) -> list[tuple]:
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    found = []
    for part in {r[2] or "" for r in rows}:
        docs = [(r[0], brute_mask(r, rows)) for r in rows if (r[2] or "") == part]
        played = []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                fail = sum(letter in d[1] for d in docs)
                played.append(
                    (
                        "".join(order),
                        step,
                        len(left),
                        len(gone),
                        fail - len(gone),
                        sum(d[1] == letter for d in docs),
                        sum(d[0] is not None and d[0] in good for d in gone),
                        sum(d[0] is not None and d[0] in toxic for d in gone),
                    )
                )
        for p in played:
            mine = sum(q[3] for q in played if q[0][q[1] - 1] == p[0][p[1] - 1])
            found.append((part, *p, mine))
    return found


def odd_rows() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(2)
    pieces = ["Über", "straße", "ab", "AB", "a" * 9, "a" * 8 + "b", "naïve x", "日本", "x|y", "💡"]

    def made(count: int, pool: int) -> str:
        return rng.choice(" \n").join(
            rng.choice(pieces[:8]) + str(rng.randrange(pool)) for _ in range(count)
        )

    texts = [None, "", "  \r\n\t", "Z", "$"] + pieces
    texts += [made(rng.choice((150, 199, 200, 260)), rng.choice((3, 30, 900))) for _ in range(60)]
    texts += ["one text of many " * 70] * 30
    texts += ["w" * 300_000, "long " * 100_000 + "#"]
    texts += [" ".join(f"lower{i}" for i in range(250)) + c for c in ("", "", " ", "%", " ABCDEFGHI" * 9)]
    rng.shuffle(texts)
    langs = ["en", "en", "en", "de", None, ""]
    rows = [(i, t, rng.choice(langs), 5, "clash") for i, t in enumerate(texts)]
    rows += [(4, texts[4], "en", 1, ""), (4, texts[9], "en", 1, ""), (None, texts[9], "de", 1, "")]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 80)]
    labels += [(3, None, 1), (3, 1, None), (None, 1, 1), (10**9, 1, 1)]
    return rows, labels


def test_audit_matches_brute_force(spark):
    rows, labels = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = audit.audit(docs, spark.createDataFrame(labels, LABELS)).select(
        *"part filter_order step kept removed redundant unique_fails".split(),
        *"good_lost toxic_lost shapley".split(),
    )
    assert sorted(map(tuple, found.collect())) == sorted(brute_audit(rows, labels))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], LABELS)
    assert audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    assert audit.audit(one, labels).count() == 600


def test_transducer_counts_every_document():
    rows, _ = odd_rows()
    texts = [(r[1] or "") for r in rows]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(d) for d in data])
    found = audit.transduce(np.frombuffer(b"".join(data), dtype=np.uint8), offsets)
    for i, text in enumerate(texts):
        words = words_of(text)
        assert found["words"][i] == len(words)
        assert found["distinct_words"][i] == len(set(words))
        assert found["code_points"][i] == len(text)
        assert found["capitals"][i] == len(re.findall("[A-Z]", text))
        assert found["symbols"][i] == len(re.findall(r"[#$%&*|]", text))


def test_equal_hashes_do_not_merge_words(monkeypatch):
    words = [f"w{i % 40}" + "x" * (i % 3) * 7 for i in range(300)]
    data = " ".join(words).encode()
    monkeypatch.setattr(audit.WordTable, "hashes", lambda self: np.zeros(len(self.sizes), np.uint64))
    found = audit.transduce(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    assert found["distinct_words"][0] == len(set(words))
