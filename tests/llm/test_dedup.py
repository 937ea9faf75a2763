"""Exact and near deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from ledgermill.llm import exact, mixing, simhash
from ledgermill.llm.common import stored
from ledgermill.llm.components import components

SCHEMA = "doc_id long, text string, row_no string, kept int, name double"


def messy_texts() -> list[tuple]:
    rng = random.Random(7)
    texts = [None, "", " ", "\n\t", "a", "a ", "a  b", "a b", "a\r\nb", "ab", "ß b", "ß b"]
    texts += ["x" * n for n in (3, 4, 5, 8, 9, 16, 17, 31)] * 2
    texts += ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 14))) for _ in range(150)]
    texts += ["same text over many rows"] * 40
    rng.shuffle(texts)
    rows = [(i, t, "r", i, 0.5) for i, t in enumerate(texts)]
    return rows + [(3, texts[3], "again", 1, 1.0), (None, "a b", None, None, None)]


def brute_groups(rows: list[tuple]) -> dict[str, list]:
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    return groups


def test_exact_duplicates_match_brute_force(spark):
    rows = messy_texts()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).sortWithinPartitions("doc_id")
    groups = brute_groups(rows)
    expected = []
    for flat, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(flat.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda x: (x is None, x)):
            expected.append((i, keep, len(ids), first, digest))
            first = False
    # Four bytes a block: many rounds, and runs that go over partition borders.
    for block_bytes in (4, 8192):
        path = exact.stored(docs, "fixture")
        found = exact.exact_duplicates(path, block_bytes=block_bytes).collect()
        assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_names_do_not_depend_on_partitions(spark):
    rows = [(i % 7, i, i) for i in range(500)]
    data = spark.createDataFrame(rows, "key long, row long, pos long")
    for width in (1, 13):
        spark.conf.set("spark.sql.shuffle.partitions", str(width))
        named = exact.sorted_names(data, ["key"], ["row", "pos"]).collect()
        names = defaultdict(set)
        for r in named:
            names[r["row"] % 7].add(r["name"])
        assert len(named) == 500
        assert all(len(v) == 1 for v in names.values())
        firsts = [min(names[k]) for k in range(7)]
        assert firsts == sorted(set(firsts))
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_deduplicated_keeps_columns_and_one_row_of_each_text(spark):
    rows = messy_texts()
    docs = exact.stored(spark.createDataFrame(rows, SCHEMA), "fixture")
    kept = exact.deduplicated(docs)
    assert kept.schema == docs.schema
    assert kept.count() == len(brute_groups(rows))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact.exact_duplicates(docs).count() == 0
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_per_group(docs).count() == 0


def brute_print(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    if not words:
        return 0
    if len(words) < 3:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: dict[int, int]) -> dict[int, int]:
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints_match_brute_force():
    rng = random.Random(3)
    words = ["Ä", "the", "THE", "of it", "x1", "ß", "\x1cq", "end."]
    for _ in range(300):
        text = rng.choice([" ", "\n", "\x0b "]).join(rng.choices(words, k=rng.randint(0, 12)))
        assert simhash.fingerprint(text) == brute_print(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t\n") == 0


def test_fingerprints_agree_with_spark_hash(spark):
    row = spark.range(1).select(F.hex(F.xxhash64(F.lit("one two three")))).first()
    assert int(row[0], 16) == simhash.fingerprint("One two THREE")


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(11)
    base = [" ".join(rng.choices("abcdefghijklmnop", k=rng.randint(30, 60))) for _ in range(25)]
    texts = []
    for text in base:
        texts.append(text)
        words = text.split()
        for _ in range(4):
            copy = list(words)
            copy[rng.randrange(len(copy))] = rng.choice("qrst")
            texts.append(" ".join(copy))
    texts += [None, "", "  ", base[0], base[0].upper()]
    rng.shuffle(texts)
    rows = [(1000 - i, t, "x", 1, 0.0) for i, t in enumerate(texts)]
    docs = simhash.stored(spark.createDataFrame(rows, SCHEMA), "fixture")
    prints = {r[0]: brute_print(r[1]) for r in rows}
    classes = brute_components(prints)
    assert len(set(classes.values())) < len(rows) - 10
    found = simhash.near_duplicates(docs).collect()
    assert {(r[0], r[1], r[2]) for r in found} == {
        (i, f"{prints[i]:016x}", classes[i]) for i in prints
    }
    kept = simhash.one_per_group(docs)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == set(classes.values())


def test_links_find_every_pair_within_three_bits(spark):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for value in list(prints)[:40]:
        for _ in range(3):
            flipped = value
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                flipped ^= 1 << bit
            prints.add(flipped)
    prints |= {0, (1 << 64) - 1, 7, 1 << 63}
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    table = simhash.stored(
        spark.createDataFrame([(s, 1) for s in signed], "print long, copies long"), "prints"
    )
    roots = {r["node"]: r["root"] for r in components(simhash.links(table)).collect()}
    found = defaultdict(set)
    for s in signed:
        found[roots.get(s, s)].add(s)
    # Nodes of the brute force are ordered as signed numbers, as they are in the operator.
    expected = defaultdict(set)
    for s, r in brute_components({s: p for s, p in signed.items()}).items():
        expected[r].add(s)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    frame = spark.createDataFrame(edges, "left long, right long")
    roots = {r["node"]: r["root"] for r in components(frame).collect()}
    assert {roots[i] for i in range(100, 131)} == {100}
    assert {roots[i] for i in [7, *range(200, 260)]} == {7}
    assert 5 not in roots


def test_groups_do_not_follow_null_or_repeated_ids(spark):
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(8)]
    # Distinct texts: five without an id, two of one id; the last has a copy without an id.
    ids = [None] * 5 + [7, 7, 9]
    rows = [*zip(ids, texts, strict=True), (None, texts[7])]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string"), "ids")
    kept = [tuple(r) for r in simhash.one_per_group(docs).collect()]
    assert sorted(kept, key=str) == sorted(rows[:8], key=str)


def test_rows_keep_their_numbers_when_the_scan_is_split_anew(spark, folder):
    rows = [(i, f"text {i % 40} " + "word " * (i % 7), "ab"[i % 2]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.repartition(12, "doc_id").write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    size = "spark.sql.files.maxPartitionBytes"
    for operator in (exact.deduplicated, simhash.one_per_group, mixing.mixed):
        found = []
        for first, then in (("128m", "128m"), ("128m", "1k"), ("1k", "128m")):
            try:
                spark.conf.set(size, first)
                result = operator(docs)
                spark.conf.set(size, then)
                found.append(sorted(tuple(r) for r in result.collect()))
            finally:
                spark.conf.unset(size)
        assert found[0] == found[1] == found[2]


def test_exact_groups_read_the_numbered_table_once(spark, folder):
    rows = [(i, f"text {i % 40}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.repartition(12, "doc_id").write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    found = exact.text_identities(
        docs.withColumn("n_", F.monotonically_increasing_id()), "n_", "text", keep=("doc_id",)
    )
    own = {r["doc_id"]: (r["rounds"], r["name"]) for r in found.collect()}
    assert len(own) == 120
    assert all(own[i] == own[i % 40] for i in own)
