from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import classify, learned, merchants, similar
from ledgermill.plans import frames
from tests.conftest import SF
from tests.rows import frame, values

# --- naive Bayes -------------------------------------------------------------


def brute_tokens(text):
    import regex

    words = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
    return ["#" if regex.search(r"\p{N}", w) else w for w in words]


def parts(value):
    return round(math.log(value) * 1_000_000)


def brute_predict(train, texts):
    counts, rows = defaultdict(Counter), Counter()
    for text, category in train:
        if category is not None:
            rows[category] += 1
            counts[category].update(brute_tokens(text))
    vocabulary = set().union(*counts.values())
    found = []
    for text in texts:
        words, scores = brute_tokens(text), {}
        for c in rows:
            fallback = -parts(sum(counts[c].values()) + len(vocabulary))
            scores[c] = parts(rows[c] / sum(rows.values())) + sum(
                (parts(counts[c][w] + 1) if counts[c][w] else 0) + fallback for w in words
            )
        best = max(scores.values())
        top = min(c for c in scores if scores[c] == best)
        posterior = 1 / sum(math.exp((s - best) / 1e6) for s in scores.values())
        found.append((top, posterior))
    return found


def bank_lines(seed, count):
    rng = random.Random(seed)
    shops = {1: ["woolworths", "coles", "aldi"], 2: ["shell", "bp", "ampol"], 7: ["café bär", "grill'd"]}
    lines = []
    for i in range(count):
        category = rng.choice(list(shops))
        shop = rng.choice(shops[category])
        noise = rng.choice(["CARD 4412", "VISA 99/12", "", "AU", "Sydney"])
        lines.append((i, f"{noise} {shop.upper()} {rng.randint(100, 999)} {noise}", category))
    return lines


def test_predictions_match_a_plain_recount(spark):
    lines = bank_lines(1, 200)
    lines += [(900, None, 2), (901, "", None), (902, "unknown words only", None), (903, "AMPOL", None)]
    schema = "txn_id LONG, description_clean STRING, category_id INT"
    rows = spark.createDataFrame(lines, schema)
    model = learned.train(rows, "description_clean", "category_id")
    found = {r["txn_id"]: r for r in learned.predict(rows, model, "txn_id", "description_clean").collect()}
    expected = brute_predict([(t, c) for _, t, c in lines], [t for _, t, _ in lines])
    assert len(found) == len(lines)
    for (i, _, _), (top, posterior) in zip(lines, expected, strict=True):
        assert found[i]["predicted"] == top
        assert abs(float(found[i]["confidence"]) - posterior) <= 0.0006


def test_no_labels_give_no_prediction(spark):
    schema = "txn_id LONG, description_clean STRING, category_id INT"
    rows = spark.createDataFrame([(1, "a shop", None)], schema)
    model = learned.train(rows, "description_clean", "category_id")
    assert values(learned.predict(rows, model, "txn_id", "description_clean"), "predicted", "confidence") == [(None, None)]


def test_model_fills_the_second_pass(spark):
    schema = "txn_id LONG, description_clean STRING, category_id INT"
    rows = spark.createDataFrame(bank_lines(2, 150), schema)
    model = learned.train(rows.filter("txn_id < 120"), "description_clean", "category_id")
    open_rows = rows.filter("txn_id >= 120").withColumnRenamed("category_id", "actual")
    ready = learned.learned_second_pass(open_rows, model, 0.5)
    rule = classify.MerchantRule("coles", 9)
    done = classify.classify_transactions(ready, [rule], F.col("learned"))
    by = {r[0]: r[1] for r in done.groupBy("classified_by").count().collect()}
    assert set(by) == {"rule", "model"}
    model_rows = done.filter("classified_by = 'model'")
    assert model_rows.filter("category_id = actual").count() == model_rows.count()
    assert all(r[0] >= Decimal("0.5") for r in model_rows.select("confidence_score").collect())
    # Nothing is sure enough.
    none = learned.learned_second_pass(open_rows, model, 1.1)
    assert none.filter("learned IS NOT NULL").count() == 0


def test_held_out_accuracy_is_over_85_percent(spark):
    from ledgermill.plans.queries_learn import class_learned_accuracy

    found = {r["held_out"]: r for r in class_learned_accuracy(spark, SF).collect()}
    assert found[True]["rows"] > 100
    assert found[True]["accuracy"] > 0.85


# --- merchant rules ----------------------------------------------------------


def brute_merchants(lines, rules):
    import regex

    def words(text):
        return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())

    split = [(r, words(r["phrase"])) for r in rules]
    found = {}
    for key, text in lines:
        have, hits = words(text), []
        for rule, need in split:
            n = len(need)
            if n and any(have[i : i + n] == need for i in range(len(have) - n + 1)):
                hits.append((rule["priority"], -n, rule["rule_id"]))
        if hits:
            found[key] = min(hits)[2]
    return found


def test_merchant_trie_matches_brute_force(spark):
    rng = random.Random(3)
    words = ["ab", "cd", "é", "x1", "shop", "The"]
    rules = [
        {"rule_id": i, "priority": rng.randrange(3), "category_id": i,
         "phrase": " - ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))}
        for i in range(40)
    ]
    rules += [{"rule_id": 100, "phrase": None, "priority": 0}, {"rule_id": 101, "phrase": " ./ ", "priority": 0}]
    lines = [(str(i), " ".join(rng.choice([*words, "zz"]) for _ in range(rng.randint(0, 7)))) for i in range(300)]
    lines += [("none", None), ("same", lines[3][1]), ("gap", "ab zz cd")]
    txns = spark.createDataFrame(lines, "txn_id STRING, description_clean STRING")
    found = merchants.match_merchants(txns, frame(spark, merchants.RULE, rules))
    assert {r["txn_id"]: r["rule_id"] for r in found.collect()} == brute_merchants(lines, rules)
    named = merchants.classify_by_merchant(txns, frame(spark, merchants.RULE, rules))
    assert named.count() == len(lines)
    assert named.filter("category_id = rule_id").count() == found.count()


def test_plan_does_not_grow_with_the_rules(spark):
    """Five thousand rules have the plan of a few."""
    txns = spark.createDataFrame([("1", "pos shop 17 of town 3")], "txn_id STRING, description_clean STRING")

    def joins(count):
        rules = [{"rule_id": i, "phrase": f"shop {i} of town {i % 50}", "priority": 1, "category_id": 2} for i in range(count)]
        path = frame(spark, merchants.RULE, rules).repartition(2).cache()
        found = merchants.match_merchants(txns, path)
        assert values(found, "rule_id") == []
        hit = merchants.match_merchants(txns.withColumn("description_clean", F.lit("x shop 17 of town 17 y")), path)
        assert values(hit, "rule_id") == [(17,)]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        path.unpersist()
        return plan.count("Join"), len(plan.splitlines())

    assert joins(20) == joins(5000)


def test_rules_out_of_range_are_refused(spark):
    rules = frame(spark, merchants.RULE, [{"rule_id": 1, "phrase": "a", "priority": -1}])
    with pytest.raises(Exception, match="out of range"):
        merchants.merchant_trie(rules).collect()


# --- similar examples --------------------------------------------------------


def brute_similar(docs, reviewed, n, terms):
    import regex

    def words(text):
        return set(regex.findall(r"[\p{L}\p{N}]+", (text or "").lower()))

    decided = [r for r in reviewed if r["review_status"] in similar.DECIDED]
    held = Counter(w for r in decided for w in words(r["text"]))
    weight = {w: round(math.log(1 + len(decided) / c) * 1_000_000) for w, c in held.items()}

    def key_terms(row):
        return set(sorted((w for w in words(row["text"]) if w in weight), key=lambda w: (-weight[w], w))[:terms])

    known = [(r, key_terms(r)) for r in decided]
    found = []
    for d in docs:
        mine = key_terms(d)
        for status in similar.DECIDED:
            scored = []
            for r, theirs in known:
                score = sum(weight[w] for w in mine & theirs)
                if r["review_status"] == status and r["doc_id"] != d["doc_id"] and score:
                    age = r["reviewed_at"].timestamp() if r["reviewed_at"] else -math.inf
                    scored.append((-score, -age, r["doc_id"]))
            for rank, (score, _, i) in enumerate(sorted(scored)[:n], 1):
                found.append((d["doc_id"], status, rank, i, -score))
    return sorted(found)


def test_similar_examples_match_brute_force(spark):
    import datetime

    rng = random.Random(9)
    pool = [f"term{i}" for i in range(60)] + ["the", "of"] * 10
    rows = []
    for i in range(90):
        text = " ".join(rng.choice(pool) for _ in range(rng.randint(0, 15)))
        day = rng.choice([None, datetime.datetime(2025, 1, rng.randint(1, 5))])
        rows.append({"doc_id": i, "text": text, "reviewed_at": day,
                     "review_status": rng.choice(["CONFIRMED", "REJECTED", "PENDING"])})
    # Many copies of one text: one entry, the newest five are shown.
    rows += [{**rows[0], "doc_id": 200 + i, "review_status": "CONFIRMED"} for i in range(30)]
    rows += [{"doc_id": 300, "text": None, "review_status": "CONFIRMED", "reviewed_at": None}]
    reviewed = frame(spark, "doc_id LONG, text STRING, review_status STRING, reviewed_at TIMESTAMP", rows)
    for n, terms in ((5, 12), (2, 3)):
        found = similar.few_shot_similar(reviewed, reviewed, n=n, terms=terms)
        assert sorted(map(tuple, found.collect())) == brute_similar(rows, rows, n, terms)


def test_long_lists_of_similar_examples(spark, monkeypatch):
    """Common terms, near copies and repeated keys: no list is read beyond the bound."""
    import datetime

    rng = random.Random(4)
    rows = []
    for i in range(70):
        # Near copies share six terms; the others hold a few of eight common ones.
        words = [f"copy{j}" for j in range(6)] + [f"own{i % 33}"] if i < 35 else rng.sample([f"w{j}" for j in range(8)], rng.randint(1, 5))
        rows.append({"doc_id": i, "text": " ".join(words), "reviewed_at": rng.choice([None, datetime.datetime(2025, 1, rng.randint(1, 5))]),
                     "review_status": rng.choice(["CONFIRMED", "CONFIRMED", "REJECTED", "PENDING"])})
    schema = "doc_id LONG, text STRING, review_status STRING, reviewed_at TIMESTAMP"
    reviewed = frame(spark, schema, rows)
    longest = []
    kept = similar.kept_copy

    def watched(copied, name):
        copy = kept(copied, name)
        if name == "lists":
            longest.append(copy.agg(F.max(F.size("members"))).first()[0])
        return copy

    monkeypatch.setattr(similar, "kept_copy", watched)
    monkeypatch.setattr(similar, "COMMON", 3)
    found = similar.few_shot_similar(reviewed, reviewed, n=2, terms=7, longest=4)
    assert sorted(map(tuple, found.collect())) == brute_similar(rows, rows, 2, 7)
    assert len(longest) > 2 and max(x or 0 for x in longest) <= 5
    # Terms of a key that comes twice count twice, whatever the bound.
    twice = frame(spark, schema, rows + rows[40:50])
    cut, whole = (similar.few_shot_similar(twice, twice, n=2, terms=7, longest=x) for x in (4, 1000))
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))


def test_similar_block_and_plan(spark):
    rows = [{"doc_id": i, "text": "power bill north", "review_status": s} for i, s in enumerate(["CONFIRMED", "REJECTED", "PENDING"])]
    reviewed = frame(spark, "doc_id LONG, text STRING, review_status STRING, reviewed_at TIMESTAMP", rows)
    found = similar.few_shot_similar(reviewed.filter("review_status = 'PENDING'"), reviewed)
    named = reviewed.select("doc_id", F.concat(F.lit("subject "), "doc_id").alias("subject"), F.lit("Power").alias("category"))
    block = similar.few_shot_similar_block(found, named).collect()
    assert [r["doc_id"] for r in block] == [2]
    assert "  - subject 0 | Power" in block[0]["block"] and "REJECTED" in block[0]["block"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    empty = similar.few_shot_similar(reviewed.limit(0), reviewed.limit(0))
    assert empty.count() == 0
    assert frames.transactions(spark, SF).columns
