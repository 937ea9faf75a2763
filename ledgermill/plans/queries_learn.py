"""Learned and rule-based classification of transactions, and similar reviewed examples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgermill.operators import baselines, learned, merchants, similar
from ledgermill.plans import frames
from ledgermill.plans.frames import with_frames
from ledgermill.plans.registry import query
from ledgermill.session import kept_copy, scratch_dir

# --- naive Bayes -------------------------------------------------------------

# A fifth of the transactions is held out; the model never sees their categories.
_HELD_OUT = "txn_id % 5 = 2"

_TOKENS_SQL = (
    "list_transform(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+'), "
    "lambda w: CASE WHEN regexp_matches(w, '\\p{{N}}') THEN '#' ELSE w END)"
)

_LEARNED_SQL = (
    with_frames("txn")
    + f""", tok AS (SELECT txn_id, category_id AS c, {_HELD_OUT} AS held_out,
  unnest({_TOKENS_SQL.format(text="description_raw")}) AS t FROM txn),
counted AS (SELECT t, c, count(*) AS n FROM tok WHERE c IS NOT NULL AND NOT held_out GROUP BY ALL),
known AS (SELECT category_id AS c, count(*) AS m FROM txn
  WHERE category_id IS NOT NULL AND NOT ({_HELD_OUT}) GROUP BY 1),
cats AS (SELECT c, CAST(round(ln(m / (SELECT CAST(sum(m) AS DOUBLE) FROM known)) * 1000000) AS BIGINT) AS prior,
  -CAST(round(ln(coalesce((SELECT sum(n) FROM counted WHERE counted.c = known.c), 0)
    + (SELECT count(DISTINCT t) FROM counted)) * 1000000) AS BIGINT) AS fallback FROM known),
weights AS (SELECT t, c, CAST(round(ln(n + 1) * 1000000) AS BIGINT) AS w FROM counted),
sums AS (SELECT txn_id, weights.c, sum(w) AS s FROM tok JOIN weights USING (t) GROUP BY ALL),
sizes AS (SELECT txn_id, count(*) AS k FROM tok GROUP BY 1),
scores AS (SELECT txn.txn_id, cats.c, coalesce(s, 0) + prior + coalesce(k, 0) * fallback AS score
  FROM txn CROSS JOIN cats LEFT JOIN sums ON sums.txn_id = txn.txn_id AND sums.c = cats.c
  LEFT JOIN sizes ON sizes.txn_id = txn.txn_id),
best AS (SELECT txn_id, min(c) FILTER (score = top) AS predicted,
  1 / sum(exp((score - top) / 1000000.0)) AS posterior
  FROM (SELECT *, max(score) OVER (PARTITION BY txn_id) AS top FROM scores) GROUP BY 1)
"""
)


def _learned_rows(spark, sf):
    rows = frames.transactions(spark, sf).withColumn("held_out", F.expr(_HELD_OUT))
    model = learned.train(rows.filter("NOT held_out"), "description_raw", "category_id")
    found = learned.predict(rows, model, "txn_id", "description_raw")
    return rows.select("txn_id", "category_id", "held_out").join(found, "txn_id")


@query(
    "class_learned",
    _LEARNED_SQL
    + f"""SELECT txn_id, CAST(category_id AS BIGINT) AS category_id, {_HELD_OUT} AS held_out,
  CAST(predicted AS BIGINT) AS predicted, CAST(round(posterior, 3) AS DOUBLE) AS confidence
FROM txn JOIN best USING (txn_id)""",
)
def class_learned(spark, sf):
    """Category of every transaction by a model that was fitted on four fifths of them."""
    return _learned_rows(spark, sf)


@query(
    "class_learned_accuracy",
    _LEARNED_SQL
    + f"""SELECT {_HELD_OUT} AS held_out, count(*) AS rows, count(*) FILTER (predicted = category_id) AS right,
  round(count(*) FILTER (predicted = category_id) / count(*), 4) AS accuracy
FROM txn JOIN best USING (txn_id) WHERE category_id IS NOT NULL GROUP BY 1""".replace(" AS right", ' AS "right"').replace(" AS rows", ' AS "rows"'),
)
def class_learned_accuracy(spark, sf):
    """Share of right categories among held-out and among learned rows."""
    rows = _learned_rows(spark, sf).filter("category_id IS NOT NULL")
    return learned.accuracy(rows, "category_id", "held_out")


# --- merchant rules ----------------------------------------------------------

# Every part is a merchant phrase of three or four tokens; some are prefixes of others.
_RULE_COLUMNS = {
    "rule_id": "p_partkey",
    "phrase": "CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN concat(p_name, ' ', p_brand) "
    "ELSE concat(p_name, ' ', p_brand, ' ', p_type) END",
    "priority": "CAST(p_partkey % 7 AS INT)",
    "category_id": "CAST(1 + p_partkey % 30 AS INT)",
    "subcategory": "p_type",
    "is_deductible": "p_size % 2 = 0",
}
_SPENT = "concat('POS ', upper(p_name), ' - ', p_brand, '  ', p_type, ' ', l_orderkey)"

# Lines that agree in all of these are one payment.
_TXN = "concat(l_orderkey, '-', l_linenumber, '-', l_suppkey, '-', l_partkey)"

_WORDS_SQL = "array_to_string(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+'), ' ')"


def _merchant_txns(spark, sf):
    """Order lines as card payments whose text names the part."""
    parts = frames.table(spark, sf, "part").selectExpr("p_partkey", "p_name", "p_brand", "p_type")
    lines = frames.table(spark, sf, "lineitem").join(parts, F.expr("l_partkey = p_partkey"))
    return lines.selectExpr(
        f"{_TXN} AS txn_id", f"{_SPENT} AS description_clean"
    ).distinct()


@query(
    "merchant_rules",
    "WITH rules AS (SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in _RULE_COLUMNS.items())
    + f""" FROM part),
phrases AS (SELECT *, {_WORDS_SQL.format(text="phrase")} AS p FROM rules),
said AS (SELECT DISTINCT {_TXN} AS txn_id, {_SPENT} AS d
  FROM lineitem JOIN part ON l_partkey = p_partkey),
texts AS (SELECT DISTINCT d, regexp_extract_all(lower(d), '[\\p{{L}}\\p{{N}}]+') AS w FROM said),
grams AS (SELECT d, array_to_string(w[i:i + k], ' ') AS p
  FROM (SELECT d, w, unnest(range(1, len(w) + 1)) AS i FROM texts), (SELECT unnest(range(0, 5)) AS k)
  WHERE i + k <= len(w)),
best AS (SELECT d, min(struct_pack(priority := priority, l := -len(string_split(p, ' ')), rule_id := rule_id)) AS b
  FROM grams JOIN phrases USING (p) GROUP BY 1)
SELECT txn_id, b.rule_id AS rule_id, CAST(category_id AS BIGINT) AS category_id, subcategory, is_deductible
FROM said LEFT JOIN best USING (d) LEFT JOIN rules ON rules.rule_id = b.rule_id""",
)
def merchant_rules(spark, sf):
    """Card payments classified by as many rules as there are parts."""
    rules = frames.table(spark, sf, "part").selectExpr(
        *[f"{sql} AS {name}" for name, sql in _RULE_COLUMNS.items()]
    )
    found = merchants.classify_by_merchant(_merchant_txns(spark, sf), rules)
    return found.select("txn_id", "rule_id", "category_id", "subcategory", "is_deductible")


# --- similar examples --------------------------------------------------------

_TERMS_SQL = "list_distinct(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+'))"

# Documents that nobody has decided on are asked for.
_OPEN = "review_status NOT IN ('CONFIRMED', 'REJECTED')"


@query(
    "few_shot_similar",
    with_frames("docs")
    + f""", t AS (SELECT doc_id, review_status, reviewed_at, unnest({_TERMS_SQL.format(text="text")}) AS term
  FROM docs JOIN documents USING (doc_id)),
decided AS (SELECT * FROM docs WHERE review_status IN ('CONFIRMED', 'REJECTED')),
weights AS (SELECT term, CAST(round(ln(1 + (SELECT count(*) FROM decided) / CAST(count(*) AS DOUBLE)) * 1000000) AS BIGINT) AS w
  FROM t WHERE review_status IN ('CONFIRMED', 'REJECTED') GROUP BY 1),
key_terms AS (SELECT doc_id, term, w, review_status, reviewed_at FROM t JOIN weights USING (term)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term) <= 12),
scored AS (SELECT a.doc_id, b.doc_id AS example_id, b.review_status, b.reviewed_at, sum(a.w) AS score
  FROM key_terms a JOIN key_terms b USING (term)
  WHERE a.{_OPEN} AND b.review_status IN ('CONFIRMED', 'REJECTED') GROUP BY ALL)
SELECT doc_id, review_status, row_number() OVER w AS rank, example_id, CAST(score AS BIGINT) AS score FROM scored
WINDOW w AS (PARTITION BY doc_id, review_status ORDER BY score DESC, reviewed_at DESC NULLS LAST, example_id)
QUALIFY row_number() OVER w <= 5""",
)
def few_shot_similar(spark, sf):
    """Five confirmed and five rejected examples that are most like each open document."""
    texts = frames.table(spark, sf, "documents").select("doc_id", "text")
    docs = frames.core_documents(spark, sf).select("doc_id", "review_status", "reviewed_at")
    # Texts are read three times: for the weights, the examples and the documents.
    docs = kept_copy(docs.join(texts, "doc_id"), "reviewed")
    return similar.few_shot_similar(docs.filter(_OPEN), docs)


# --- outliers by a baseline of months ----------------------------------------


@query(
    "outlier_median",
    with_frames("txn")
    + """, a AS (SELECT txn_id, category_id, amount, CAST(date_trunc('month', txn_date) AS DATE) AS m,
  abs(amount) AS x FROM txn WHERE category_id IS NOT NULL),
months AS (SELECT DISTINCT category_id, m FROM a),
lists AS (SELECT months.category_id, months.m, list_sort(list(CAST(x AS DOUBLE))) AS l
  FROM months JOIN a ON a.category_id = months.category_id AND a.m < months.m
    AND a.m >= months.m - INTERVAL 12 MONTH GROUP BY 1, 2),
q AS (SELECT *, l[CAST(ceil(0.25 * len(l)) AS INT)] AS lo, l[CAST(ceil(0.5 * len(l)) AS INT)] AS median,
  l[CAST(ceil(0.75 * len(l)) AS INT)] AS hi FROM lists WHERE len(l) >= 5)
SELECT txn_id, CAST(a.category_id AS BIGINT) AS category_id, CAST(a.amount AS DOUBLE) AS amount, median
FROM a JOIN q ON q.category_id = a.category_id AND q.m = a.m
WHERE CAST(x AS DECIMAL(18,4)) > CAST(hi + 0.25 * (hi - lo) AS DECIMAL(18,4))""",
)
def outlier_median(spark, sf):
    """Amounts above the baseline of twelve months; sketches are stored month by month.

    At the compared sizes a year of a category fits a sketch whole, so it is exact there.
    """
    path = scratch_dir(spark, "sketches")
    txns = frames.transactions(spark, sf)
    # Two runs: what was known before 1998, then the months since.
    for part in ("txn_date < DATE'1998-01-01'", "txn_date >= DATE'1998-01-01'"):
        baselines.write_months(baselines.month_sketches(txns.filter(part)), path)
    known = baselines.month_baselines(baselines.read_months(spark, path))
    found = baselines.median_outliers(txns, known, spreads=0.25)
    return found.select("txn_id", "category_id", "amount", "median")
