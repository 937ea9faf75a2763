"""One small query per predicate, join, aggregate, sort and function family in use."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgermill.functions.calendar import epoch_ms
from ledgermill.functions.values import mean_double
from ledgermill.operators.keys import first_per_key, sorted_places
from ledgermill.plans.frames import table
from ledgermill.plans.registry import query

# --- predicates --------------------------------------------------------------


@query("prim_equal", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def equal(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")


@query(
    "prim_in_list",
    "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus NOT IN ('P')",
)
def in_list(spark, sf):
    kept = F.col("o_orderpriority").isin("1-URGENT", "5-LOW") & ~F.col("o_orderstatus").isin("P")
    return table(spark, sf, "orders").filter(kept).select("o_orderkey")


@query(
    "prim_between",
    "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-07-01' AND DATE '1998-06-30'",
)
def between(spark, sf):
    # The bounds are compared with the raw timestamp, so the filter reaches the scan.
    start, after = F.lit("1997-07-01").cast("timestamp"), F.lit("1998-07-01").cast("timestamp")
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").filter((day >= start) & (day < after)).select("o_orderkey")


def _optional(df, column, value):
    return df if value is None else df.filter(F.col(column) == value)


@query(
    "prim_optional_param",
    "SELECT 'all' AS asked, count(*) AS n FROM orders UNION ALL "
    "SELECT 'one', count(*) FROM orders WHERE o_orderstatus = 'O'",
)
def optional_param(spark, sf):
    orders = table(spark, sf, "orders")

    def counted(label, status):
        rows = _optional(orders, "o_orderstatus", status)
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("asked"), "n")

    return counted("all", None).unionByName(counted("one", "O"))


@query(
    "prim_null_tests",
    "SELECT doc_id, quality IS NULL AS unlabelled FROM documents LEFT JOIN labels USING (doc_id) "
    "WHERE quality IS NULL OR toxic IS NOT NULL",
)
def null_tests(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    kept = F.col("quality").isNull() | F.col("toxic").isNotNull()
    return rows.filter(kept).select("doc_id", F.col("quality").isNull().alias("unlabelled"))


@query("prim_same_text", "SELECT c_custkey FROM customer WHERE lower(c_mktsegment) = lower('BuIlDiNg')")
def same_text(spark, sf):
    same = F.lower("c_mktsegment") == F.lower(F.lit("BuIlDiNg"))
    return table(spark, sf, "customer").filter(same).select("c_custkey")


@query("prim_ilike", "SELECT p_partkey FROM part WHERE p_name ILIKE '%RING%'")
def ilike(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_name").ilike("%RING%")).select("p_partkey")


@query(
    "prim_having",
    "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1 HAVING count(*) > 12",
)
def having(spark, sf):
    grouped = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return grouped.filter(F.col("orders") > 12)


@query(
    "prim_json_key",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events "
    "WHERE json_extract_string(props, '$.k') = '30' AND json_extract(props, '$.none') IS NULL",
)
def json_key(spark, sf):
    key = F.get_json_object("props", "$.k")
    kept = (key == "30") & F.get_json_object("props", "$.none").isNull()
    return table(spark, sf, "events").filter(kept).select("event_id", key.alias("k"))


@query(
    "prim_scalar_subquery",
    "SELECT c_custkey FROM customer WHERE c_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_7')",
)
def scalar_subquery(spark, sf):
    nation = table(spark, sf, "nation").filter(F.col("n_name") == "NATION_7")
    wanted = nation.agg(F.min("n_nationkey")).scalar()
    return table(spark, sf, "customer").filter(F.col("c_nationkey") == wanted).select("c_custkey")


@query(
    "prim_suffix",
    "SELECT page_id FROM pages WHERE lower(url) LIKE '%=x' OR contains(lower(url), '.net/')",
)
def suffix(spark, sf):
    url = F.lower("url")
    return table(spark, sf, "pages").filter(url.endswith("=x") | url.contains(".net/")).select(
        "page_id"
    )


# --- joins -------------------------------------------------------------------


@query(
    "prim_inner_join",
    "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def inner_join(spark, sf):
    nation = table(spark, sf, "nation")
    on = F.col("c_nationkey") == F.col("n_nationkey")
    return table(spark, sf, "customer").join(nation, on).select("c_custkey", "n_name")


@query(
    "prim_left_join",
    "SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM documents LEFT JOIN labels USING (doc_id)",
)
def left_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left").select("doc_id", "quality")


@query(
    "prim_computed_key_join",
    "SELECT o_orderkey, n_name FROM orders LEFT JOIN nation ON n_regionkey = CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 "
    "AND n_nationkey % 12 + 1 = month(o_orderdate)",
)
def computed_key_join(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("n_regionkey"),
        F.month("o_orderdate").alias("month_num"),
    )
    nation = table(spark, sf, "nation").select(
        "n_regionkey", (F.col("n_nationkey") % 12 + 1).alias("month_num"), "n_name"
    )
    return orders.join(nation, ["n_regionkey", "month_num"], "left").select("o_orderkey", "n_name")


@query(
    "prim_unnest",
    "SELECT conv_id, word, pos FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word, "
    "generate_subscripts(string_split(text, ' '), 1) AS pos FROM conversations)",
)
def unnest(spark, sf):
    rows = table(spark, sf, "conversations")
    words = rows.select("conv_id", F.posexplode(F.split("text", " ")).alias("_pos", "word"))
    return words.select("conv_id", "word", (F.col("_pos") + 1).alias("pos"))


@query(
    "prim_update_from",
    "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 499000) AS flagged FROM customer",
)
def update_from(spark, sf):
    large = table(spark, sf, "orders").filter(F.col("o_totalprice") > 499000)
    keys = large.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(True))
    rows = table(spark, sf, "customer").join(keys, "c_custkey", "left")
    return rows.select("c_custkey", F.coalesce("hit", F.lit(False)).alias("flagged"))


@query(
    "prim_conflict_insert",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def conflict_insert(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(
        table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti"
    )


@query(
    "prim_conflict_update",
    "SELECT coalesce(l.doc_id, b.item_id) AS id, CAST(coalesce(l.quality, -1) AS BIGINT) AS quality, b.item_id IS NOT NULL AS hit "
    "FROM labels l FULL JOIN benchmark b ON b.item_id = l.doc_id",
)
def conflict_update(spark, sf):
    labels, items = table(spark, sf, "labels"), table(spark, sf, "benchmark").select("item_id")
    joined = labels.join(items, F.col("doc_id") == F.col("item_id"), "full_outer")
    return joined.select(
        F.coalesce("doc_id", "item_id").alias("id"),
        F.coalesce("quality", F.lit(-1)).alias("quality"),
        F.col("item_id").isNotNull().alias("hit"),
    )


@query(
    "prim_join_grouped",
    "SELECT c_custkey, coalesce(n, 0) AS orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) "
    "ON o_custkey = c_custkey",
)
def join_grouped(spark, sf):
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rows = table(spark, sf, "customer").join(counts, "c_custkey", "left")
    return rows.select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"))


# --- aggregates --------------------------------------------------------------


def _scored(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


_SCORED = "FROM documents LEFT JOIN labels USING (doc_id)"


@query(
    "prim_count",
    f"SELECT source, count(*) AS all_rows, count(quality) AS labelled {_SCORED} GROUP BY 1",
)
def count_rows(spark, sf):
    return _scored(spark, sf).groupBy("source").agg(
        F.count(F.lit(1)).alias("all_rows"), F.count("quality").alias("labelled")
    )


@query(
    "prim_sum_nulls",
    f"SELECT source, CAST(sum(quality) AS BIGINT) AS total, CAST(sum(CASE WHEN source = 'src1' THEN NULL ELSE n_chars END) AS BIGINT) AS chars {_SCORED} GROUP BY 1",
)
def sum_nulls(spark, sf):
    chars = F.when(F.col("source") != "src1", F.col("n_chars"))
    return _scored(spark, sf).groupBy("source").agg(
        F.sum("quality").alias("total"), F.sum(chars).alias("chars")
    )


@query(
    "prim_avg",
    "SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mean FROM orders GROUP BY 1",
)
def avg(spark, sf):
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(mean_double(price).alias("mean"))


@query(
    "prim_min_max",
    "SELECT o_custkey, CAST(min(o_orderdate) AS VARCHAR) AS first, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last, "
    "max(o_orderpriority) AS top_text, min(o_orderkey) AS low_key FROM orders GROUP BY 1",
)
def min_max(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first"),
        F.max("o_orderdate").cast("date").alias("last"),
        F.max("o_orderpriority").alias("top_text"),
        F.min("o_orderkey").alias("low_key"),
    )


@query(
    "prim_conditional_sum",
    "SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS paid, "
    "count(*) FILTER (o_orderstatus = 'O') AS waiting FROM orders GROUP BY 1",
)
def conditional_sum(spark, sf):
    price = F.col("o_totalprice").cast("decimal(12,2)")
    paid = F.when(F.col("o_orderstatus") == "F", price).otherwise(F.lit(0).cast("decimal(12,2)"))
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum(paid).alias("paid"), F.count_if(F.col("o_orderstatus") == "O").alias("waiting")
    )


@query(
    "prim_text_list",
    "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1",
)
def text_list(spark, sf):
    orders = table(spark, sf, "orders")
    orders.createOrReplaceTempView("prim_orders")
    return spark.sql(
        "SELECT o_custkey, listagg(DISTINCT o_orderpriority, ', ') "
        "WITHIN GROUP (ORDER BY o_orderpriority) AS priorities FROM prim_orders GROUP BY o_custkey"
    )


@query(
    "prim_group_expression",
    "SELECT year(o_orderdate) AS y, substr(o_orderpriority, 3) AS p, count(*) AS n FROM orders GROUP BY 1, 2",
)
def group_expression(spark, sf):
    return table(spark, sf, "orders").groupBy(
        F.year("o_orderdate").alias("y"), F.substring("o_orderpriority", 3, 99).alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "prim_count_distinct",
    "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1",
)
def count_distinct(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.countDistinct("o_custkey").alias("customers")
    )


@query("prim_distinct", "SELECT DISTINCT lang, source FROM documents")
def distinct_keys(spark, sf):
    return table(spark, sf, "documents").select("lang", "source").distinct()


@query("prim_run_max", "SELECT epoch_ms(max(ts)) AS newest_ms FROM events")
def run_max(spark, sf):
    return table(spark, sf, "events").agg(
        epoch_ms(F.max("ts").cast("timestamp")).alias("newest_ms")
    )


@query(
    "prim_rollup",
    "SELECT coalesce(lang, 'ALL') AS lang, count(*) AS n FROM documents GROUP BY ROLLUP (lang)",
)
def rollup(spark, sf):
    rolled = table(spark, sf, "documents").rollup("lang").agg(F.count(F.lit(1)).alias("n"))
    return rolled.select(F.coalesce("lang", F.lit("ALL")).alias("lang"), "n")


# --- windows, sorts, limits, sets --------------------------------------------


@query(
    "prim_row_number",
    "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n = 1",
)
def row_number(spark, sf):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return first_per_key(table(spark, sf, "orders"), ["o_custkey"], order).select(
        "o_custkey", "o_orderkey"
    )


@query(
    "prim_rolling",
    """WITH m AS (SELECT o_orderstatus, date_trunc('month', o_orderdate) AS mon, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS v
  FROM orders GROUP BY 1, 2)
SELECT o_orderstatus, CAST(CAST(mon AS DATE) AS VARCHAR) AS mon, CAST(sum(v) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last_three,
  CAST(lag(v) OVER w AS DOUBLE) AS before FROM m WINDOW w AS (PARTITION BY o_orderstatus ORDER BY mon)""",
)
def rolling(spark, sf):
    month = F.trunc("o_orderdate", "MM").alias("mon")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    monthly = table(spark, sf, "orders").groupBy("o_orderstatus", month).agg(F.sum(price).alias("v"))
    order = Window.partitionBy("o_orderstatus").orderBy("mon")
    return monthly.select(
        "o_orderstatus",
        "mon",
        F.sum("v").over(order.rowsBetween(-2, 0)).alias("last_three"),
        F.lag("v").over(order).alias("before"),
    )


@query(
    "prim_sort_keys",
    "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus "
    "ORDER BY o_totalprice, o_orderkey) AS place FROM orders",
)
def sort_keys(spark, sf):
    """All rows, each with its place in the order of its status."""
    keys = [F.col("o_totalprice").asc(), F.col("o_orderkey").asc()]
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sorted_places(rows, [F.col("o_orderstatus")], keys, "place").select("o_orderkey", "place")


@query(
    "prim_nulls_last",
    f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id % 7 ORDER BY quality DESC NULLS LAST, doc_id) AS place "
    f"FROM (SELECT doc_id, quality {_SCORED})",
)
def nulls_last(spark, sf):
    keys = [F.col("quality").desc_nulls_last(), F.col("doc_id").asc()]
    rows = _scored(spark, sf).select("doc_id", "quality")
    return sorted_places(rows, [F.col("doc_id") % 7], keys, "place").select("doc_id", "place")


@query(
    "prim_sort_by_aggregate",
    "SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey % 7 ORDER BY total DESC, o_custkey) AS place FROM "
    "(SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders GROUP BY 1)",
)
def sort_by_aggregate(spark, sf):
    total = F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total")
    grouped = table(spark, sf, "orders").groupBy("o_custkey").agg(total)
    keys = [F.col("total").desc(), F.col("o_custkey").asc()]
    return sorted_places(grouped, [F.col("o_custkey") % 7], keys, "place").select("o_custkey", "place")


@query(
    "prim_first_by_id",
    "SELECT lang, min(doc_id) AS doc_id FROM documents GROUP BY 1",
)
def first_by_id(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.min("doc_id").alias("doc_id"))


@query(
    "prim_union_all",
    "SELECT 'doc' AS kind, doc_id AS id FROM documents UNION ALL SELECT 'item', item_id FROM benchmark",
)
def union_all(spark, sf):
    docs = table(spark, sf, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"))
    items = table(spark, sf, "benchmark").select(
        F.lit("item").alias("kind"), F.col("item_id").alias("id")
    )
    return docs.unionByName(items)


# --- scalar functions --------------------------------------------------------


@query(
    "prim_null_functions",
    f"SELECT doc_id, CAST(coalesce(quality, toxic, -1) AS BIGINT) AS picked, nullif(lang, 'en') AS other_lang {_SCORED}",
)
def null_functions(spark, sf):
    return _scored(spark, sf).select(
        "doc_id",
        F.coalesce("quality", "toxic", F.lit(-1)).alias("picked"),
        F.nullif("lang", F.lit("en")).alias("other_lang"),
    )


@query(
    "prim_case",
    f"SELECT doc_id, CASE WHEN quality = 1 THEN CASE WHEN toxic = 1 THEN 'bad' ELSE 'good' END WHEN quality = 0 THEN 'poor' ELSE 'new' END AS label {_SCORED}",
)
def case(spark, sf):
    nested = F.when(F.col("toxic") == 1, "bad").otherwise("good")
    label = F.when(F.col("quality") == 1, nested).when(F.col("quality") == 0, "poor").otherwise("new")
    return _scored(spark, sf).select("doc_id", label.alias("label"))


@query(
    "prim_casts",
    "SELECT event_id, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INT) AS BIGINT) AS k, TRY_CAST(event_type AS INT) IS NULL AS bad, "
    "CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS amount, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events",
)
def casts(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.col("event_type").try_cast("int").isNull().alias("bad"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
        F.to_date("ts").alias("day"),
    )


@query(
    "prim_math",
    "SELECT c_custkey, CAST(abs(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS size, "
    "CAST(round(CAST(c_acctbal AS DECIMAL(12,2)), 1) AS DOUBLE) AS rounded, c_custkey % 7 AS slot FROM customer",
)
def math(spark, sf):
    balance = F.col("c_acctbal").cast("decimal(12,2)")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.abs(balance).alias("size"),
        F.round(balance, 1).alias("rounded"),
        (F.col("c_custkey") % 7).alias("slot"),
    )


@query(
    "prim_dates",
    "SELECT event_id, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS mon, strftime(ts, '%Y-%m') AS label, "
    "year(ts) AS y, month(ts) AS m, epoch_ms(ts - INTERVAL 3 DAY) AS mark FROM events",
)
def dates(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        "event_id",
        F.trunc(ts, "MM").alias("mon"),
        F.date_format(ts, "yyyy-MM").alias("label"),
        F.year(ts).alias("y"),
        F.month(ts).alias("m"),
        epoch_ms(ts - F.make_dt_interval(days=F.lit(3))).alias("mark"),
    )


@query(
    "prim_strings",
    "SELECT page_id, lower(url) AS low, replace(url, 'http://', '') AS bare, split_part(url, '/', 3) AS host, "
    "trim('  ' || url || ' ') AS trimmed, lpad(CAST(page_id AS VARCHAR), 6, '0') AS padded, "
    "starts_with(url, 'https') AS secure, regexp_replace(url, '[?#].*$', '') AS path FROM pages",
)
def strings(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.lower("url").alias("low"),
        F.replace("url", F.lit("http://"), F.lit("")).alias("bare"),
        F.split_part("url", F.lit("/"), F.lit(3)).alias("host"),
        F.trim(F.concat(F.lit("  "), "url", F.lit(" "))).alias("trimmed"),
        F.lpad(F.col("page_id").cast("string"), 6, "0").alias("padded"),
        F.col("url").startswith("https").alias("secure"),
        F.regexp_replace("url", "[?#].*$", "").alias("path"),
    )


@query(
    "prim_url_text",
    "SELECT page_id, url AS decoded, replace(url_encode(url), '%20', '+') AS encoded FROM pages",
)
def url_text(spark, sf):
    encoded = F.url_encode("url")
    return table(spark, sf, "pages").select(
        "page_id", F.url_decode(encoded).alias("decoded"), encoded.alias("encoded")
    )


@query(
    "prim_json",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS kind, 2 AS items FROM events",
)
def json(spark, sf):
    merged = F.to_json(
        F.struct(
            F.from_json("props", "k INT")["k"].alias("k"),
            F.col("event_type").alias("kind"),
            F.array(F.lit(1), F.lit(2)).alias("list"),
        )
    )
    parsed = table(spark, sf, "events").select("event_id", merged.alias("j")).withColumn(
        "p", F.from_json("j", "k BIGINT, kind STRING, list ARRAY<INT>")
    )
    return parsed.select("event_id", "p.k", "p.kind", F.size("p.list").alias("items"))


@query(
    "prim_arrays",
    "SELECT doc_id, len(list_filter(w, lambda x: length(x) > 8)) AS long_words, list_max(list_transform(w, lambda x: length(x))) AS longest "
    "FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)",
)
def arrays(spark, sf):
    words = F.split("text", " ")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.size(F.filter(words, lambda w: F.length(w) > 8)).alias("long_words"),
        F.array_max(F.transform(words, lambda w: F.length(w))).alias("longest"),
    )


@query(
    "prim_maps",
    "SELECT doc_id, coalesce(CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' END, 'other') AS language FROM documents",
)
def maps(spark, sf):
    names = F.create_map(F.lit("en"), F.lit("English"), F.lit("de"), F.lit("German"))
    return table(spark, sf, "documents").select(
        "doc_id", F.coalesce(F.try_element_at(names, F.col("lang")), F.lit("other")).alias("language")
    )


@query(
    "prim_crypto",
    "SELECT doc_id, sha256(text) AS digest, to_base64(encode(lang)) AS coded FROM documents",
)
def crypto(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.sha2("text", 256).alias("digest"),
        F.base64(F.encode("lang", "UTF-8")).alias("coded"),
    )
