"""Every registered query of this subpackage, and the pipeline, over a small table set."""

from __future__ import annotations

import random

import duckdb
import pytest

import corpus_pipeline
from ledgermill.llm import queries as registered
from ledgermill.llm.common import prepared, stored
from tests.conftest import SF

COLUMNS = {
    "op1_ann": ("query_id rank vec_id score", "embeddings"),
    "op2_simhash": ("doc_id fingerprint component_id", "documents"),
    "op3_toxicity": ("doc_id held_out score predicted", "documents"),
    "op4_quality": ("doc_id held_out score predicted", "documents"),
    "op5_warc": ("page_id payload_bytes payload_digest record_type refers_to", "pages"),
    "op6_pii": ("doc_id n_email n_ip n_card n_phone base_sha256 spans", "documents"),
    "op7_mixing": ("doc_id size source_size target taken", "documents"),
    "op8_chat": ("conv_id place turn role rendered cost", "conversations"),
    "op9_packing": ("doc_id start length ids_crc32 doc_tokens sequence_id offset", "documents"),
    "op10_exact_dedup": ("doc_id keep_id group_size kept text_sha256", "documents"),
    "op11_filter_audit": (
        "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
        "documents",
    ),
    "op12_suffix": ("doc_id n_bytes n_removed n_spans kept_sha256", "documents"),
    "op13_centroids": (
        "vec_id cluster distance cluster_inertia inertia centroid_sha256",
        "embeddings",
    ),
}


def test_all_operators_are_registered():
    assert set(registered.queries()) == set(COLUMNS)
    assert set(registered.oracle_sql()) <= set(COLUMNS)


@pytest.mark.parametrize("name", COLUMNS)
def test_query_returns_its_columns_for_its_whole_table(spark, name):
    columns, table = COLUMNS[name]
    found = registered.queries()[name](spark, SF)
    rows = found.select(*columns.split()).collect()
    expected = spark.read.parquet(f"{SF}/{table}.parquet")
    key = expected.columns[0]
    if name == "op1_ann":
        queries = expected.where("vec_id % 100 = 0").count()
        assert len(rows) == queries * 10
    elif name == "op9_packing":
        assert {r["doc_id"] for r in rows} == {r[key] for r in expected.select(key).collect()}
    elif name == "op11_filter_audit":
        assert len(rows) == 600 * expected.select("lang").distinct().count()
    else:
        assert len(rows) == expected.count()
    if name in registered.oracle_sql():
        base = duckdb.connect()
        for view in {table, "labels"}:
            base.sql(f"CREATE VIEW {view} AS SELECT * FROM '{SF}/{view}.parquet'")
        wanted = base.sql(registered.oracle_sql()[name])
        order = [wanted.columns.index(c) for c in columns.split()]
        assert sorted(map(repr, (tuple(r[i] for i in order) for r in wanted.fetchall()))) == sorted(
            map(repr, map(tuple, rows))
        )


def test_pipeline_stages_keep_the_columns_and_pass_on_what_they_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(prepared(spark), docs, SF), "stage")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.ORACLE_SQL is None
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_over_odd_rows_and_an_empty_table(spark, folder):
    good = "one two three four five six seven eight nine ten " * 4
    rng = random.Random(4)
    made = [" ".join(f"w{rng.randrange(300)}" for _ in range(60)) for _ in range(60)]
    rows = [(i, f"{made[i]} number {i} of it", "en", f"s{i % 3}", 9, i) for i in range(60)]
    rows += [(100 + i, "NOISE!! " * 40 + str(i), "en", "s0", 9, i) for i in range(60)]
    rows += [(300, None, None, None, None, None), (301, "", "en", None, 0, 1), (5, *rows[5][1:])]
    rows += [(None, good, "en", "s1", 9, 9), (400, "word " * 30000, "en", "hot", 9, 9)]
    rows += [(500 + i, good.upper(), "en", "hot", 9, 9) for i in range(50)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_no int"
    labels = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(60)]
    labels += [(None, 1, 1), (3, None, None)]
    for name, docs, marks in (("odd", rows, labels), ("none", [], [])):
        path = f"{folder}/{name}"
        spark.createDataFrame(docs, schema).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(
            f"{path}/labels.parquet"
        )
        found = spark.read.parquet(f"{path}/documents.parquet")
        for step, stage in corpus_pipeline.STAGES[:-1]:
            found = stored(stage(prepared(spark), found, path), "stage")
            assert found.columns == schema.replace(" long", "").replace(" string", "").replace(
                " int", ""
            ).split(", "), step
        packed = corpus_pipeline.run(spark, path).collect()
        assert bool(packed) == bool(docs)
        if docs:
            assert found.where("text LIKE 'NOISE%'").count() == 0
            texts = [r["text"] for r in found.collect() if r["text"]]
            assert any("number 5 of" in t for t in texts)
