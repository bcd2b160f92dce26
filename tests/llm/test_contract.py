"""Registered queries and the pipeline."""

import collections

import duckdb
import pytest

import corpus_pipeline
from rowloom.llm.queries import QUERIES, SQL
from rowloom.llm.spaced_seeds import contaminated
from tests.llm import odd

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found, want = QUERIES[name](spark, SF), con.sql(SQL[name])
    columns = sorted(found.columns)
    assert columns == sorted(want.columns)
    place = [want.columns.index(c) for c in columns]
    got = sorted(([r[c] for c in columns] for r in found.collect()), key=repr)
    assert got == sorted(([r[i] for i in place] for r in want.fetchall()), key=repr) and got


COLUMNS = {
    "op1": "page_id bigint, url string, text string, n_chars bigint",
    "op2": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op7": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op9": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op10": "doc_id bigint, fingerprint string, component_id bigint",
    "op11": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op12": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op13": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
}


@pytest.mark.parametrize("op", sorted(COLUMNS))
def test_columns_of_the_contracts(spark, op):
    found = next(q for name, q in QUERIES.items() if name.split("_")[0] == op)(spark, SF)
    kinds = [f"{c} {k}" for c, k in found.dtypes]
    assert kinds[: COLUMNS[op].count(",") + 1] == COLUMNS[op].split(", ")
    assert found.count() == spark.read.parquet(f"{SF}/{'pages' if op == 'op1' else 'documents'}.parquet").count()


def test_stages_on_odd_documents(spark, tmp_path):
    docs = odd.documents(spark)
    docs.write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    columns, was = docs.columns, docs.count()
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        none = stage(spark, docs.limit(0), SF)
        assert none.count() == 0 and (none.columns == columns or n == len(corpus_pipeline.STAGES) - 1)
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        if n < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        if n < 3:
            assert docs.count() <= was
            was = docs.count()


def test_pipeline_decides(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = stages["quality classifier"](spark, docs, sf)
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    judged = collections.Counter((labels[r.doc_id], r.doc_id in kept) for r in docs.select("doc_id").collect() if r.doc_id in labels)
    assert judged[1, False] == 0 and judged[0, True] <= 1
    leaky = {r.doc_id for r in contaminated(good, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    clean = stages["benchmark decontamination"](spark, good, sf)
    assert leaky and {r.doc_id for r in clean.select("doc_id").collect()} == kept - leaky


def test_run_gives_shards_of_what_is_left(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert out and all(sorted(s) == list(range(len(s))) for s in slots.values())
