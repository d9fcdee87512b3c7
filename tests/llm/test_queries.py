import pytest

import corpus_pipeline
from costmart.llm.queries import ORACLE_SQL, QUERIES

from ..compare import canon, duck, run_sql

COLUMNS = {
    "op1": ["doc_id", "held_out", "score", "predicted"],
    "op2": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op3": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op5": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op6": ["doc_id", "n_shingles", "component_id", "kept"],
    "op7": ["doc_id", "contaminated"],
    "op8": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op9": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10": ["doc_id", "n_removed"],
    "op11": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op12": ["doc_id", "n_shingles", "component_id"],
    "op13": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
}
#: Queries over other tables than documents: the table and the id of its rows (or groups).
OVER = {"op11": ("embeddings", "vec_id"), "op13": ("conversations", "conv_id")}


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_one_row_for_each_document(llm, sf_dir, name):
    out = QUERIES[name](llm, sf_dir)
    op = name.split("_")[0]
    wanted, (source, key) = COLUMNS[op], OVER.get(op, ("documents", "doc_id"))
    assert out.columns[:len(wanted)] == wanted or set(wanted) <= set(out.columns)
    rows = llm.read.parquet(f"{sf_dir}/{source}.parquet").select(key)
    ids = sorted(r[key] for r in (rows if source == "documents" else rows.distinct()).collect())
    assert sorted(r[key] for r in out.collect()) == ids


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_its_sql(llm, sf_dir, name):
    out = QUERIES[name](llm, sf_dir)
    columns, rows = run_sql(duck(sf_dir), ORACLE_SQL[name])
    assert sorted(columns) == sorted(out.columns)
    assert canon(out.columns, [tuple(r) for r in out.collect()]) == canon(columns, rows)


def test_pipeline_stages(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(llm, docs, sf_dir)
        assert docs.columns == columns, name
        docs = docs.checkpoint()
        assert 0.5 * before < docs.count() <= before, name
        assert all(r["n_chars"] == len(r["text"]) for r in docs.select("n_chars", "text").collect()), name
        before = docs.count()
    kept = sorted(r["doc_id"] for r in docs.collect())
    assert sorted(r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](llm, docs, sf_dir).collect()) == kept
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(llm, sf_dir).collect()) == kept


def test_stages_on_an_empty_table(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm, docs, sf_dir).count() == 0
