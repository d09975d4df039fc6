"""Registered queries run on the smallest tables; the pipeline against its stages; the guard."""

import subprocess
import sys

import pytest
from conftest import ROOT, SMALL_SF
from oracle_compare import compare, duck

import corpus_pipeline
from dimforge.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op3_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op5_embeddings": ["vec_id", "n_links", "component_id", "kept"],
    "op6_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op7_token_counts": ["doc_id", "n_tokens"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op10_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op11_fill_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op12_lexical_search": ["item_id", "rank", "doc_id", "score"],
    "op13_line_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_a_row_for_each_input(spark, name):
    df = QUERIES[name](spark, SMALL_SF)
    assert df.columns[:len(COLUMNS[name])] == COLUMNS[name]
    table = {"op4_warc": "pages", "op5_embeddings": "embeddings", "op12_lexical_search": "benchmark"}.get(name, "documents")
    key = df.columns[0]
    rows = spark.read.parquet(f"{SMALL_SF}/{table}.parquet")
    assert df.select(key).distinct().count() == rows.count()
    if name not in ("op3_packing", "op12_lexical_search"):
        assert df.count() == rows.count()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    result = compare(QUERIES[name](spark, SMALL_SF), duck(SMALL_SF), ORACLE_SQL[name])
    assert result["ok"], result


def test_pipeline_is_its_stages(spark):
    docs = spark.read.parquet(f"{SMALL_SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL_SF)
        if name != "packing":
            assert out.columns == docs.columns, name
            before, docs = docs, spark.createDataFrame(out.collect(), out.schema)
            assert docs.select("doc_id").distinct().subtract(before.select("doc_id")).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_dedup", "mixing", "packing"]
    whole = corpus_pipeline.run(spark, SMALL_SF)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, out.select(*key).collect()))


def test_library_imports_without_the_subpackage(tmp_path):
    """The entry module runs where llm and the pipeline are missing, and nowhere hides other errors."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "dimforge.llm" or name.startswith("dimforge.llm.") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
assert "conformed_plan" in entry.queries() and not [q for q in entry.queries() if q.startswith("op")]
assert "pipeline" not in entry.queries()
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
