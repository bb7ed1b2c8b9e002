"""Registered queries against their reference SQL, and their contracts' columns."""

import pytest

import __spark_entry__ as driver
from castledger.llm import queries
from compare import connect, mismatch

COLUMNS = {
    1: "doc_id n_bytes n_removed n_spans kept_sha256",
    2: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    3: "doc_id n_shingles component_id kept",
    4: "doc_id n_words n_base first_word last_word base_labels labels score",
    5: "doc_id held_out lang_pred score",
    6: "doc_id n_words n_hit n_items items_sha256 contaminated",
    7: "doc_id n_tokens",
    8: "doc_id n_removed",
    9: "doc_id score kept",
    10: "doc_id n_tokens ids_sha256 decoded_sha256",
    11: "item_id rank doc_id score",
    12: "doc_id n_shingles component_id",
    13: "vec_id component n deviation whitened explained identity_error",
}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_reference(spark, folder, name):
    assert mismatch(queries.queries()[name](spark, folder), connect(folder), queries.oracle_sql()[name]) is None


def test_each_operator_is_registered_once():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_one_row_per_document(spark, folder, name):
    found = queries.queries()[name](spark, folder)
    assert set(COLUMNS[int(name[2:].split("_")[0])].split()) <= set(found.columns)
    if name.startswith("op11"):  # 20 for each item at most
        assert 0 < found.groupBy("item_id").count().agg({"count": "max"}).first()[0] <= 20
        return
    if name.startswith("op13"):
        assert found.count() == 16 * spark.read.parquet(f"{folder}/embeddings.parquet").count()
        return
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == sorted(
        r.doc_id for r in docs.select("doc_id").collect())
