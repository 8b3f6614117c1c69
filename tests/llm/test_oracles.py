"""Every registered operator query: against its SQL where there is one, else complete rows."""

import pytest

import __spark_entry__ as E
from eventlake.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_like_sql(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["rows"] == r["oracle_rows"] and r["match"]


@pytest.mark.parametrize("name, source", [("op7_near_dedup", "documents"), ("op9_language_id", "documents"), ("op10_html_extract", "pages"), ("op12_personal_data", "documents")])
def test_a_row_for_every_row(spark, name, source):
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{source}.parquet").count()


def test_contract_columns(spark):
    want = {
        "op1_substring_dedup": "doc_id long n_words long n_removed long kept_sha256 string",
        "op2_mix_sources": "doc_id long size long source_size long target double taken long",
        "op3_suffix_dedup": "doc_id long n_bytes long n_removed long n_spans long kept_sha256 string",
        "op6_line_quality": "doc_id long n_words long word_chars long n_symbols long n_dup_lines long n_repeat_words long base_failed boolean kept boolean",
        "op9_language_id": "doc_id long held_out boolean lang_pred string score double",
        "op10_html_extract": "page_id long url string text string n_chars long",
        "op11_periodic_runs": "doc_id long n_runs long start long length long period long exponent_milli long runs_sha256 string collapsed_sha256 string",
        "op12_personal_data": "doc_id long n_email long n_ip long n_card long n_phone long base_sha256 string spans string",
        "op13_hard_negatives": "anchor_id long positive_id long rank integer negative_id long positive_score long negative_score long",
    }
    for name, columns in want.items():
        kinds = {f.name: f.dataType.typeName() for f in QUERIES[name](spark, SF).schema}
        words = columns.split()
        assert {c: kinds[c] for c in words[::2]} == dict(zip(words[::2], words[1::2], strict=True))
