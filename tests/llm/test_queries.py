import pytest

from tests.compare import difference, twin
from wordloom.llm.oracles import ORACLES
from wordloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql_twin(spark, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), twin(SF).execute(ORACLES[name]).df()) == ""


COLUMNS = {
    "op1_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op2_html_extract": {"page_id", "url", "text", "n_chars"},
    "op3_lang_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op5_lm_bloom": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op6_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op8_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op9_mixing": {"doc_id", "size", "source_size", "target", "taken"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_row_and_the_asked_columns(spark, name):
    made = QUERIES[name](spark, SF)
    assert COLUMNS[name] <= set(made.columns)
    table = "pages" if "page_id" in made.columns else "documents"
    assert made.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
