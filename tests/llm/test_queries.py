"""Every query over the small tables: against its SQL, or by rules its contract states."""

import pytest

from suarakit.llm.queries import QUERIES, SQL
from tests.compare import differences

CONTRACT = {
    "op1_warc_chunks": "page_id payload_bytes payload_digest record_type refers_to",
    "op2_winnowing": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3_ordinal_grades": "doc_id expected_grade tail_probability kept",
    "op4_secret_ownership": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op5_entropy_balancing": "doc_id size source_size target taken",
    "op6_context_tree": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op7_bottom_k": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op8_simhash": "doc_id fingerprint component_id",
    "op9_line_chunks": "doc_id text words_removed",
    "op10_language_mixture": "doc_id held_out lang_pred score",
    "op11_collocations": "lang rank phrase a l r n score",
    "op12_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13_block_labels": "page_id url text n_chars",
}


@pytest.mark.parametrize("name", list(CONTRACT))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert set(CONTRACT[name].split()) <= set(df.columns)
    if name in SQL:
        assert differences(df, SQL[name], sf_dir) is None
        return
    table, key = "documents", df.columns[0]
    ids = sorted(r[0] for r in df.select(key).collect())
    wanted = sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect())
    assert ids == wanted


def test_all_are_registered():
    import __spark_entry__ as entry

    assert set(CONTRACT) | {"pipeline"} == set(QUERIES) and set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
