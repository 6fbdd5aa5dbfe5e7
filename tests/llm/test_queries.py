"""The registered queries of the subpackage."""

from tests.llm.conftest import SMALL

from clickfeat.llm import registry


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14))


def test_results_have_their_contracts_columns(spark, small):
    small("documents")
    wanted = {
        "op1_exact_dedup": "doc_id keep_id group_size kept text_sha256",
        "op2_mixing": "doc_id size source_size target taken",
        "op3_warc": "page_id payload_bytes payload_digest record_type refers_to",
        "op4_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        "op6_html_extraction": "page_id url text n_chars",
        "op7_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op8_language_id": "doc_id held_out lang_pred score",
        "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words"
        " base_failed kept",
        "op10_near_dedup": "doc_id n_shingles component_id kept",
        "op11_whitening": "vec_id component n deviation whitened explained identity_error",
        "op12_source_divergence": "lang source part item value rank",
        "op13_quality_classifier": "doc_id held_out score predicted",
    }
    for name, columns in wanted.items():
        result = registry.QUERIES[name](spark, str(SMALL))
        assert set(columns.split()) <= set(result.columns), name
