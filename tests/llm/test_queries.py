"""Each query runs on the smallest tables with the columns its contract names."""

import pytest

from fieldpulse.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op2_simhash": ["doc_id", "fingerprint", "component_id"],
    "op3_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op4_toxicity": ["doc_id", "p_low_quality", "p_toxic", "toxic"],
    "op5_ctw": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op6_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op7_mixing": ["doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled"],
    "op8_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op9_fingerprint": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op10_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op11_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op12_align": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert set(COLUMNS[name]) <= set(df.columns)
    table, key = {"op3_warc": ("pages", "page_id"), "op10_chat": ("conversations", "conv_id"), "op13_repair": ("conversations", "conv_id")}.get(name, ("documents", "doc_id"))
    want = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()} | ({-1} if name == "op10_chat" else set())
    ids = [r[key] for r in df.collect()]
    assert set(ids) == want and len(ids) == len(want)


def test_sql_only_for_registered():
    assert set(ORACLE_SQL) <= set(QUERIES)
