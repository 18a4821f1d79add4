"""The operators' queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickflow.llm import ann, bpe, chat, exact_dedup, filter_audit, html_text, jaccard_join, mixing, personal_data, sharding, token_align, token_counts, toxicity
from tickflow.llm.common import read_table


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep_text=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_sharding": sharding.op2_sharding,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_mixing": mixing.op4_mixing,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_html_extraction": html_text.op6_html_extraction,
    "op7_ngram_jaccard_join": jaccard_join.op7_ngram_jaccard_join,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_nearest_neighbours": ann.op9_nearest_neighbours,
    "op10_chat_formatting": chat.op10_chat_formatting,
    "op11_personal_data": personal_data.op11_personal_data,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_token_alignment": token_align.op13_token_alignment,
}

ORACLE = {
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op7_ngram_jaccard_join": jaccard_join.OP7_SQL,
    "op10_chat_formatting": chat.OP10_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
}
