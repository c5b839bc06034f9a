"""The numbered queries and the SQL that gives their rows."""

from __future__ import annotations

import corpus_pipeline

from . import conversation_repair, conversation_trie, exact_dedup, mixing, parity_join, prefix_table, secrets, token_counts, token_files, toxicity, url_reputation, warc, weak_quality

LLM_QUERIES = {
    "op1_url_reputation": url_reputation.op1_url_reputation,
    "op2_warc": warc.op2_warc,
    "op3_secrets": secrets.op3_secrets,
    "op4_token_files": token_files.op4_token_files,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_mixing": mixing.op6_mixing,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_weak_quality": weak_quality.op8_weak_quality,
    "op9_prefix_table": prefix_table.op9_prefix_table,
    "op10_parity_join": parity_join.op10_parity_join,
    "op11_conversation_trie": conversation_trie.op11_conversation_trie,
    "op12_token_counts": token_counts.op12_token_counts,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}
LLM_SQL = {
    "op1_url_reputation": url_reputation.SQL_OP1,
    "op2_warc": warc.SQL_OP2,
    "op6_mixing": mixing.SQL_OP6,
    "op7_exact_dedup": exact_dedup.SQL_OP7,
    "op8_weak_quality": weak_quality.SQL_OP8,
    "op11_conversation_trie": conversation_trie.SQL_OP11,
    "op13_conversation_repair": conversation_repair.SQL_OP13,
}
