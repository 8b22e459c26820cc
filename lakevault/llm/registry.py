"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from lakevault.llm import chunkbpe, convtrie, filteraudit, mixing, neardup, pieces, pii, quality, secrets, suffixdedup, topk, toxicity, warc

LLM_QUERIES = {
    "op1_suffix_dedup": suffixdedup.op1_suffix_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_minhash_components": neardup.op3_minhash_components,
    "op4_source_mixing": mixing.op4_source_mixing,
    "op5_bit_sliced_topk": topk.op5_bit_sliced_topk,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op8_personal_data": pii.op8_personal_data,
    "op9_sentencepiece": pieces.op9_sentencepiece,
    "op10_warc": warc.op10_warc,
    "op11_filter_audit": filteraudit.op11_filter_audit,
    "op12_chunk_bpe": chunkbpe.op12_chunk_bpe,
    "op13_conversation_trie": convtrie.op13_conversation_trie,
}

LLM_SQL = {
    "op1_suffix_dedup": suffixdedup.OP1_SQL,
    "op3_minhash_components": neardup.OP3_SQL,
    "op4_source_mixing": mixing.OP4_SQL,
    "op5_bit_sliced_topk": topk.OP5_SQL,
    "op6_quality_rules": quality.OP6_SQL,
    "op7_secret_scan": secrets.OP7_SQL,
    "op10_warc": warc.OP10_SQL,
    "op11_filter_audit": filteraudit.OP11_SQL,
    "op13_conversation_trie": convtrie.OP13_SQL,
}
