"""The operators' registered queries and their SQL."""

from __future__ import annotations

from casewatch.llm import chat, collocations, decontam, hmm, langid, line_dedup, ngram_join, packing, prefix_trie, quality, secrets, toxicity, urls

QUERIES = {
    "op1_line_dedup": line_dedup.op1,
    "op2_lm_scoring": hmm.op2,
    "op3_ngram_join": ngram_join.op3,
    "op4_decontamination": decontam.op4,
    "op5_quality_rules": quality.op5,
    "op6_url_filters": urls.op6,
    "op7_secret_scan": secrets.op7,
    "op8_language_id": langid.op8,
    "op9_packing": packing.op9,
    "op10_chat_formatting": chat.op10,
    "op11_collocations": collocations.op11,
    "op12_toxicity": toxicity.op12,
    "op13_prefix_trie": prefix_trie.op13,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op3_ngram_join": ngram_join.OP3_SQL,
    "op4_decontamination": decontam.OP4_SQL,
    "op5_quality_rules": quality.OP5_SQL,
    "op7_secret_scan": secrets.OP7_SQL,
    "op10_chat_formatting": chat.OP10_SQL,
    "op11_collocations": collocations.OP11_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
