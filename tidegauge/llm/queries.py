"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from tidegauge.llm import (byte_bpe, chat_format, disclosure, exact_dedup, language_id,
                           lexical_search, line_dedup, nearest, ngram_join, packing,
                           spelling, suffix_tree, token_counts)

QUERIES = {
    "op1_ngram_join": ngram_join.op1,
    "op2_language_id": language_id.op2,
    "op3_suffix_tree": suffix_tree.op3,
    "op4_token_counts": token_counts.op4,
    "op5_packing": packing.op5,
    "op6_chat_format": chat_format.op6,
    "op7_byte_bpe": byte_bpe.op7,
    "op8_line_dedup": line_dedup.op8,
    "op9_nearest": nearest.op9,
    "op10_exact_dedup": exact_dedup.op10,
    "op11_disclosure": disclosure.op11,
    "op12_spelling": spelling.op12,
    "op13_lexical_search": lexical_search.op13,
}

ORACLES = {
    "op6_chat_format": chat_format.OP6_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op12_spelling": spelling.OP12_SQL,
    "op13_lexical_search": lexical_search.OP13_SQL,
}
