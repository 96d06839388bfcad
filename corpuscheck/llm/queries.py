"""Registered queries of the subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from corpuscheck.llm import op11_trie, op4_rlz, op5_urls, op6_lines, op7_jaccard, op9_revisits
from corpuscheck.llm.op1_mil import op1_attention_mil
from corpuscheck.llm.op2_hpylm import op2_hpylm
from corpuscheck.llm.op3_rules import op3_quality_rules
from corpuscheck.llm.op8_packing import op8_best_fit_packing
from corpuscheck.llm.op10_decontamination import op10_decontamination
from corpuscheck.llm.op12_structure import op12_structure_repair
from corpuscheck.llm.op13_pieces import op13_sentencepiece

QUERIES = {
    "op1_attention_mil": op1_attention_mil,
    "op2_hpylm": op2_hpylm,
    "op3_quality_rules": op3_quality_rules,
    "op4_rlz_dedup": op4_rlz.op4_rlz_dedup,
    "op5_url_filter": op5_urls.op5_url_filter,
    "op6_line_dedup": op6_lines.op6_line_dedup,
    "op7_jaccard_join": op7_jaccard.op7_jaccard_join,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_revisits": op9_revisits.op9_revisits,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_trie.op11_prefix_trie,
    "op12_structure_repair": op12_structure_repair,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLE_SQL: dict[str, str] = {
    "op4_rlz_dedup": op4_rlz.SQL,
    "op5_url_filter": op5_urls.SQL,
    "op6_line_dedup": op6_lines.SQL,
    "op7_jaccard_join": op7_jaccard.SQL,
    "op9_revisits": op9_revisits.SQL,
    "op11_prefix_trie": op11_trie.SQL,
}
