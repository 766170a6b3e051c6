"""The registered queries of the training-data operators, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from clickloom.llm.binary_output import op1_binary_output
from clickloom.llm.embedding_dedup import op4_embedding_dedup
from clickloom.llm.html_extraction import op9_html_extraction
from clickloom.llm.merkle import OP11_SQL, op11_merkle_manifest
from clickloom.llm.mixing import op10_mixing
from clickloom.llm.near_dedup import op3_near_dedup
from clickloom.llm.packing import op7_best_fit_packing
from clickloom.llm.personal_data import op13_personal_data
from clickloom.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from clickloom.llm.quality_classifier import op5_quality_classifier
from clickloom.llm.quality_rules import OP8_SQL, op8_quality_rules
from clickloom.llm.suffix_dedup import op6_suffix_dedup
from clickloom.llm.toxicity import op2_toxicity
from corpus_pipeline import run as pipeline

QUERIES = {
    "op1_binary_output": op1_binary_output,
    "op2_toxicity": op2_toxicity,
    "op3_near_dedup": op3_near_dedup,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_html_extraction": op9_html_extraction,
    "op10_mixing": op10_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_personal_data": op13_personal_data,
    "pipeline": pipeline,
}

SQL = {"op8_quality_rules": OP8_SQL, "op11_merkle_manifest": OP11_SQL, "op12_prefix_trie": OP12_SQL}
