"""The registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from zonecast.llm import (exact_dedup, jaccard_join, language_id, mixing, packing, pii, prefix_trie, quality_classifier,
                          quality_rules, sharding, substring_dedup, suffix_dedup, whitening)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_quality_classifier": quality_classifier.op3_quality_classifier,
    "op4_packing": packing.op4_packing,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_language_id": language_id.op6_language_id,
    "op7_mixing": mixing.op7_mixing,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_pii": pii.op9_pii,
    "op10_sharding": sharding.op10_sharding,
    "op11_suffix_dedup": suffix_dedup.op11_suffix_dedup,
    "op12_whitening": whitening.op12_whitening,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op7_mixing": mixing.oracle_sql(),
    "op11_suffix_dedup": suffix_dedup.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
