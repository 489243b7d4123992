"""The queries over the training-data tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from tidemark.llm import (
    fingerprints, jaccard_join, licences, main_text, merkle_manifest, packing, personal_data, piece_transducer, prefix_trie, quality_model, quality_rules, repeats,
    speculative_bpe)

Q = {
    "op1_suffix_dedup": repeats.query,
    "op2_jaccard_join": jaccard_join.query,
    "op3_personal_data": personal_data.query,
    "op4_packing": packing.query,
    "op5_quality_model": quality_model.query,
    "op6_main_text": main_text.query,
    "op7_piece_transducer": piece_transducer.query,
    "op8_quality_rules": quality_rules.query,
    "op9_fingerprints": fingerprints.query,
    "op10_licences": licences.query,
    "op11_speculative_bpe": speculative_bpe.query,
    "op12_prefix_trie": prefix_trie.query,
    "op13_merkle_manifest": merkle_manifest.query,
}
SQL = {
    "op8_quality_rules": quality_rules.SQL,
    "op9_fingerprints": fingerprints.SQL,
    "op10_licences": licences.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
    "op13_merkle_manifest": merkle_manifest.SQL,
}
