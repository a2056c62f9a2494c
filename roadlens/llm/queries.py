"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from roadlens.llm import (chat, collocations, divergence, embed_join, lattice, licenses, mixing, ngram_join, packing, pii, quality, secrets,
                          urls)

QUERIES = {
    "op1_pfair_mixing": mixing.op1_pfair_mixing,
    "op2_checked_pii": pii.op2_checked_pii,
    "op3_randomness_secrets": secrets.op3_randomness_secrets,
    "op4_complement_packing": packing.op4_complement_packing,
    "op5_ngram_combination_join": ngram_join.op5_ngram_combination_join,
    "op6_url_classifier": urls.op6_url_classifier,
    "op7_target_ratio_quality": quality.op7_target_ratio_quality,
    "op8_reply_tree_chat": chat.op8_reply_tree_chat,
    "op9_license_containment": licenses.op9_license_containment,
    "op10_epsilon_grid_join": embed_join.op10_epsilon_grid_join,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_lattice_likelihood": lattice.op13_lattice_likelihood,
}

#: The others are tested against brute force, an exact round trip or held-out rows.
ORACLES = {
    "op1_pfair_mixing": mixing.ORACLE_SQL,
    "op5_ngram_combination_join": ngram_join.ORACLE_SQL,
    "op8_reply_tree_chat": chat.ORACLE_SQL,
    "op9_license_containment": licenses.ORACLE_SQL,
    "op10_epsilon_grid_join": embed_join.ORACLE_SQL,
    "op11_source_divergence": divergence.ORACLE_SQL,
    "op12_phrase_collocations": collocations.ORACLE_SQL,
}
