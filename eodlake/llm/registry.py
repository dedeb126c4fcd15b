"""Queries of the training-data operators and, where SQL can express them on whole tables, their SQL."""

from __future__ import annotations

from eodlake.llm import exact, imatch, licenses, manifest, minhash, mixing, negatives, packing, quality, substrings, suffixtree, toxicity

QUERIES = {
    "op1_suffix_dedup": substrings.op1_suffix_dedup,
    "op2_near_dedup": minhash.op2_near_dedup,
    "op3_imatch": imatch.op3_imatch,
    "op4_quality": quality.op4_quality,
    "op5_exact_dedup": exact.op5_exact_dedup,
    "op6_suffix_tree": suffixtree.op6_suffix_tree,
    "op7_seed_extend": substrings.op7_seed_extend,
    "op8_lexical_packing": packing.op8_lexical_packing,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_source_mix": mixing.op10_source_mix,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_merkle": manifest.op13_merkle,
}
ORACLES = {
    "op1_suffix_dedup": substrings.BYTES_SQL,
    "op2_near_dedup": minhash.SQL,
    "op5_exact_dedup": exact.SQL,
    "op7_seed_extend": substrings.WORDS_SQL,
    "op10_source_mix": mixing.SQL,
    "op12_hard_negatives": negatives.SQL,
    "op13_merkle": manifest.SQL,
}
