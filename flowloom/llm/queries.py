"""The registered queries of this part, each with SQL that must match where SQL can say it."""

from __future__ import annotations

from flowloom.llm import (
    folded_bpe,
    hidden_markov,
    max_sketch,
    near_dedup,
    packing,
    permutation_index,
    quality_rules,
    rank_array_bpe,
    resampling,
    text_density,
    token_files,
    toxicity,
    whitening,
)
from flowloom.plans.registry import Query


def llm_catalog() -> dict[str, Query]:
    return {
        "op1_token_files": Query(token_files.op1_token_files, None),
        "op2_toxicity_grammar": Query(toxicity.op2_toxicity_grammar, None),
        "op3_text_density": Query(text_density.op3_text_density, None),
        "op4_rank_array_bpe": Query(rank_array_bpe.op4_rank_array_bpe, None),
        "op5_hidden_markov": Query(hidden_markov.op5_hidden_markov, None),
        "op6_importance_resampling": Query(resampling.op6_importance_resampling, None),
        "op7_cost_balanced_packing": Query(packing.op7_cost_balanced_packing, None),
        "op8_quality_rules": Query(quality_rules.op8_quality_rules, quality_rules.OP8_SQL),
        "op9_prob_min_hash": Query(near_dedup.op9_prob_min_hash, None),
        "op10_permutation_index": Query(permutation_index.op10_permutation_index, None),
        "op11_folded_bpe": Query(folded_bpe.op11_folded_bpe, None),
        "op12_feast_whitening": Query(whitening.op12_feast_whitening, None),
        "op13_max_sketch_search": Query(max_sketch.op13_max_sketch_search, max_sketch.OP13_SQL),
    }
