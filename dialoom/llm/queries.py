"""The queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

import corpus_pipeline

from . import bestfit, interleave, langid, maxscore, minhash, mixing, stratify, suffixdedup, tokencount, toxicity

QUERIES = {
    "op1_interleaved_media": interleave.op1_interleaved_media,
    "op10_minhash_near_duplicates": minhash.op10_minhash_near_duplicates,
    "op2_toxicity_lexicon": toxicity.op2_toxicity_lexicon,
    "op3_bestfit_packing": bestfit.op3_bestfit_packing,
    "op4_maxscore_top_k": maxscore.op4_maxscore_top_k,
    "op5_stratified_shards": stratify.op5_stratified_shards,
    "op7_suffix_array_dedup": suffixdedup.op7_suffix_array_dedup,
    "op8_soft_mixing": mixing.op8_soft_mixing,
    "pipeline": corpus_pipeline.run,
    "op9_language_id": langid.op9_language_id,
    "op6_token_counts": tokencount.op6_token_counts,
    "page_sequences": interleave.page_sequences,
}

ORACLE_SQL = {
    "op4_maxscore_top_k": maxscore.OP4_SQL,
    "op5_stratified_shards": stratify.OP5_SQL,
}
