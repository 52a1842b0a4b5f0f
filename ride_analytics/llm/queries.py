"""Registered queries of the training-data operators, and their SQL."""

from corpus_pipeline import run
from ride_analytics.llm import (
    adaptive_join,
    exact_dedup,
    latent_decontamination,
    minhash,
    phrase_mining,
    ppm,
    quality_ranker,
    retrieval_packing,
    run_index,
    site_templates,
    token_alignment,
    token_counts,
    warc,
)

QUERIES = {
    "op1_warc_transactions": warc.query,
    "op2_quality_ranking": quality_ranker.query,
    "op3_retrieval_packing": retrieval_packing.query,
    "op4_partial_matching": ppm.query,
    "op5_site_templates": site_templates.query,
    "op6_token_counts": token_counts.query,
    "op7_exact_dedup": exact_dedup.query,
    "op8_latent_decontamination": latent_decontamination.query,
    "op9_minhash_bayes": minhash.query,
    "op10_run_index": run_index.query,
    "op11_setm_phrases": phrase_mining.query,
    "op12_adaptive_prefix": adaptive_join.query,
    "op13_token_alignment": token_alignment.query,
    "pipeline": run,
}
ORACLES = {
    "op1_warc_transactions": warc.ORACLE_SQL,
    "op7_exact_dedup": exact_dedup.ORACLE_SQL,
    "op11_setm_phrases": phrase_mining.ORACLE_SQL,
}
