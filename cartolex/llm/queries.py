"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import egojoin, language, lmscore, mixing, multiset, packing, quality, runindex, secrets, simhash

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_embedding_near_dedup": egojoin.op2_embedding_near_dedup,
    "op3_document_fingerprints": multiset.op3_document_fingerprints,
    "op4_mixing_sources": mixing.op4_mixing_sources,
    "op5_simhash_near_dedup": simhash.op5_simhash_near_dedup,
    "op6_language_id": language.op6_language_id,
    "op7_quality_classifier": quality.op7_quality_classifier,
    "op8_suffix_array_dedup": runindex.op8_suffix_array_dedup,
    "op9_secret_scans": secrets.op9_secret_scans,
    "op10_lm_scoring": lmscore.op10_lm_scoring,
}
SQL = {"op4_mixing_sources": mixing.OP4_SQL}
