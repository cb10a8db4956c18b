"""Queries of this subpackage, one per operator, and the oracles that SQL can express."""

from __future__ import annotations

import corpus_pipeline

from dealspark.llm.bpe import op2_byte_bpe
from dealspark.llm.divergence import OP11_SQL, op11_source_divergence
from dealspark.llm.embeddings import op6_embedding_near_dedup
from dealspark.llm.hierarchy import op13_hierarchical_packing
from dealspark.llm.language import op4_language_id
from dealspark.llm.lattice import op8_lm_scoring
from dealspark.llm.media import op9_media_columns
from dealspark.llm.minhash import op7_minhash_near_dedup
from dealspark.llm.packing import op5_best_fit_packing
from dealspark.llm.quality import op3_quality_classifier
from dealspark.llm.toxicity import op10_toxicity
from dealspark.llm.urls import OP1_SQL, op1_url_filters
from dealspark.llm.whitening import op12_embedding_whitening

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_url_filters": op1_url_filters,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op4_language_id": op4_language_id,
    "op3_quality_classifier": op3_quality_classifier,
    "op10_toxicity": op10_toxicity,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op2_byte_bpe": op2_byte_bpe,
    "op9_media_columns": op9_media_columns,
    "op11_source_divergence": op11_source_divergence,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_hierarchical_packing": op13_hierarchical_packing,
}

ORACLES: dict[str, str] = {"op1_url_filters": OP1_SQL, "op11_source_divergence": OP11_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
