"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm.byte_bpe import op5_byte_bpe
from tidemark.llm.decontaminate import OP3_SQL, op3_decontaminate, op3_near_passages
from tidemark.llm.embedding_dedup import OP10_SQL, op10_embedding_dedup
from tidemark.llm.html_extract import op7_html_extract
from tidemark.llm.language import op8_language_id
from tidemark.llm.licences import op6_license_scan
from tidemark.llm.line_dedup import OP1_SQL, op1_line_dedup
from tidemark.llm.near_dedup import op4_minhash_near_dedup
from tidemark.llm.packing import op13_best_fit_packing
from tidemark.llm.ranked_search import OP11_SQL, op11_ranked_search
from tidemark.llm.secret_scan import op2_secret_scan
from tidemark.llm.spelling import op12_spelling_variants
from tidemark.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_license_scan": op6_license_scan,
    "op7_html_extract": op7_html_extract,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_best_fit_packing": op13_best_fit_packing,
    "pipeline": corpus_pipeline.run,
}

# Registered besides: results that go beyond the columns of an operator's SQL twin.
FURTHER = {"op3_near_passages": op3_near_passages}

SQL = {
    "op1_line_dedup": OP1_SQL,
    "op3_decontaminate": OP3_SQL,
    "op10_embedding_dedup": OP10_SQL,
    "op11_ranked_search": OP11_SQL,
}
