"""The registered queries of this package and their SQL."""

from __future__ import annotations

import corpus_pipeline
from flowloom.llm import (
    bpe_transducer, byte_bpe, code_search, collocations, decontaminate, jaccard_join, line_dedup, preferences, secrets,
    token_alignment, token_ledger, toxicity, url_reputation,
)

QUERIES = {
    "op1_code_search": code_search.op1_code_search,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_token_counts": token_ledger.op4_token_counts,
    "op5_byte_bpe": byte_bpe.op5_byte_bpe,
    "op6_url_filters": url_reputation.op6_url_filters,
    "op7_benchmark_decontamination": decontaminate.op7_benchmark_decontamination,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_secret_scans": secrets.op9_secret_scans,
    "op10_chat_formatting": preferences.op10_chat_formatting,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_collocations": collocations.op12_collocations,
    "op13_bpe_transducer": bpe_transducer.op13_bpe_transducer,
    "pipeline": corpus_pipeline.run,
}
SQL = {
    "op1_code_search": code_search.OP1_SQL,
    "op2_jaccard_join": jaccard_join.OP2_SQL,
    "op4_token_counts": token_ledger.OP4_SQL,
    "op6_url_filters": url_reputation.OP6_SQL,
    "op7_benchmark_decontamination": decontaminate.OP7_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op10_chat_formatting": preferences.OP10_SQL,
    "op12_collocations": collocations.OP12_SQL,
}
