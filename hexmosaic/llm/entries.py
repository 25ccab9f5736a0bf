"""Queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from hexmosaic.llm import (
    decontaminate,
    divergence,
    filter_audit,
    jaccard,
    language,
    mixing,
    pii,
    quality,
    repeats,
    token_file,
    topk,
    toxicity,
    warc,
)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_repeats": repeats.op2_repeats,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_language": language.op4_language,
    "op5_token_file": token_file.op5_token_file,
    "op6_jaccard": jaccard.op6_jaccard,
    "op7_warc": warc.op7_warc,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_mixing": mixing.op9_mixing,
    "op10_topk": topk.op10_topk,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_quality": quality.op12_quality,
    "op13_divergence": divergence.op13_divergence,
}

ORACLES = {
    "op2_repeats": repeats.SQL,
    "op6_jaccard": jaccard.SQL,
    "op7_warc": warc.SQL,
    "op8_decontaminate": decontaminate.SQL,
    "op9_mixing": mixing.SQL,
    "op10_topk": topk.SQL,
    "op11_filter_audit": filter_audit.SQL,
    "op13_divergence": divergence.SQL,
}
