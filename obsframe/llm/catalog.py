"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from obsframe.llm import alignment, bpe, decontaminate, dedup, packing, pii, resampling, simhash, tokens, topk, toxicity, unigram, warc

QUERIES = {
    "op1_wavelet_tokens": tokens.op1_wavelet_tokens,
    "op2_exact_dedup": dedup.op2_exact_dedup,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_simhash": simhash.op4_simhash,
    "op5_topk": topk.op5_topk,
    "op6_token_counts": unigram.op6_token_counts,
    "op7_warc": warc.op7_warc,
    "op8_bpe": bpe.op8_bpe,
    "op9_pii": pii.op9_pii,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_alignment": alignment.op11_alignment,
    "op12_decontaminate": decontaminate.op12_decontaminate,
    "op13_resampling": resampling.op13_resampling,
}

ORACLES = {
    "op2_exact_dedup": dedup.OP2_SQL,
    "op5_topk": topk.OP5_SQL,
    "op12_decontaminate": decontaminate.OP12_SQL,
    "op13_resampling": resampling.OP13_SQL,
}
