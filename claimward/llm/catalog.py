"""Registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from claimward.llm import (
    decontaminate,
    kdsearch,
    langid,
    minhash,
    mixing,
    pagetext,
    quality,
    rules,
    tokens,
    urlfilter,
    variants,
    warc,
    whitening,
)

QUERIES = {
    "op1_crf_language": langid.op1,
    "op2_circulant_minhash": minhash.op2,
    "op3_warc_index": warc.op3,
    "op4_url_rules": urlfilter.op4,
    "op5_spaced_seeds": decontaminate.op5,
    "op6_weak_supervision": rules.op6,
    "op7_text_density": pagetext.op7,
    "op8_seekable_ids": tokens.op8,
    "op9_crf_quality": quality.op9,
    "op10_water_filling": mixing.op10,
    "op11_jacobi_whitening": whitening.op11,
    "op12_trie_frontier": variants.op12,
    "op13_kd_tree_top_k": kdsearch.op13,
}
ORACLES = {
    "op2_circulant_minhash": minhash.OP2_SQL,
    "op3_warc_index": warc.OP3_SQL,
    "op4_url_rules": urlfilter.OP4_SQL,
    "op5_spaced_seeds": decontaminate.OP5_SQL,
    "op13_kd_tree_top_k": kdsearch.OP13_SQL,
}
