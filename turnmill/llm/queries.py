"""Registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from turnmill.llm import jaccard, lm, merkle, mixing, neighbours, pieces, quality, repair, repeats, spotsigs, toxicity, urls, warc

REGISTRY = {
    "op1_jaccard": jaccard.op1_jaccard,
    "op2_neighbours": neighbours.op2_neighbours,
    "op3_urls": urls.op3_urls,
    "op4_warc": warc.op4_warc,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_pieces": pieces.op6_pieces,
    "op7_mixing": mixing.op7_mixing,
    "op8_quality": quality.op8_quality,
    "op9_lm": lm.op9_lm,
    "op10_suffix": repeats.op10_suffix,
    "op11_merkle": merkle.op11_merkle,
    "op12_spotsigs": spotsigs.op12_spotsigs,
    "op13_repair": repair.op13_repair,
}

ORACLES = {
    "op1_jaccard": jaccard.OP1_SQL,
    "op3_urls": urls.OP3_SQL,
    "op4_warc": warc.OP4_SQL,
    "op8_quality": quality.OP8_SQL,
}
