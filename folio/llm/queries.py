"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import classifier, exact, jaccard, lines, lm, packing, pieces, quality, suffixes, warc

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_warc": warc.op2_warc,
    "op3_lm_scoring": lm.op3_lm_scoring,
    "op4_packing": packing.op4_packing,
    "op5_sentencepiece": pieces.op5_sentencepiece,
    "op6_suffix_dedup": suffixes.op6_suffix_dedup,
    "op7_line_dedup": lines.op7_line_dedup,
    "op8_quality_classifier": classifier.op8_quality_classifier,
    "op9_ngram_jaccard_join": jaccard.op9_ngram_jaccard_join,
    "op10_exact_dedup": exact.op10_exact_dedup,
}
ORACLES = {
    "op1_quality_rules": quality.SQL,
    "op2_warc": warc.SQL,
    "op7_line_dedup": lines.SQL,
    "op9_ngram_jaccard_join": jaccard.SQL,
    "op10_exact_dedup": exact.SQL,
}
