"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from . import (
    alignment,
    bpe,
    exact_dedup,
    hard_negatives,
    html_text,
    language,
    licenses,
    packing,
    quality_model,
    quality_rules,
    sharding,
    signature_trees,
    suffix_dedup,
)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_sharding": sharding.op2_sharding,
    "op3_language_id": language.op3_language_id,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_html_extraction": html_text.op5_html_extraction,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_bpe": bpe.op7_bpe,
    "op8_quality_classifier": quality_model.op8_quality_classifier,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_jaccard_join": signature_trees.op10_jaccard_join,
    "op11_tokenizer_alignment": alignment.op11_tokenizer_alignment,
    "op12_license_scan": licenses.op12_license_scan,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLE = {
    "op4_exact_dedup": exact_dedup.SQL,
    "op6_quality_rules": quality_rules.SQL,
    "op10_jaccard_join": signature_trees.SQL,
    "op12_license_scan": licenses.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
