"""The registered queries of this subpackage, and the SQL that gives the same rows where SQL can."""

from junctionflow.llm import alignment, bpe, fragment_bpe, jaccard_join, line_dedup, manifest, merkle, packing, quality_classifier, quality_rules, sharding, suffix_dedup, toxicity

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op3_packing": packing.op3_packing,
    "op4_quality_classifier": quality_classifier.op4_quality_classifier,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_sharding": sharding.op6_sharding,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_merkle": merkle.op8_merkle,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_manifest": manifest.op11_manifest,
    "op12_fragment_bpe": fragment_bpe.op12_fragment_bpe,
    "op13_token_alignment": alignment.op13_token_alignment,
}

SQL = {"op5_quality_rules": quality_rules.SQL, "op7_line_dedup": line_dedup.SQL}
