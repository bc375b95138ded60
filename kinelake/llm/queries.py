"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from kinelake.llm import brown_lm, byte_bpe, centroids, dac, decontaminate, jaccard_join, lang_id, line_crf, pii, quality, repair, sketch, toxicity


def queries() -> dict:
    return {
        "op1_pii_feistel": pii.op1_pii_feistel,
        "op2_jaccard_join": jaccard_join.op2_jaccard_join,
        "op3_brown_lm": brown_lm.op3_brown_lm,
        "op4_byte_bpe": byte_bpe.op4_byte_bpe,
        "op5_sketch": sketch.op5_sketch,
        "op6_lang_id": lang_id.op6_lang_id,
        "op7_quality_ordinal": quality.op7_quality_ordinal,
        "op8_dac_tokens": dac.op8_dac_tokens,
        "op9_decontaminate": decontaminate.op9_decontaminate,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_conversation_repair": repair.op11_conversation_repair,
        "op12_centroid_clusters": centroids.op12_centroid_clusters,
        "op13_line_quality": line_crf.op13_line_quality,
    }


def oracles() -> dict:
    return {
        "op2_jaccard_join": jaccard_join.OP2_SQL,
        "op5_sketch": sketch.OP5_SQL,
        "op9_decontaminate": decontaminate.OP9_SQL,
        "op11_conversation_repair": repair.OP11_SQL,
        "op12_centroid_clusters": centroids.OP12_SQL,
    }
