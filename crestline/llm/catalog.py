"""Queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from crestline.llm.chat_format import op6_chat_formatting
from crestline.llm.curve_packing import op11_curve_packing
from crestline.llm.decontamination import NEAR_SQL, OP10_SQL, decontamination_near, op10_decontamination
from crestline.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from crestline.llm.language_id import op4_language_id
from crestline.llm.licenses import OP9_SQL, op9_license_scan
from crestline.llm.line_dedup import op5_line_dedup
from crestline.llm.merkle import OP13_SQL, op13_merkle_manifest
from crestline.llm.packing import op8_best_fit_packing
from crestline.llm.quality_model import op3_quality_classifier
from crestline.llm.quality_rules import ABLATIONS_SQL, OP7_SQL, op7_quality_rules, quality_ablations
from crestline.llm.simhash_dedup import op1_simhash_near_dedup
from crestline.llm.toxicity import op2_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_toxicity, op3_quality_classifier, op4_language_id, op5_line_dedup,
        op6_chat_formatting, op7_quality_rules, op8_best_fit_packing, op9_license_scan, op10_decontamination,
        op11_curve_packing, op12_hard_negatives, op13_merkle_manifest, decontamination_near, quality_ablations,
    )
} | {"pipeline": corpus_pipeline.run}
ORACLES = {
    "op7_quality_rules": OP7_SQL, "op9_license_scan": OP9_SQL, "op10_decontamination": OP10_SQL,
    "op12_hard_negatives": OP12_SQL, "op13_merkle_manifest": OP13_SQL, "quality_ablations": ABLATIONS_SQL, "decontamination_near": NEAR_SQL,
}
