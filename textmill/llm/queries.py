"""The queries op1 to op10, and SQL for those that it can express."""

from textmill.llm.byte_bpe import op3_byte_bpe
from textmill.llm.class_lm import op6_class_lm
from textmill.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from textmill.llm.language_id import op8_language_id
from textmill.llm.license_scan import op4_license_scan
from textmill.llm.near_dedup import op2_minhash_near_dedup
from textmill.llm.packing import op5_best_fit_packing
from textmill.llm.quality_rules import op7_quality_rules
from textmill.llm.substring_dedup import OP9_SQL, op9_substring_dedup
from textmill.llm.warc import OP1_SQL, op1_warc_salvage

QUERIES = {
    "op1_warc_salvage": op1_warc_salvage,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_license_scan": op4_license_scan,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_class_lm": op6_class_lm,
    "op7_quality_rules": op7_quality_rules,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_exact_dedup": op10_exact_dedup,
}
ORACLES = {"op1_warc_salvage": OP1_SQL, "op9_substring_dedup": OP9_SQL, "op10_exact_dedup": OP10_SQL}
