"""The corpus queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from .bloom_lm import op3_bloom_lm
from .bpe import op10_bpe_tree
from .compression_bands import op13_compression_bands
from .filter_audit import ORACLE as AUDIT_SQL
from .filter_audit import op12_filter_audit
from .hard_negatives import ORACLE as NEGATIVES_SQL
from .hard_negatives import op11_bit_negatives
from .language import op8_string_kernel
from .mixing import op7_systematic_mix
from .order_minhash import op5_order_minhash
from .quality import op1_quality_classifier
from .suffix_dedup import op2_suffix_dedup
from .toxicity import op9_zstd_distance
from .va_file import ORACLE as TOP_K_SQL
from .va_file import op4_va_file
from .vp_tree import op6_vp_tree

QUERIES = {
    "op8_string_kernel": op8_string_kernel,
    "op9_zstd_distance": op9_zstd_distance,
    "op3_bloom_lm": op3_bloom_lm,
    "op4_va_file": op4_va_file,
    "op6_vp_tree": op6_vp_tree,
    "op1_quality_classifier": op1_quality_classifier,
    "op7_systematic_mix": op7_systematic_mix,
    "op10_bpe_tree": op10_bpe_tree,
    "op5_order_minhash": op5_order_minhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op11_bit_negatives": op11_bit_negatives,
    "op12_filter_audit": op12_filter_audit,
    "op13_compression_bands": op13_compression_bands,
}

ORACLE: dict[str, str] = {
    "op4_va_file": TOP_K_SQL,
    "op11_bit_negatives": NEGATIVES_SQL,
    "op12_filter_audit": AUDIT_SQL,
}
