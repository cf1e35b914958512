"""The queries of this subpackage and their SQL, by name."""

from textloom.llm import (
    op1_pitman_yor,
    op2_quality,
    op3_decontaminate,
    op4_suffix,
    op5_html,
    op6_license,
    op7_token_counts,
    op8_simhash,
    op9_toxicity,
    op10_pack,
)
from textloom.ship import shipped

_MODULES = (op1_pitman_yor, op2_quality, op3_decontaminate, op4_suffix, op5_html, op6_license, op7_token_counts, op8_simhash, op9_toxicity, op10_pack)
QUERIES = {k: shipped(f) for m in _MODULES for k, f in m.QUERIES.items()}
SQL = {k: f for m in _MODULES for k, f in m.SQL.items()}
