"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from .divergence import OP12_SQL, op12_source_divergence
from .exact_dedup import OP1_SQL, op1_exact_dedup
from .filter_audit import OP11_SQL, op11_filter_audit
from .language_id import op2_language_id
from .line_dedup import OP13_SQL, op13_line_dedup
from .matroska import op8_matroska
from .mixing import mixing_by_copies, op3_mixing
from .near_dedup import op7_near_dedup
from .packing import op4_packing
from .quality import op9_quality
from .secrets import op6_secrets
from .token_planes import op5_token_planes
from .toxicity import op10_toxicity

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_mixing": op3_mixing,
    "op4_packing": op4_packing,
    "op5_token_planes": op5_token_planes,
    "op6_secrets": op6_secrets,
    "op7_near_dedup": op7_near_dedup,
    "op8_matroska": op8_matroska,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_divergence": op12_source_divergence,
    "op13_line_dedup": op13_line_dedup,
    "mixing_by_copies": mixing_by_copies,
}

SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_line_dedup": OP13_SQL,
}
