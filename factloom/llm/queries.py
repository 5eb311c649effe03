"""The registered queries of this folder and their DuckDB oracles."""

from __future__ import annotations

from . import (  # noqa: F401  (register on import)
    ann,
    decontamination, hard_negatives, html_main, licenses, line_dedup, lm_score, mixing, near_dups, packing, quality, suffix_dedup, token_align,
)
from .common import ORACLES, QUERIES  # noqa: F401
