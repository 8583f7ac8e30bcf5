"""Operators for preparing training text at scale.  Nothing else in the library imports them."""

from __future__ import annotations

from .catalog import ORACLES, QUERIES
from . import bpe, decontaminate, exact_dedup, html_text, jaccard, langid, packing, pii, ranking, search, suffixes, toxicity, whitening  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
