"""Registered jobs over the test tables, each with equivalent plain SQL where SQL can say it."""

from __future__ import annotations

from .base import ORACLES, QUERIES
from . import basics, history, evaluation, modelling, monitoring, serving, storage  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
