"""Imports every operator module, which fills the registry."""

from . import ann, bpe, chat, exact, ledger, lines, lm, near, orchard, packing, setm, toxicity, warc  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
