"""The registered queries and their oracles."""

from . import csvs, files, logs, reductions, selections
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "csvs", "files", "logs", "reductions", "selections"]
