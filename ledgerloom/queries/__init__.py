"""Registered queries: each operator on the driver tables, with an independent SQL form."""

from .registry import ORACLES, QUERIES
from . import (classify, dataset, evaluation, ingest, learning, matching, metric, shaping,  # noqa: F401
               textual, transfer)

__all__ = ["QUERIES", "ORACLES"]
