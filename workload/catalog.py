"""Loads every query module, in the order they are listed."""

from . import encoding, evaluation, files, jobs, metrics, modeling, replies, state, streams, text  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
