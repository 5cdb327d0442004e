"""Training-data operators; nothing else in the library imports them."""

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
