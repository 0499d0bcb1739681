"""The same results as plain SQL over the driver's tables, for the correctness check."""

from oracles.queries import ORACLES

__all__ = ["ORACLES"]
