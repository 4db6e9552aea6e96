"""Production-cost and market analytics as PySpark DataFrame jobs."""

from millwright.params import Params

__all__ = ["Params"]
