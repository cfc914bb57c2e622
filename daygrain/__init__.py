"""Entity-day analytics as composable PySpark DataFrame operators."""

from daygrain.names import GENERIC, ROADS, Names

__all__ = ["GENERIC", "ROADS", "Names"]
