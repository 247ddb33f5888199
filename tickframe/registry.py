"""Every query of the library by name, with the DuckDB SQL that checks it."""

from tickframe.plans import candles, many_keys, markets  # noqa: F401  registers the queries
from tickframe.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
