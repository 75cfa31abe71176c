"""Layered (landing -> bronze -> silver -> gold) data operators for PySpark.

Every operator takes and returns Spark DataFrames and is built from native
column expressions, so Catalyst plans it and AQE adapts it.  See README.md.
"""

from lakestrata.settings import Layers, RunContext, configure

__all__ = ["Layers", "RunContext", "configure"]
