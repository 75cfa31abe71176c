"""Registered queries over the driver tables, each with the SQL that must give the same rows."""

from workload.registration import ORACLES, QUERIES

from workload import checks, governance, history, landing, projection, star, storage, streams  # noqa: E402,F401

__all__ = ["ORACLES", "QUERIES"]
