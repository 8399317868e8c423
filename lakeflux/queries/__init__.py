"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the driver tables; ``ORACLES`` holds the equivalent DuckDB SQL where one exists."""

from __future__ import annotations

from lakeflux.queries.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
