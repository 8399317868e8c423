"""Assembles the query and oracle tables from the family modules."""

from __future__ import annotations

from lakeflux.queries import delivery, describe, drift, general, learn, modeling, schema, zones

QUERIES = {}
ORACLES = {}
for _module in (delivery, describe, modeling, zones, general, drift, schema, learn):
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.SQL)
