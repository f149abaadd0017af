"""All registered queries of the bar part, and their SQL."""

from __future__ import annotations

from checks import more_oracles, more_queries, oracles, queries

QUERIES = {**queries.QUERIES, **more_queries.QUERIES}
ORACLES = {**oracles.ORACLES, **more_oracles.ORACLES}
