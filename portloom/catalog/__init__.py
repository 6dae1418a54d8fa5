"""All registered queries."""

from portloom.catalog import cleaning, history, ingest, live, marts, quality, topology
from portloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "history", "ingest", "live", "marts", "quality", "topology"]
