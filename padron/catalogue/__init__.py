"""Query catalogue over the test tables, each with its SQL counterpart where one exists."""

from padron.catalogue import ingest, links, names, registers, resolution  # noqa: F401
from padron.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
