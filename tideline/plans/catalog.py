"""Every registered query; importing this module fills the registry."""

from tideline.plans import catalog_checks, catalog_graph, catalog_ingest, catalog_route, catalog_state, catalog_stream  # noqa: F401
from tideline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
