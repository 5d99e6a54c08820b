"""Query plans by family; importing this package registers every query."""

from . import registry
from . import changes_queries, documents, graph_queries, pipeline, relational, star_queries  # noqa: F401

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
