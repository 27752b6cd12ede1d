"""Graph and schema-change analytics on Spark."""

from weftgraph.session import configure
from weftgraph.specs import FkEdgeSpec, JunctionEdgeSpec, NodeSpec, ScopeRule

__all__ = ["FkEdgeSpec", "JunctionEdgeSpec", "NodeSpec", "ScopeRule", "configure"]
