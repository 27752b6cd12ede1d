"""Typed descriptions of what to build from a source table."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class NodeSpec:
    """One node type: rows of ``source`` identified by ``key_cols``."""

    node_type: str
    source: str
    key_cols: tuple[str, ...]


@dataclass(frozen=True)
class FkEdgeSpec:
    """One edge type read from a reference column of ``source``.

    ``from_type`` is the node type of the source rows themselves; a self reference has
    ``from_type == to_type``.
    """

    edge_type: str
    source: str
    from_type: str
    key_cols: tuple[str, ...]
    fk_col: str
    to_type: str


@dataclass(frozen=True)
class JunctionEdgeSpec:
    """One edge type read from a table holding two references."""

    edge_type: str
    source: str
    from_type: str
    from_col: str
    to_type: str
    to_col: str


@dataclass(frozen=True)
class ScopeRule:
    """An INCLUDE or EXCLUDE rule with LIKE patterns."""

    filter_type: str
    schema_pattern: str
    table_pattern: str
    catalog_pattern: str = "%"
