"""One refresh cycle: snapshot in, proposals out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from weftgraph.operators import classify, detect, review
from weftgraph.session import cut_lineage
from weftgraph.specs import ScopeRule

TABLE = ["table_schema", "table_name"]


@dataclass(frozen=True)
class Cycle:
    """What one cycle yields."""

    changes: DataFrame
    candidates: DataFrame
    new_proposals: DataFrame
    baseline: DataFrame


def run_cycle(
    run_id: str,
    current: DataFrame,
    baseline: DataFrame,
    scope: Sequence[ScopeRule],
    fks: DataFrame,
    pks: DataFrame,
    node_types: DataFrame,
    proposals: DataFrame,
    responses: DataFrame | None = None,
    detected_ts: Column | None = None,
    keep: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> Cycle:
    """Detect, classify, take in the review answers and deduplicate.

    ``current`` and ``baseline`` are catalogs (table_schema, table_name, column_name,
    data_type); both are restricted to the scope before they are compared, so narrowing the
    scope reports no drops. ``responses`` holds (candidate_id, response), if there are any.
    ``keep`` stores the outcome of a stage before the next one reads it several times, by
    default in the shared folder; the comparison of the snapshots so runs once.
    """
    columns = [*TABLE, "column_name", "data_type"]
    now = detect.in_scope(current, scope).select(*columns)
    was = detect.in_scope(baseline, scope).select(*columns)
    found = detect.detect_changes(now, was, TABLE, "column_name", ["data_type"])
    changes = keep(detect.stamp_run(found, run_id, detected_ts))
    rows = classify.classify_columns(changes, fks, node_types).unionByName(
        classify.classify_tables(changes, fks, pks, now, node_types)
    )
    candidates = review.as_candidates(rows)
    if responses is not None:
        candidates = review.write_back(candidates, review.parse_responses(responses))
    candidates = keep(candidates)
    return Cycle(
        changes=changes,
        candidates=candidates,
        new_proposals=review.new_proposals(candidates, changes, proposals),
        baseline=detect.refreshed(baseline.select(*columns), now, scope),
    )
