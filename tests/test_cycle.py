"""The whole flow on the harbour fixture, with counts worked out by hand."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests import harbour
from weftgraph.operators import classify, decide, draft, graph, review
from weftgraph.plans.cycle import Cycle, run_cycle
from weftgraph.session import cut_lineage, local_rows
from weftgraph.sources.tables import catalog_snapshot
from weftgraph.specs import FkEdgeSpec, JunctionEdgeSpec


def _table(tables, spec):
    return tables[spec.source.split(".")[1]]


def _graph(tables):
    nodes = graph.union_all(graph.build_nodes(_table(tables, s), s) for s in harbour.NODES)
    edges = [graph.build_fk_edges(_table(tables, s), s, nodes) for s in harbour.FK_EDGES]
    edges += [graph.build_junction_edges(_table(tables, s), s, nodes) for s in harbour.JUNCTIONS]
    return nodes, graph.union_all(edges)


def test_graph_before(spark):
    nodes, edges = _graph(harbour.before(spark))
    counts = {r.node_type: r.n for r in graph.type_counts(nodes, "node_type").collect()}
    assert counts == {"BERTH": 7, "PORT": 5, "TUG": 3, "VESSEL": 6}
    by_edge = {r.edge_type: r.n for r in graph.type_counts(edges, "edge_type").collect()}
    assert by_edge == {"BERTH_IN": 7, "CALLS_AT": 8, "HOME_PORT": 4, "TUG_BASE": 3}
    assert graph.orphan_count(edges, nodes).first().orphans == 0
    kinds = Counter(r.triple_kind for r in graph.triples(nodes, edges).collect())
    # Set properties: ports 5 + 4 + 3, vessels 6 + 4 + 6 + 5 + 4, berths 5, tugs 3 + 3 + 3.
    assert kinds == {"ATTRIBUTE": 12 + 25 + 5 + 9, "EDGE": 22}


@pytest.fixture(scope="module")
def cycle(spark):
    old = catalog_snapshot(harbour.before(spark), "SRC")
    assert old.count() == 22
    proposals = review.to_proposals(
        review.as_candidates(
            local_rows(spark, [], "run_id string, table_schema string, table_name string, "
                       "column_name string, object_kind string, rule_applied string, "
                       "proposed_name string, edge_from string, edge_to string, raw_details string")
        ),
        local_rows(spark, [], "run_id string, table_schema string, table_name string, "
                   "column_name string, detected_ts timestamp_ntz"),
    )
    # Each stage is written before the next one reads it, as in a real run.
    found = run_cycle(
        "run-1",
        catalog_snapshot(harbour.after(spark), "SRC"),
        old,
        harbour.SCOPE,
        harbour.foreign_keys(spark),
        harbour.primary_keys(spark),
        graph.node_type_rows(harbour.NODES, spark),
        proposals,
    )
    new, baseline = cut_lineage(found.new_proposals), cut_lineage(found.baseline)
    return Cycle(found.changes, found.candidates, new, baseline), proposals


def test_changes(cycle):
    found, _ = cycle
    kinds = Counter(r.change_type for r in found.changes.collect())
    assert kinds == {"NEW_COLUMN": 4, "DROPPED_COLUMN": 3, "TYPE_CHANGED": 1, "NEW_TABLE": 4}


def test_column_candidates(spark, cycle):
    found, _ = cycle
    rows = {(r.column_name, r.edge_to): r for r in found.candidates.where("column_name is not null").collect()}
    assert set(rows) == {
        ("SCRAPPED", None), ("SISTER_VESSEL_NO", "VESSEL"), ("ASSIST_NO", "VESSEL"), ("ASSIST_NO", "TUG")
    }
    gone = rows["SCRAPPED", None]
    assert (gone.object_kind, gone.rule_applied, gone.proposed_name) == ("ATTRIBUTE", "COLUMN_TO_ATTRIBUTE", "scrapped")
    sister = rows["SISTER_VESSEL_NO", "VESSEL"]
    assert (sister.object_kind, sister.edge_from) == ("EDGE_TYPE", "VESSEL")
    assert json.loads(sister.raw_details)["self_referencing"] is True
    lost = classify.unresolved_references(
        found.changes, harbour.foreign_keys(spark), graph.node_type_rows(harbour.NODES, spark)
    ).collect()
    assert [(r.column_name, r.reason) for r in lost] == [("CARGO_CODE", "TARGET_UNKNOWN")]


def test_table_candidates(cycle):
    found, _ = cycle
    rows = {r.table_name: r for r in found.candidates.where("column_name is null").collect()}
    kinds = {t: (r.object_kind, r.rule_applied, r.edge_from, r.edge_to) for t, r in rows.items()}
    assert kinds == {
        "SRC_PILOTAGE": ("EDGE_TYPE", "PURE_JUNCTION", "PORT", "VESSEL"),
        "SRC_MOORING": ("FLAGGED", "REIFIED_ENTITY?", "BERTH", "BERTH"),
        "SRC_SIGHTING": ("FLAGGED", "REIFIED_ENTITY?", "PORT", "VESSEL"),
        "SRC_TARIFF": ("NODE_TYPE", classify.FEW_FKS, None, None),
    }
    names = ("fk_count", "pk_count", "fk_in_pk", "total_columns", "attr_count")
    shapes = {t: [json.loads(r.raw_details)[k] for k in names] for t, r in rows.items()}
    assert shapes == {
        "SRC_PILOTAGE": [2, 2, 2, 3, 1], "SRC_MOORING": [3, 3, 3, 7, 4],
        "SRC_SIGHTING": [2, 0, 0, 3, 3], "SRC_TARIFF": [0, 1, 0, 3, 2],
    }


def test_baseline_moves_on(cycle):
    found, _ = cycle
    assert found.baseline.count() == 5 + 7 + 3 + 5 + 3 + 3 + 7 + 3 + 3
    assert found.baseline.where("table_name in ('SRC_OLD_LIGHT', 'SRC_TMP_LOAD')").count() == 0


def test_same_run_twice_adds_nothing(cycle):
    """Eight candidates; both references of ASSIST_NO are one proposal."""
    found, proposals = cycle
    once = proposals.unionByName(found.new_proposals)
    assert found.candidates.count() == 8 and once.count() == 7
    assert review.new_proposals(found.candidates, found.changes, once).count() == 0
    deferred = once.withColumn("status", F.lit("DEFERRED"))
    assert review.new_proposals(found.candidates, found.changes, deferred).count() == 7


# Attribute 1; sister, assist and pilotage 3 each; tariff 3; as node: mooring 3 + 3 x 3 and one
# entry for the keyless sightings; as edges: 3 each.
@pytest.mark.parametrize(("flagged_as", "expected"), [("NODE_TYPE", 13 + 12 + 1), ("EDGE_TYPE", 13 + 3 + 3)])
def test_drafts(spark, cycle, flagged_as, expected):
    found, _ = cycle
    proposals = found.new_proposals
    no_artifacts = local_rows(spark, [], "proposal_id string")
    decisions = proposals.select(
        "proposal_id",
        F.lit(1).cast("long").alias("decision_seq"),
        F.lit("approved").alias("status"),
        F.lit("fine").alias("rationale"),
        F.lit(None).cast("string").alias("final_name"),
        F.when(F.col("object_kind") == "FLAGGED", flagged_as).alias("final_kind"),
        F.lit("me").alias("decided_by"),
        F.localtimestamp().alias("decided_ts"),
    )
    judged = cut_lineage(decide.judge_decisions(proposals, decisions, no_artifacts))
    assert {r.result for r in judged.collect()} == {"OK"}
    approved = cut_lineage(decide.apply_decisions(proposals, judged))
    work = draft.pending_work(approved, no_artifacts)
    assert draft.work_count(approved, no_artifacts).first().proposals == 7
    plan = cut_lineage(draft.plan_changes(
        work,
        harbour.primary_keys(spark),
        harbour.foreign_keys(spark),
        graph.node_type_rows(harbour.NODES, spark),
    ))
    rows = plan.collect()
    assert len(rows) == expected
    assert len({r.artifact_id for r in rows}) == expected
    skipped = [(r.source_object, r.skip_reason) for r in rows if r.skip_reason]
    assert skipped == ([("SRC.SRC_SIGHTING", draft.NO_KEY)] if flagged_as == "NODE_TYPE" else [])

    texts = [r.template_sql for r in draft.with_draft_text(plan).collect()]
    assert all(t and "<missing>" not in t for t in texts)

    # The plan runs: its specs build the new part of the graph.
    tables = harbour.after(spark)
    nodes, _ = _graph(tables)
    for spec in draft.node_specs(rows):
        nodes = nodes.unionByName(graph.build_nodes(_table(tables, spec), spec))
    nodes = cut_lineage(nodes)
    built = {}
    for spec in draft.edge_specs(rows):
        build = graph.build_junction_edges if isinstance(spec, JunctionEdgeSpec) else graph.build_fk_edges
        built[spec.edge_type] = build(_table(tables, spec), spec, nodes).count()
    assert built["PILOTAGE"] == 5
    ids = nodes.where("node_type = 'MOORING'").select("node_id").collect()
    if flagged_as == "NODE_TYPE":
        assert sorted(r.node_id for r in ids) == ["1_AA_7", "1_CC_13", "1_EE_23", "3_CC_17"]
        loop = [s for s in draft.edge_specs(rows) if s.edge_type.startswith("SISTER")][0]
        assert isinstance(loop, FkEdgeSpec) and loop.from_type == loop.to_type == "VESSEL"
        assert built[loop.edge_type] == 2
    else:
        assert ids == []


def test_end_points_and_columns_share_one_ranking(spark):
    """A column with two targets takes both places, in the end points and in the load."""
    at = "table_schema string, table_name string, column_name string"
    fks = local_rows(
        spark,
        [("S", "T", "A_ID", "S", "X"), ("S", "T", "A_ID", "S", "Y"), ("S", "T", "B_ID", "S", "Z")],
        f"{at}, ref_table_schema string, ref_table_name string",
    )
    types = local_rows(spark, [(n, f"S.{n}") for n in "XYZ"], "node_type string, source_object string")
    ends = classify.first_two_references(fks).first()
    assert (ends.ref_table_1, ends.ref_table_2) == ("S.X", "S.Y")
    work = local_rows(
        spark,
        [("p", "S", "T", None, "EDGE_TYPE", "XY", "X", "Y", None)],
        "proposal_id string, table_schema string, table_name string, column_name string, final_object_kind string, "
        "final_name string, edge_from string, edge_to string, skip_reason string",
    )
    row = draft.plan_changes(work, local_rows(spark, [], at), fks, types).where("artifact_type = 'POPULATION_SCRIPT'").first()
    assert (row.from_type, row.src_column, row.to_type, row.dst_column) == ("X", "A_ID", "Y", "A_ID")


def test_no_load_without_a_key(spark):
    """A node, or an edge from a table's own id, needs a key; a junction does not."""
    at = "table_schema string, table_name string, column_name string"
    fks = local_rows(spark, [("S", "T", "A_ID", "S", "X"), ("S", "T", "B_ID", "S", "Y")], f"{at}, ref_table_schema string, ref_table_name string")
    types = local_rows(spark, [(n, f"S.{n}") for n in "XYT"], "node_type string, source_object string")
    work = local_rows(
        spark,
        [
            ("node", "S", "T", None, "NODE_TYPE", "T", None, None, None),
            ("column", "S", "T", "A_ID", "EDGE_TYPE", "A", "T", "X", None),
            ("junction", "S", "T", None, "EDGE_TYPE", "AB", "X", "Y", None),
            ("attribute", "S", "T", "C", "ATTRIBUTE", "c", None, None, None),
        ],
        "proposal_id string, table_schema string, table_name string, column_name string, final_object_kind string, "
        "final_name string, edge_from string, edge_to string, skip_reason string",
    )
    plan = draft.plan_changes(work, local_rows(spark, [], at), fks, types)
    rows = plan.collect()
    assert {r.proposal_id: r.skip_reason for r in rows} == {
        "node": draft.NO_KEY, "column": draft.NO_KEY, "junction": None, "attribute": None
    }
    assert Counter(r.proposal_id for r in rows) == {"node": 1, "column": 1, "junction": 3, "attribute": 1}
    assert draft.node_specs(rows) == [] and len(draft.edge_specs(rows)) == 1
    assert all("<missing>" not in r.template_sql for r in draft.with_draft_text(plan).collect() if r.proposal_id != "attribute")
