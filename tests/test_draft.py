import json

from pyspark.sql import functions as F

from weftgraph.functions.text import DESCRIPTION_SLOT
from weftgraph.operators import draft
from weftgraph.session import local_rows

ARTIFACT = (
    "artifact_id string, proposal_id string, artifact_type string, object_kind string, type_name string, "
    "template_sql string, ai_refined_sql string, ai_notes string, dev_status string, generated_ts timestamp_ntz"
)


def artifacts(spark):
    rows = [
        ("reg", "p", "NODE_TYPE_DDL", "NODE_TYPE", "A", f"VALUES ('{DESCRIPTION_SLOT}')", None),
        ("view", "p", "VIEW_DDL", "EDGE_TYPE", "E", "COMMENT 'Edges of type E.' AS", None),
        ("load", "p", "POPULATION_SCRIPT", "NODE_TYPE", "A", f"INSERT {DESCRIPTION_SLOT}", None),
        ("open", "p", "VIEW_DDL", "NODE_TYPE", "B", "COMMENT 'Nodes of type B.' AS", None),
        ("done", "q", "VIEW_DDL", "NODE_TYPE", "B", "COMMENT 'Nodes of type B.' AS", "before"),
    ]
    return local_rows(spark, [(*r, None, "DRAFT", None) for r in rows], ARTIFACT)


def test_descriptions_are_spliced_literally(spark):
    text = "it's $1 and \\2\nnext\tline"
    found = local_rows(spark, [("reg", text), ("view", text), ("load", text), ("done", text)],
                       "artifact_id string, description string")
    got = {r.artifact_id: r.ai_refined_sql for r in draft.attach_descriptions(artifacts(spark), found).collect()}
    body = "it''s $1 and \\2 next line"
    assert got == {
        "reg": f"VALUES ('{body}')", "view": f"COMMENT '{body}' AS",
        "load": f"INSERT {DESCRIPTION_SLOT}", "open": None, "done": "before",
    }


def test_description_prompts_leave_loads_and_done_ones_out(spark):
    source = json.dumps({"table_schema": "s", "table_name": "T", "column_name": None})
    proposals = local_rows(spark, [("p", "NODE_TYPE", "A", None, None, source), ("q", "NODE_TYPE", "B", None, None, source)],
                           "proposal_id string, final_object_kind string, final_name string, edge_from string, "
                           "edge_to string, source_object string")
    comments = local_rows(spark, [("s", "T", None, "about T")],
                          "table_schema string, table_name string, column_name string, comment string")
    rows = draft.description_prompts(artifacts(spark), proposals, comments, "books").collect()
    assert sorted(r.artifact_id for r in rows) == ["open", "reg", "view"]
    assert all("Table comment: about T" in r.prompt and "Domain: books" in r.prompt for r in rows)
    answers = local_rows(spark, [("a", '{"description": "x"}'), ("b", "{}"), ("c", "no"), ("d", '{"description": " "}')],
                         "artifact_id string, response string")
    assert draft.parse_descriptions(answers).collect() == [("a", "x")]


def test_skip_reasons(spark):
    rows = local_rows(spark, [
        ("ATTRIBUTE", None, None, None), ("NODE_TYPE", "C", None, None), ("EDGE_TYPE", "C", "A", None),
        ("FLAGGED", None, None, None), (None, None, None, None), ("EDGE_TYPE", None, "A", "B"),
    ], "final_object_kind string, column_name string, edge_from string, edge_to string")
    reasons = [r.r for r in rows.select(draft.skip_reason().alias("r")).collect()]
    assert reasons == ["attribute without a column", "single column as a node type",
                       "edge without both end points", "kind cannot be built", "kind cannot be built", None]


def test_listing_and_export_order(spark, tmp_path):
    stamps = {"reg": "2024-01-01", "view": "2024-01-05", "load": "2024-01-02", "open": "2024-01-03", "done": "2024-01-04"}
    when = F.create_map(*(x for k, v in stamps.items() for x in (F.lit(k), F.lit(v))))
    rows = artifacts(spark).withColumn("generated_ts", when[F.col("artifact_id")].cast("timestamp_ntz"))
    source = json.dumps({"table_schema": "s", "table_name": "T"})
    proposals = local_rows(spark, [("p", "NODE_TYPE", "A", None, None, source), ("q", "NODE_TYPE", "B", None, None, source)],
                           "proposal_id string, final_object_kind string, final_name string, edge_from string, "
                           "edge_to string, source_object string")
    listed = [r.artifact_id for r in draft.artifact_listing(rows, proposals).collect()]
    assert listed == ["reg", "load", "open", "view", "done"]
    exported = draft.export_rows(rows, proposals)
    objects = [json.loads(r.value) for r in exported.collect()]
    assert [o["artifact_id"] for o in objects] == ["reg", "load", "open", "done", "view"]
    assert objects[0]["template_sql"] == f"VALUES ('{DESCRIPTION_SLOT}')"
    assert "edge_from" not in objects[0]
    draft.write_export(exported, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 5
