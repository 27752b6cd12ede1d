"""Turn approved proposals into typed build plans, drafts and exports.

A plan row says what to build in columns that the graph operators can run from
(:func:`node_specs`, :func:`edge_specs`); the draft text is a rendering of the same row for
a developer to read. Nothing here runs a draft.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from weftgraph.functions.keys import parts_key
from weftgraph.functions.text import (
    DESCRIPTION_SLOT,
    KEY_SUFFIX,
    display_name,
    one_line,
    sql_literal_body,
    without_key_suffix,
)
from weftgraph.operators.classify import ATTRIBUTE, EDGE_TYPE, NODE_TYPE, source_object, whole_references
from weftgraph.operators.decide import ACTIONABLE
from weftgraph.operators.review import APPROVED, unpack_source
from weftgraph.specs import FkEdgeSpec, JunctionEdgeSpec, NodeSpec

# Artifact types and their first status.
DICTIONARY_ENTRY = "DICTIONARY_ENTRY"
NODE_TYPE_DDL = "NODE_TYPE_DDL"
EDGE_TYPE_DDL = "EDGE_TYPE_DDL"
VIEW_DDL = "VIEW_DDL"
POPULATION_SCRIPT = "POPULATION_SCRIPT"
DRAFT = "DRAFT"

MANUAL = "MANUAL"
NO_KEY = "table without a key"
NO_REFERENCES = "table without two references"
PROMPT_INTRO = "Describe this part of a graph model in one plain sentence."
PROMPT_TASK = "Answer with the JSON field description; return no part of the draft."

_EDGE_PARTS = [EDGE_TYPE_DDL, VIEW_DDL, POPULATION_SCRIPT]
_NODE_PARTS = [NODE_TYPE_DDL, VIEW_DDL, POPULATION_SCRIPT]
_TABLE = ["table_schema", "table_name"]
_PLAN = [
    "artifact_id",
    "proposal_id",
    "artifact_type",
    "object_kind",
    "type_name",
    "display_name",
    "owner_type",
    "from_type",
    "to_type",
    "key_columns",
    "src_column",
    "dst_column",
    "source_object",
    "source_column",
    "skip_reason",
]


# ---------------------------------------------------------------- work selection


def pending_work(proposals: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Approved proposals without any artifact, with place and ``skip_reason``."""
    done = artifacts.select("proposal_id")
    approved = proposals.where(F.col("status") == APPROVED)
    rows = unpack_source(approved.join(done, "proposal_id", "left_anti"))
    return rows.withColumn("skip_reason", skip_reason())


def work_count(proposals: DataFrame, artifacts: DataFrame) -> DataFrame:
    """One row: how many proposals a drafting run would act on."""
    done = artifacts.select("proposal_id")
    approved = proposals.where(F.col("status") == APPROVED).select("proposal_id")
    return approved.join(done, "proposal_id", "left_anti").agg(
        F.count(F.lit(1)).alias("proposals")
    )


def skip_reason() -> Column:
    """Why a proposal needs hand work; null when it can be drafted. A null kind does."""
    kind, column = F.col("final_object_kind"), F.col("column_name")
    no_end = F.col("edge_from").isNull() | F.col("edge_to").isNull()
    return (
        F.when((kind == ATTRIBUTE) & column.isNull(), "attribute without a column")
        .when((kind == NODE_TYPE) & column.isNotNull(), "single column as a node type")
        .when((kind == EDGE_TYPE) & no_end, "edge without both end points")
        .when(~F.coalesce(kind.isin(*ACTIONABLE), F.lit(False)), "kind cannot be built")
    )


# ---------------------------------------------------------------- plans


def key_lists(pks: DataFrame) -> DataFrame:
    """Key columns per table in name order; a table has few, so the list is short."""
    return pks.groupBy(*_TABLE).agg(
        F.array_sort(F.collect_list("column_name")).alias("key_columns")
    )


def reference_lists(fks: DataFrame, node_types: DataFrame) -> DataFrame:
    """Per table: its references in the order of :func:`first_two_references`, and, by name, the
    reference columns that point at a known node type with that type. A composite reference is one
    entry of both, its columns listed in one text. Both are bounded by the width of the table."""
    targets = node_types.select(
        F.col("node_type").alias("to_type"), F.col("source_object").alias("_ref")
    )
    named = whole_references(fks).withColumn("_ref", source_object("ref_table_schema", "ref_table_name"))
    tied = F.when(F.col("to_type").isNotNull(), F.struct("column_name", "to_type"))
    return (
        named.join(targets, "_ref", "left")
        .groupBy(*_TABLE)
        .agg(
            F.array_sort(
                F.collect_set(F.struct("column_name", "ref_table_schema", "ref_table_name"))
            ).alias("references"),
            F.array_sort(F.collect_set(tied)).alias("ties"),
        )
    )


def plan_changes(
    work: DataFrame,
    pks: DataFrame,
    fks: DataFrame,
    node_types: DataFrame,
    suffix: str = KEY_SUFFIX,
) -> DataFrame:
    """One row per artifact of every pending proposal.

    ATTRIBUTE: a dictionary entry naming its node type, if known. EDGE_TYPE: registration,
    view and load, from the reference column or from the first two references of a junction,
    ranked as for its end points. NODE_TYPE: the same three, plus three per reference to a known type, so that
    the new node stays connected. A skipped proposal gets one entry with its reason; so does
    one whose load would need the key, or the two references, of a table that has none.

    The proposals are read once: keys, references and owner are joined to them, and the
    artifacts of each are listed in its row and exploded.
    """
    owners = node_types.select(
        F.col("node_type").alias("owner"), F.col("source_object").alias("source")
    )
    rows = (
        work.withColumn("source", source_object())
        .join(key_lists(pks), _TABLE, "left")
        .join(reference_lists(fks, node_types), _TABLE, "left")
        .join(owners, "source", "left")
    )
    name, kind = F.col("final_name"), F.col("final_object_kind")
    column_level = F.col("column_name").isNotNull()
    edge = {
        "from_type": F.col("edge_from"),
        "to_type": F.col("edge_to"),
        "src_column": F.when(~column_level, F.get("references", F.lit(0))["column_name"]),
        "dst_column": F.when(column_level, F.col("column_name")).otherwise(
            F.get("references", F.lit(1))["column_name"]
        ),
    }
    by_key = (kind == NODE_TYPE) | ((kind == EDGE_TYPE) & column_level)
    tied = (kind == EDGE_TYPE) & ~column_level
    lacking = F.when(by_key & F.col("key_columns").isNull(), NO_KEY).when(
        tied & F.get("references", F.lit(1)).isNull(), NO_REFERENCES
    )
    rows = rows.withColumn("skip_reason", F.coalesce("skip_reason", lacking))

    def bundled(tie: Column) -> Column:
        label = F.concat(name, F.lit("_"), without_key_suffix(tie["column_name"], suffix))
        ends = {
            "from_type": name,
            "to_type": tie["to_type"],
            "dst_column": tie["column_name"],
        }
        return _parts(_EDGE_PARTS, EDGE_TYPE, label, **ends)

    ties = F.coalesce(F.flatten(F.transform("ties", bundled)), F.array())
    parts = (
        F.when(F.col("skip_reason").isNotNull(), _parts([DICTIONARY_ENTRY], MANUAL, name))
        .when(
            kind == ATTRIBUTE,
            _parts([DICTIONARY_ENTRY], ATTRIBUTE, name, owner_type=F.col("owner")),
        )
        .when(kind == EDGE_TYPE, _parts(_EDGE_PARTS, EDGE_TYPE, name, **edge))
        .otherwise(F.concat(_parts(_NODE_PARTS, NODE_TYPE, name), ties))
    )
    planned = rows.withColumn("part", F.explode(parts)).select(
        "proposal_id",
        "part.*",
        display_name(F.col("part.type_name")).alias("display_name"),
        "key_columns",
        F.col("source").alias("source_object"),
        F.col("column_name").alias("source_column"),
        "skip_reason",
    )
    identity = ("proposal_id", "artifact_type", "type_name", "to_type", "dst_column")
    return planned.withColumn("artifact_id", parts_key(*identity)).select(*_PLAN)


def _parts(artifact_types: list[str], kind: str, name: Column, **fields: Column) -> Column:
    """An array of plan entries of one object, all fields being text."""
    absent = F.lit(None).cast("string")
    rest = ("owner_type", "from_type", "to_type", "src_column", "dst_column")
    return F.array(
        *(
            F.struct(
                F.lit(artifact_type).alias("artifact_type"),
                F.lit(kind).alias("object_kind"),
                name.alias("type_name"),
                *(fields.get(f, absent).alias(f) for f in rest),
            )
            for artifact_type in artifact_types
        )
    )


def node_specs(plan: Iterable[Row]) -> list[NodeSpec]:
    """Specs of the node loads among collected plan rows (a review-sized selection)."""
    return [
        NodeSpec(r.type_name, r.source_object, tuple(r.key_columns))
        for r in plan
        if r.artifact_type == POPULATION_SCRIPT and r.object_kind == NODE_TYPE
    ]


def edge_specs(plan: Iterable[Row]) -> list[FkEdgeSpec | JunctionEdgeSpec]:
    """Specs of the edge loads among collected plan rows; one over a composite reference is refused."""
    specs: list[FkEdgeSpec | JunctionEdgeSpec] = []
    for r in plan:
        if r.artifact_type != POPULATION_SCRIPT or r.object_kind != EDGE_TYPE:
            continue
        if any("," in (c or "") for c in (r.src_column, r.dst_column)):
            raise ValueError(f"{r.type_name} loads a composite reference: {r.src_column or r.dst_column}")
        if r.src_column is None:
            specs.append(
                FkEdgeSpec(
                    r.type_name,
                    r.source_object,
                    r.from_type,
                    tuple(r.key_columns),
                    r.dst_column,
                    r.to_type,
                )
            )
        else:
            specs.append(
                JunctionEdgeSpec(
                    r.type_name, r.source_object, r.from_type, r.src_column, r.to_type, r.dst_column
                )
            )
    return specs


# ---------------------------------------------------------------- draft text


def view_sentence(kind: Column, name: Column) -> Column:
    """The sentence a view draft carries until it has a description."""
    noun = F.when(kind == NODE_TYPE, "Nodes").otherwise("Edges")
    return F.concat(noun, F.lit(" of type "), name, F.lit("."))


def with_draft_text(plan: DataFrame, header: str = "-- Draft for review.") -> DataFrame:
    """Add ``template_sql``: the plan row as Spark SQL for a developer to check."""
    name, source = F.col("type_name"), F.col("source_object")
    ident = F.lower(name)
    node_id = F.array_join(
        F.transform("key_columns", lambda c: F.concat(F.lit("cast("), c, F.lit(" as string)"))),
        " || '_' || ",
    )
    key_list = F.array_join("key_columns", ", ")

    def lines(*parts: Column | str) -> Column:
        return F.concat_ws("\n", *(F.lit(p) if isinstance(p, str) else p for p in parts))

    def text(template: str, **values: Column) -> Column:
        """``template`` with {names} replaced by columns; a null value shows as <missing>."""
        pieces: list[Column] = []
        rest = template
        while "{" in rest:
            before, _, tail = rest.partition("{")
            key, _, rest = tail.partition("}")
            pieces += [F.lit(before), F.coalesce(values[key], F.lit("<missing>"))]
        return F.concat(*pieces, F.lit(rest))

    def as_id(columns: str) -> Column:
        parts = F.transform(F.split(columns, ","), lambda c: F.concat(F.lit("cast("), c, F.lit(" as string)")))
        return F.array_join(parts, " || '_' || ")

    is_set = F.array_join(F.transform(F.split("dst_column", ","), lambda c: F.concat(c, F.lit(" IS NOT NULL"))), " AND ")
    common = {
        "name": name,
        "ident": ident,
        "shown": F.col("display_name"),
        "source": source,
        "from": F.col("from_type"),
        "to": F.col("to_type"),
        "keys": key_list,
        "id": node_id,
        "src": F.col("src_column"),
        "dst": F.col("dst_column"),
        "src_id": as_id("src_column"),
        "dst_id": as_id("dst_column"),
        "dst_set": F.coalesce(is_set, F.lit("<missing> IS NOT NULL")),
        "owner": F.col("owner_type"),
        "column": F.col("source_column"),
        "sentence": view_sentence(F.col("object_kind"), name),
        "why": F.col("skip_reason"),
    }
    manual = text("-- By hand: {why}", **common)
    entry = lines(
        text("-- Attribute {name} of {owner}", **common),
        text("-- read from {source}.{column}; kept in props, no load needed", **common),
        f"-- {DESCRIPTION_SLOT}",
    )
    node_row = lines(
        "INSERT INTO node_types (node_type, display_name, description, source_object)",
        text(
            "VALUES ('{name}', '{shown}', '" + DESCRIPTION_SLOT + "', '{source}');", **common
        ),
    )
    edge_row = lines(
        "INSERT INTO edge_types",
        "  (edge_type, display_name, description, from_node_type, to_node_type, source_object)",
        text(
            "VALUES ('{name}', '{shown}', '"
            + DESCRIPTION_SLOT
            + "', '{from}', '{to}', '{source}');",
            **common,
        ),
    )
    node_view = lines(
        text("CREATE OR REPLACE VIEW v_{ident} COMMENT '{sentence}' AS", **common),
        text("SELECT node_sk, node_id, props FROM nodes WHERE node_type = '{name}';", **common),
    )
    edge_view = lines(
        text("CREATE OR REPLACE VIEW v_{ident} COMMENT '{sentence}' AS", **common),
        text(
            "SELECT edge_sk, src_id, dst_id, props FROM edges WHERE edge_type = '{name}';", **common
        ),
    )
    node_load = lines(
        "INSERT INTO nodes (node_id, node_type, props, source_object)",
        text("SELECT {id}, '{name}',", **common),
        text("  to_json(struct(* EXCEPT ({keys}))), '{source}'", **common),
        text("FROM {source};", **common),
    )
    fk_load = lines(
        "INSERT INTO edges (edge_type, src_type, src_id, dst_type, dst_id, source_object)",
        text("SELECT '{name}', '{from}', {id},", **common),
        text("  '{to}', {dst_id}, '{source}'", **common),
        text("FROM {source} WHERE {dst_set};", **common),
    )
    junction_load = lines(
        text("-- Check that {src} names a {from} and {dst} a {to}.", **common),
        "INSERT INTO edges (edge_type, src_type, src_id, dst_type, dst_id, props, source_object)",
        text("SELECT '{name}', '{from}', {src_id},", **common),
        text("  '{to}', {dst_id},", **common),
        text("  to_json(struct(* EXCEPT ({src}, {dst}))), '{source}'", **common),
        text("FROM {source};", **common),
    )
    is_node = F.col("object_kind") == NODE_TYPE
    kind = F.col("artifact_type")
    body = (
        F.when(F.col("object_kind") == MANUAL, manual)
        .when(kind == DICTIONARY_ENTRY, entry)
        .when(kind == NODE_TYPE_DDL, node_row)
        .when(kind == EDGE_TYPE_DDL, edge_row)
        .when((kind == VIEW_DDL) & is_node, node_view)
        .when(kind == VIEW_DDL, edge_view)
        .when(is_node, node_load)
        .when(F.col("src_column").isNull(), fk_load)
        .otherwise(junction_load)
    )
    return plan.withColumn("template_sql", lines(header, "", body))


def as_artifacts(drafts: DataFrame, generated_ts: Column | None = None) -> DataFrame:
    """Drafts as stored artifacts, not yet refined."""
    when = F.localtimestamp() if generated_ts is None else generated_ts
    empty = F.lit(None).cast("string")
    return drafts.select(
        "artifact_id",
        "proposal_id",
        "artifact_type",
        "object_kind",
        "type_name",
        "template_sql",
        empty.alias("ai_refined_sql"),
        empty.alias("ai_notes"),
        F.lit(DRAFT).alias("dev_status"),
        when.alias("generated_ts"),
    )


# ---------------------------------------------------------------- descriptions


def description_prompts(
    artifacts: DataFrame, proposals: DataFrame, comments: DataFrame, context: str = ""
) -> DataFrame:
    """One prompt per artifact that still takes a description: artifact_id, prompt."""
    place = ["table_schema", "table_name", "column_name"]
    about = unpack_source(proposals).select(
        "proposal_id", "final_object_kind", "final_name", "edge_from", "edge_to", *place
    )
    tables = comments.where(F.col("column_name").isNull()).select(
        *_TABLE, F.col("comment").alias("_table_comment")
    )
    columns = comments.where(F.col("column_name").isNotNull()).select(
        *place, F.col("comment").alias("_column_comment")
    )
    rows = (
        artifacts.where(
            F.col("ai_refined_sql").isNull() & (F.col("artifact_type") != POPULATION_SCRIPT)
        )
        .select("artifact_id", "proposal_id", "artifact_type", "template_sql")
        .join(about, "proposal_id")
        .join(tables, _TABLE, "left")
        .join(columns, place, "left")
    )

    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"{label}: "), F.coalesce(value, F.lit("none")))

    prompt = F.concat_ws(
        "\n",
        F.lit(PROMPT_INTRO),
        line("Domain", F.lit(context or None)),
        line("Artifact", F.col("artifact_type")),
        line("Kind", F.col("final_object_kind")),
        line("Name", F.col("final_name")),
        line("From", F.col("edge_from")),
        line("To", F.col("edge_to")),
        line("Source", F.concat_ws(".", *place)),
        line("Table comment", F.col("_table_comment")),
        line("Column comment", F.col("_column_comment")),
        line("Draft, for reference only", F.col("template_sql")),
        F.lit(PROMPT_TASK),
    )
    return rows.select("artifact_id", prompt.alias("prompt"))


def parse_descriptions(responses: DataFrame) -> DataFrame:
    """Descriptions from JSON answers; unreadable or empty ones are left out."""
    text = F.from_json("response", "description string", {"mode": "PERMISSIVE"})["description"]
    return responses.select("artifact_id", text.alias("description")).where(
        F.length(F.trim("description")) > 0
    )


def attach_descriptions(artifacts: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Fill ``ai_refined_sql`` of artifacts that have none; the template stays untouched.

    Loads are copied as they are. Elsewhere one description is put into the one known slot
    by literal replacement: white space collapsed, single quotes doubled, nothing in it
    taken for a pattern. Without a description the artifact stays open.
    """
    template = F.col("template_sql")
    body = sql_literal_body(one_line(F.col("description")))
    sentence = view_sentence(F.col("object_kind"), F.col("type_name"))
    spliced = (
        F.when(template.contains(DESCRIPTION_SLOT), F.replace(template, F.lit(DESCRIPTION_SLOT), body))
        .when(F.contains(template, sentence), F.replace(template, sentence, body))
        .otherwise(template)
    )
    load = F.col("artifact_type") == POPULATION_SCRIPT
    todo = F.col("ai_refined_sql").isNull()
    has = F.col("description").isNotNull()
    refined = (
        F.when(~todo, F.col("ai_refined_sql")).when(load, template).when(has, spliced)
    )
    notes = (
        F.when(~todo, F.col("ai_notes"))
        .when(load, "load copied unchanged")
        .when(has, "description filled in")
    )
    return (
        artifacts.join(descriptions.select("artifact_id", "description"), "artifact_id", "left")
        .withColumns({"ai_refined_sql": refined, "ai_notes": notes})
        .select(*artifacts.columns)
    )


# ---------------------------------------------------------------- listing and export


def with_group_latest(df: DataFrame, group: str, ts: str, out: str) -> DataFrame:
    """Add the latest ``ts`` of each row's group.

    The maximum is taken by an aggregate (combined before the shuffle) and joined back, so
    a group holding much of the data is never one window partition.
    """
    latest = df.groupBy(group).agg(F.max(ts).alias(out))
    return df.join(latest, group)


def artifact_listing(artifacts: DataFrame, proposals: DataFrame) -> DataFrame:
    """All artifacts, the most recently drafted proposal first, kept together."""
    names = proposals.select("proposal_id", "final_name", "final_object_kind")
    rows = with_group_latest(artifacts, "proposal_id", "generated_ts", "proposal_latest_ts")
    return (
        rows.join(names, "proposal_id")
        .select(
            "proposal_id",
            "final_name",
            "final_object_kind",
            "artifact_id",
            "artifact_type",
            "dev_status",
            "template_sql",
            "ai_refined_sql",
            "ai_notes",
            "generated_ts",
            "proposal_latest_ts",
        )
        .orderBy(F.desc("proposal_latest_ts"), "proposal_id", "artifact_type", "artifact_id")
    )


def export_rows(artifacts: DataFrame, proposals: DataFrame) -> DataFrame:
    """One JSON text per artifact with its proposal, in time order: column ``value``."""
    about = unpack_source(proposals).select(
        "proposal_id",
        "final_name",
        "final_object_kind",
        "edge_from",
        "edge_to",
        *_TABLE,
        "column_name",
    )
    fields = [
        "proposal_id",
        "final_name",
        "final_object_kind",
        "edge_from",
        "edge_to",
        *_TABLE,
        "column_name",
        "artifact_id",
        "artifact_type",
        "dev_status",
        "template_sql",
        "ai_refined_sql",
        "ai_notes",
    ]
    rows = artifacts.select("generated_ts", "proposal_id", *fields[8:]).join(about, "proposal_id")
    return rows.orderBy("generated_ts", "proposal_id", "artifact_type", "artifact_id").select(
        F.to_json(F.struct(*fields)).alias("value")
    )


def write_export(exported: DataFrame, path: str) -> None:
    """Write the export as JSON lines, in as many files as there are partitions."""
    exported.write.text(path)
