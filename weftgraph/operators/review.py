"""Second opinion on candidates, and the deduplicated queue of proposals.

A reviewer answers with one JSON object per candidate. It can be any function over batches
of prompts (:func:`score_prompts`); the one shipped here derives its answer from profiled
evidence and is made of column expressions only (:func:`evidence_responses`).
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.keys import content_key, parts_key
from weftgraph.functions.parsing import with_parsed
from weftgraph.operators.classify import ATTRIBUTE, EDGE_TYPE, FLAGGED, NODE_TYPE
from weftgraph.operators.graph import one_per_key

# Answer fields, kinds, statuses and the confidence bands.
KINDS = (ATTRIBUTE, EDGE_TYPE, NODE_TYPE, FLAGGED)
PENDING, APPROVED, REJECTED, DEFERRED = "PENDING", "APPROVED", "REJECTED", "DEFERRED"
STRONG_EVIDENCE = 0.85
FAIR_EVIDENCE = 0.5
PROMPT_INTRO = "Check one proposed change to a graph model that follows relational tables."
PROMPT_TASK = (
    "Say whether the kind fits, and which of ATTRIBUTE, EDGE_TYPE, NODE_TYPE or FLAGGED fits "
    "best. A single descriptive column stays an attribute. Give a confidence of at least "
    f"{STRONG_EVIDENCE} only for explicit evidence, and below {FAIR_EVIDENCE} for a guess. "
    "Answer with the JSON fields agrees_with_rule, recommended_object_kind, confidence, "
    "rationale and industry_note."
)
RESPONSE_SCHEMA = (
    "agrees_with_rule boolean, recommended_object_kind string, confidence double, "
    "rationale string, industry_note string"
)

# Characters of prompts and answers that a worker lets pass before it frees those that are done.
_HELD_CHARS = 1 << 23

_REVIEW = {
    "ai_agrees_with_rule": "boolean",
    "ai_recommended_kind": "string",
    "ai_confidence": "double",
    "ai_rationale": "string",
    "ai_industry_note": "string",
}
_PLACE = ["table_schema", "table_name", "column_name"]
_SOURCE_FIELDS = [
    "candidate_id",
    "run_id",
    "table_schema",
    "table_name",
    "column_name",
    "object_kind",
    "rule_applied",
    "proposed_name",
    "edge_from",
    "edge_to",
    "raw_details",
    *_REVIEW,
]


def as_candidates(rows: DataFrame) -> DataFrame:
    """Add a deterministic ``candidate_id`` and the empty review columns, where absent."""
    if "candidate_id" not in rows.columns:
        parts = ("run_id", *_PLACE, "rule_applied", "edge_to")
        rows = rows.withColumn("candidate_id", parts_key(*parts))
    blanks = {c: F.lit(None).cast(t) for c, t in _REVIEW.items() if c not in rows.columns}
    return rows.withColumns(blanks) if blanks else rows


# ---------------------------------------------------------------- prompts and answers


def build_prompts(candidates: DataFrame, comments: DataFrame, context: str = "") -> DataFrame:
    """One prompt per candidate without an opinion: candidate_id, prompt.

    ``comments`` holds table_schema, table_name, column_name (null for the table itself)
    and comment.
    """
    tables = comments.where(F.col("column_name").isNull()).select(
        "table_schema", "table_name", F.col("comment").alias("_table_comment")
    )
    columns = comments.where(F.col("column_name").isNotNull()).select(
        *_PLACE, F.col("comment").alias("_column_comment")
    )
    rows = (
        candidates.where(F.col("ai_recommended_kind").isNull())
        .join(tables, ["table_schema", "table_name"], "left")
        .join(columns, _PLACE, "left")
    )

    def line(label: str, value: Column, absent: str = "none") -> Column:
        return F.concat(F.lit(f"{label}: "), F.coalesce(value.cast("string"), F.lit(absent)))

    place = F.concat_ws(".", *_PLACE)
    prompt = F.concat_ws(
        "\n",
        F.lit(PROMPT_INTRO),
        line("Domain", F.lit(context or None)),
        line("Source", place),
        line("Proposed kind", F.col("object_kind")),
        line("Rule", F.col("rule_applied")),
        line("Proposed name", F.col("proposed_name")),
        line("From", F.col("edge_from")),
        line("To", F.col("edge_to")),
        line("Details", F.col("raw_details")),
        line("Table comment", F.col("_table_comment")),
        line("Column comment", F.col("_column_comment")),
        F.lit(PROMPT_TASK),
    )
    return rows.select("candidate_id", prompt.alias("prompt"))


def score_prompts(
    prompts: DataFrame, scorer: Callable[[pd.Series], pd.Series], id_col: str = "candidate_id"
) -> DataFrame:
    """Run ``scorer`` over batches of prompts on the executors: id, response.

    The scorer is the caller's; it gets the prompts of one Arrow batch and returns as many
    JSON texts; another number of them fails the task. This is the only place where rows pass through Python.

    Batches that are done stay in reference cycles, which Python alone looks for too rarely, as they are few but
    large objects. They are freed whenever ``_HELD_CHARS`` have passed, so that a worker's memory does not grow
    with its partition.
    """
    id_type = dict(prompts.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = 0
        for batch in batches:
            if held > _HELD_CHARS:
                gc.collect()
                held = 0
            answers = list(scorer(batch["prompt"]))
            held += sum(len(text) for text in (*batch["prompt"], *answers) if isinstance(text, str))
            if len(answers) != len(batch):
                raise ValueError(f"the scorer gave {len(answers)} answers to {len(batch)} prompts")
            yield pd.DataFrame({id_col: batch[id_col], "response": answers})

    return prompts.select(id_col, "prompt").mapInPandas(
        run, schema=f"{id_col} {id_type}, response string"
    )


def evidence_confidence(inclusion: Column, uniqueness: Column) -> Column:
    """Confidence in a reference: share of values found times uniqueness of the target."""
    return F.coalesce(inclusion, F.lit(0.0)) * F.coalesce(uniqueness, F.lit(0.0))


def confidence_band(confidence: Column) -> Column:
    """EXPLICIT, INFERRED or SPECULATIVE."""
    return (
        F.when(confidence >= STRONG_EVIDENCE, "EXPLICIT")
        .when(confidence >= FAIR_EVIDENCE, "INFERRED")
        .when(confidence.isNotNull(), "SPECULATIVE")
    )


def evidence_responses(candidates: DataFrame) -> DataFrame:
    """The shipped reviewer: candidate_id, response.

    Needs ``inclusion`` and ``uniqueness`` on the candidates. A reference with at least
    fair evidence is an edge, any other column an attribute; a table keeps its rule kind.
    """
    confidence = F.when(
        F.col("column_name").isNotNull(), evidence_confidence(F.col("inclusion"), F.col("uniqueness"))
    ).otherwise(F.coalesce(F.col("uniqueness"), F.lit(0.0)))
    kind = (
        F.when(F.col("column_name").isNull(), F.col("object_kind"))
        .when(confidence >= FAIR_EVIDENCE, EDGE_TYPE)
        .otherwise(ATTRIBUTE)
    )
    answer = F.struct(
        (kind == F.col("object_kind")).alias("agrees_with_rule"),
        kind.alias("recommended_object_kind"),
        confidence.alias("confidence"),
        F.concat(F.lit("evidence: "), confidence_band(confidence)).alias("rationale"),
        F.lit("").alias("industry_note"),
    )
    return candidates.select("candidate_id", F.to_json(answer).alias("response"))


def parse_responses(responses: DataFrame, id_col: str = "candidate_id") -> DataFrame:
    """Typed answers with ``is_valid``; text that cannot be read gives nulls, no failure.

    Valid means: every field is there, the kind is known and the confidence is in 0..1.
    """
    answer = F.from_json("response", RESPONSE_SCHEMA, {"mode": "PERMISSIVE"})
    got = with_parsed(responses.select(id_col, "response"), answer, "r")
    complete = F.lit(True)
    for field in RESPONSE_SCHEMA.split(", "):
        complete = complete & F.col(f"r.{field.split()[0]}").isNotNull()
    valid = (
        complete
        & F.col("r.recommended_object_kind").isin(*KINDS)
        & F.col("r.confidence").between(0.0, 1.0)
    )
    return got.select(
        id_col,
        F.col("r.agrees_with_rule").alias("ai_agrees_with_rule"),
        F.col("r.recommended_object_kind").alias("ai_recommended_kind"),
        F.col("r.confidence").alias("ai_confidence"),
        F.col("r.rationale").alias("ai_rationale"),
        F.col("r.industry_note").alias("ai_industry_note"),
        F.coalesce(valid, F.lit(False)).alias("is_valid"),
        "response",
    )


def rejected_responses(parsed: DataFrame, id_col: str = "candidate_id") -> DataFrame:
    """Answers that failed the checks, with their text."""
    return parsed.where(~F.col("is_valid")).select(id_col, "response")


def write_back(candidates: DataFrame, parsed: DataFrame) -> DataFrame:
    """Candidates with valid answers filled in; rows that have an opinion keep it.

    Of several answers for one candidate the least confident one is taken.
    """
    fresh = one_per_key(
        parsed.where("is_valid").select("candidate_id", *_REVIEW), ["candidate_id"], "ai_confidence"
    )
    renamed = fresh.select("candidate_id", *(F.col(c).alias(f"_new_{c}") for c in _REVIEW))
    open_row = F.col("ai_recommended_kind").isNull()
    merged = candidates.join(renamed, "candidate_id", "left")
    filled = {c: F.when(open_row, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in _REVIEW}
    return merged.withColumns(filled).select(*candidates.columns)


def review_listing(candidates: DataFrame) -> DataFrame:
    """Rule beside opinion, in source order."""
    return candidates.select(
        "table_name",
        "column_name",
        F.col("object_kind").alias("rule_kind"),
        "ai_recommended_kind",
        "ai_agrees_with_rule",
        "ai_confidence",
        "ai_rationale",
        "ai_industry_note",
    ).orderBy("table_name", "column_name")


# ---------------------------------------------------------------- proposals


def fingerprint(with_target: bool = False) -> Column:
    """Content key of a candidate's place.

    ``with_target`` adds the edge target, so that one column referencing two tables makes
    two proposals.
    """
    more = [F.col("edge_to")] if with_target else []
    return content_key(F.col("table_schema"), F.col("table_name"), F.col("column_name"), *more)


def default_kind() -> Column:
    """The rule's kind; a FLAGGED candidate takes the recommended one."""
    flagged = F.col("object_kind") == FLAGGED
    return F.when(flagged, F.col("ai_recommended_kind")).otherwise(F.col("object_kind"))


def to_proposals(
    candidates: DataFrame, changes: DataFrame, with_target: bool = False
) -> DataFrame:
    """Candidates in proposal form, PENDING, with the time of the change behind them."""
    seen = changes.select("run_id", *_PLACE, "detected_ts").alias("d")
    c = candidates.alias("c")
    same = F.col("c.column_name").eqNullSafe(F.col("d.column_name"))
    for name in ("run_id", "table_schema", "table_name"):
        same = same & (F.col(f"c.{name}") == F.col(f"d.{name}"))
    rows = c.join(seen, same).select("c.*", "d.detected_ts")
    key = fingerprint(with_target)
    return rows.select(
        F.sha2(F.concat_ws("|", key, "run_id"), 256).alias("proposal_id"),
        key.alias("fingerprint_key"),
        "object_kind",
        default_kind().alias("final_object_kind"),
        "rule_applied",
        "proposed_name",
        F.col("proposed_name").alias("final_name"),
        "edge_from",
        "edge_to",
        F.to_json(F.struct(*_SOURCE_FIELDS)).alias("source_object"),
        *_REVIEW,
        F.lit(PENDING).alias("status"),
        F.lit(None).cast("string").alias("decided_by"),
        F.lit(None).cast("timestamp_ntz").alias("decided_ts"),
        F.lit(None).cast("string").alias("rationale"),
        "detected_ts",
    )


def new_proposals(
    candidates: DataFrame,
    changes: DataFrame,
    existing: DataFrame,
    with_target: bool = False,
) -> DataFrame:
    """The proposals this run adds: no key that is pending or finally decided, and each
    key once. A deferred proposal does not hold its key back.

    Candidates are reduced to one per key before anything is joined to them.
    """
    keyed = candidates.withColumn("_key", fingerprint(with_target))
    blocked = existing.where(F.col("status").isin(PENDING, APPROVED, REJECTED)).select(
        F.col("fingerprint_key").alias("_key")
    )
    fresh = one_per_key(keyed, ["_key"], "candidate_id").join(blocked, "_key", "left_anti")
    stamped = changes.groupBy("run_id", *_PLACE).agg(F.min("detected_ts").alias("detected_ts"))
    return to_proposals(fresh.drop("_key"), stamped, with_target)


def persist(
    candidates: DataFrame, changes: DataFrame, existing: DataFrame, with_target: bool = False
) -> DataFrame:
    """All proposals after the run."""
    return existing.unionByName(new_proposals(candidates, changes, existing, with_target))


def unpack_source(proposals: DataFrame) -> DataFrame:
    """Add the place fields held in ``source_object``; the text is parsed once."""
    place = F.from_json("source_object", ", ".join(f"{c} string" for c in _PLACE))
    return with_parsed(proposals, place, "_place").select(
        *proposals.columns, *(F.col(f"_place.{c}").alias(c) for c in _PLACE)
    )


def pending_queue(proposals: DataFrame, include_deferred: bool = False) -> DataFrame:
    """The open proposals, oldest first, with their place unpacked."""
    shown = (PENDING, DEFERRED) if include_deferred else (PENDING,)
    rows = unpack_source(proposals.where(F.col("status").isin(*shown)))
    return rows.select(
        "proposal_id",
        "final_name",
        "final_object_kind",
        F.col("object_kind").alias("rule_object_kind"),
        "rule_applied",
        "proposed_name",
        "edge_from",
        "edge_to",
        *_REVIEW,
        *_PLACE,
        "status",
        "detected_ts",
    ).orderBy("detected_ts", "proposal_id")
