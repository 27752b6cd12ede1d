"""Apply batches of review decisions, with an audit trail.

Decisions: proposal_id, decision_seq (integer, unique within a proposal), status,
rationale, final_name, final_kind, decided_by, decided_ts. Null names and kinds leave the
proposal as it is. Within a batch the decisions on one proposal act in sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions.keys import parts_key
from weftgraph.operators.classify import ATTRIBUTE, EDGE_TYPE, NODE_TYPE
from weftgraph.operators.review import APPROVED, DEFERRED, PENDING, REJECTED

# What can be decided, and the kinds that can be built.
DECISIONS = (APPROVED, REJECTED, DEFERRED)
ACTIONABLE = (ATTRIBUTE, NODE_TYPE, EDGE_TYPE)

OK = "OK"
BAD_STATUS = "ERROR: unknown status"
NOT_FOUND = "ERROR: no such proposal"
CLOSED = "ERROR: already decided"
DRAFTED = "ERROR: drafts exist, name and kind are fixed"
NOT_ACTIONABLE = "ERROR: kind cannot be approved"


# A proposal with many decisions is cut into this many chunks of about equal length.
_CHUNKS = 256

# How a chunk can be entered while the proposal is open, as bits of a mask: with a kind that can
# be built or not, with drafts or without. What a decision closes differs between these alone.
_ENTRIES = tuple((drafted, fit) for drafted in (False, True) for fit in (True, False))


def _closed(mask: Column) -> Column:
    """Whether the mask says closed for a chunk entered as ``_drafted`` and ``_entered`` tell."""
    found = F.lit(False)
    for bit, (drafted, fit) in enumerate(_ENTRIES):
        here = (F.col("_drafted") == drafted) & (_fit(F.col("_entered")) == fit)
        found = F.when(here, mask.bitwiseAND(1 << bit) > 0).otherwise(found)
    return found


def _fit(kind: Column) -> Column:
    return F.coalesce(kind.isin(*ACTIONABLE), F.lit(False))


def _known(status: Column) -> Column:
    return F.coalesce(status.isin(*DECISIONS), F.lit(False))


def _chunk_edges(decisions: DataFrame, chunk_rows: int) -> DataFrame:
    """The places where proposals with over ``chunk_rows`` decisions are cut: few rows, by position."""
    places = decisions.select("proposal_id", "decision_seq").where(F.col("proposal_id").isNotNull())
    several = places.groupBy("proposal_id").count().where(F.col("count") > chunk_rows)
    shares = F.lit([i / _CHUNKS for i in range(1, _CHUNKS)])
    return (
        places.join(several, "proposal_id", "left_semi")
        .groupBy("proposal_id")
        .agg(F.percentile_approx("decision_seq", shares, F.lit(8 * _CHUNKS)).alias("_edges"))
    )


def _transitions(decisions: DataFrame, edges: DataFrame, how: str = "left") -> DataFrame:
    """Decisions with their chunk, what they do to an open proposal, and what those before
    them in the chunk did.

    ``_sets`` is the kind a deferral leaves behind (never where drafts exist, as an edit fails
    then); ``_closes`` has a bit for each of ``_ENTRIES``. ``_kind_before`` and ``_shut_before``
    are the same for all earlier decisions of the chunk together. One exchange and one sort.
    """
    edits = F.col("final_name").isNotNull() | F.col("final_kind").isNotNull()
    passed = F.size(F.filter("_edges", lambda e: e < F.col("decision_seq")))
    # Decisions without a proposal all fail the same way, so their order does not matter.
    chunk = F.when(F.col("proposal_id").isNull(), F.pmod(F.xxhash64("decision_seq"), F.lit(_CHUNKS)))
    before = (
        Window.partitionBy("proposal_id", "_chunk")
        .orderBy("decision_seq")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = (
        decisions.withColumns({"status": F.upper("status"), "final_kind": F.upper("final_kind")})
        .join(edges, "proposal_id", how)
        .withColumn("_chunk", F.coalesce(chunk, F.when(F.col("_edges").isNotNull(), passed), F.lit(0)).cast("int"))
        .drop("_edges")
        .withColumn("_sets", F.when(F.col("status") == DEFERRED, F.col("final_kind")))
        .withColumn("_kind_before", F.last("_sets", ignorenulls=True).over(before))
    )

    def closes(drafted: bool, fit: bool) -> Column:
        kind_fits = _fit(F.coalesce("final_kind", "_kind_before"))
        if drafted:
            ends_fit = F.lit(fit)
        else:
            no_kind = F.coalesce("final_kind", "_kind_before").isNull()
            ends_fit = F.when(no_kind, F.lit(fit)).otherwise(kind_fits)
        passes = (F.col("status") == REJECTED) | ((F.col("status") == APPROVED) & ends_fit)
        return F.coalesce(passes, F.lit(False)) & (~edits if drafted else F.lit(True))

    mask = F.lit(0)
    for bit, entry in enumerate(_ENTRIES):
        mask = mask + F.when(closes(*entry), 1 << bit).otherwise(0)
    return rows.withColumn("_closes", mask).withColumn(
        "_shut_before", F.coalesce(F.bit_or("_closes").over(before), F.lit(0))
    )


def judge_decisions(
    proposals: DataFrame, decisions: DataFrame, artifacts: DataFrame, chunk_rows: int = 100_000
) -> DataFrame:
    """Every decision with its ``result``: OK or the first check that failed.

    Checks in order: the status is known; the proposal exists; it is pending or deferred,
    also after the earlier decisions of the batch; no edit once drafts exist; an approval
    ends with a kind that can be built. A deferral may set the kind that a later approval of the
    batch relies on; while a proposal is open, every deferral that passes is accepted.

    A decision is a function from the state of its proposal to the next one, and the state has few
    values: how it was entered (``_ENTRIES``), or closed. Within a chunk these functions are
    composed by running values, so decisions travel once, to (proposal, chunk), and meet a
    proposal's state there. Proposals with over ``chunk_rows`` decisions have several chunks, cut by
    position whatever the numbers are; for them alone each chunk is first reduced to one row,
    and a scan over at most 256 rows says in which state a chunk is entered.
    """
    edges = _chunk_edges(decisions, chunk_rows)
    rows = _transitions(decisions, edges)

    drafted = artifacts.select("proposal_id").distinct().withColumn("_drafted", F.lit(True))
    state = (
        proposals.select(
            "proposal_id",
            F.coalesce(F.col("status"), F.lit("")).alias("_was"),
            F.col("final_object_kind").alias("_kind"),
        )
        .join(drafted, "proposal_id", "left")
        .withColumn("_drafted", F.coalesce("_drafted", F.lit(False)))
    )

    narrow = decisions.select("proposal_id", "decision_seq", "status", "final_name", "final_kind")
    chunks = (
        _transitions(narrow, edges, "inner")
        .groupBy("proposal_id", "_chunk")
        .agg(
            F.max_by("_sets", F.when(F.col("_sets").isNotNull(), F.col("decision_seq"))).alias("_last"),
            F.bit_or("_closes").alias("_mask"),
        )
        .join(state.select("proposal_id", "_kind", "_drafted"), "proposal_id")
    )
    earlier = (
        Window.partitionBy("proposal_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    entered = F.coalesce(
        F.when(~F.col("_drafted"), F.last("_last", ignorenulls=True).over(earlier)), "_kind"
    )
    chunks = chunks.withColumn("_entered", entered)
    chunks = chunks.withColumn("_shuts", _closed(F.col("_mask"))).select(
        "proposal_id",
        "_chunk",
        "_entered",
        F.coalesce(F.max("_shuts").over(earlier), F.lit(False)).alias("_shut"),
    )
    # A row per chunk of the proposals cut above, one row for each of the others.
    start = (
        state.join(chunks.withColumn("_cut", F.lit(True)), "proposal_id", "left")
        .withColumn("_chunk", F.coalesce("_chunk", F.lit(0)))
        .withColumn("_entered", F.when(F.col("_cut"), F.col("_entered")).otherwise(F.col("_kind")))
        .withColumn("_shut", F.coalesce("_shut", F.lit(False)))
        .drop("_cut", "_kind")
    )

    rows = rows.join(start, ["proposal_id", "_chunk"], "left")
    shut_here = _closed(F.col("_shut_before"))
    edits = F.col("final_name").isNotNull() | F.col("final_kind").isNotNull()
    kind = F.coalesce("final_kind", F.when(~F.col("_drafted"), F.col("_kind_before")), "_entered")
    result = (
        F.when(~_known(F.col("status")), BAD_STATUS)
        .when(F.col("_was").isNull(), NOT_FOUND)
        .when(~F.col("_was").isin(PENDING, DEFERRED) | F.col("_shut") | shut_here, CLOSED)
        .when(F.col("_drafted") & edits, DRAFTED)
        .when((F.col("status") == APPROVED) & ~_fit(kind), NOT_ACTIONABLE)
        .otherwise(OK)
    )
    return rows.withColumn("result", result).select(*decisions.columns, "result")


def apply_decisions(proposals: DataFrame, judged: DataFrame) -> DataFrame:
    """The proposals after the accepted decisions of :func:`judge_decisions`.

    The last accepted decision gives status, decider, time and rationale; the last accepted
    edit gives name and kind. Decisions are reduced to one row per proposal first.
    """
    accepted = judged.where(F.col("result") == OK)

    def latest(column: str, only: Column | None = None) -> Column:
        when = F.col("decision_seq")
        return F.max_by(column, when if only is None else F.when(only, when))

    outcome = accepted.groupBy("proposal_id").agg(
        F.max_by(
            F.struct("status", "decided_by", "decided_ts", "rationale"), "decision_seq"
        ).alias("_last"),
        latest("final_name", F.col("final_name").isNotNull()).alias("_name"),
        latest("final_kind", F.col("final_kind").isNotNull()).alias("_new_kind"),
    )
    decided = F.col("_last").isNotNull()
    values = {
        "status": F.when(decided, F.col("_last.status")).otherwise(F.col("status")),
        "decided_by": F.when(decided, F.col("_last.decided_by")).otherwise(F.col("decided_by")),
        "decided_ts": F.when(decided, F.col("_last.decided_ts")).otherwise(F.col("decided_ts")),
        "rationale": F.when(decided, F.col("_last.rationale")).otherwise(F.col("rationale")),
        "final_name": F.coalesce("_name", "final_name"),
        "final_object_kind": F.coalesce("_new_kind", "final_object_kind"),
    }
    return proposals.join(outcome, "proposal_id", "left").withColumns(values).select(
        *proposals.columns
    )


def audit_rows(judged: DataFrame) -> DataFrame:
    """One audit row per accepted decision; the log id is a hash, not a counter."""
    log_id = parts_key("proposal_id", "decision_seq", "decided_ts")
    return judged.where(F.col("result") == OK).select(
        log_id.alias("log_id"), "proposal_id", "status", "decided_by", "decided_ts", "rationale"
    )


def recent_decisions(rows: DataFrame, top: int = 10, tie: str = "proposal_id") -> DataFrame:
    """The latest ``top`` rows by decision time, undecided ones last."""
    return rows.orderBy(F.desc_nulls_last("decided_ts"), tie).limit(top)
