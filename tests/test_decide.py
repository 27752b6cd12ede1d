"""Batches of decisions against a plain replay of the rules, one decision at a time."""

import random

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import decide
from weftgraph.plans import star_schema
from weftgraph.session import configure, local_rows

ACTIONABLE = {"ATTRIBUTE", "NODE_TYPE", "EDGE_TYPE"}
DECISION = (
    "proposal_id string, decision_seq long, status string, rationale string, final_name string, "
    "final_kind string, decided_by string, decided_ts long"
)
PROPOSAL = (
    "proposal_id string, status string, final_name string, final_object_kind string, "
    "decided_by string, decided_ts long, rationale string"
)


def replay(proposals, decisions, drafted):
    state = {p[0]: list(p) for p in proposals}
    results = {}
    for pid, seq, status, why, name, kind, who, when in sorted(decisions, key=lambda d: (d[0], d[1])):
        status, kind = status and status.upper(), kind and kind.upper()
        if status not in ("APPROVED", "REJECTED", "DEFERRED"):
            result = decide.BAD_STATUS
        elif pid not in state:
            result = decide.NOT_FOUND
        elif state[pid][1] not in ("PENDING", "DEFERRED"):
            result = decide.CLOSED
        elif pid in drafted and (name or kind):
            result = decide.DRAFTED
        elif status == "APPROVED" and (kind or state[pid][3]) not in ACTIONABLE:
            result = decide.NOT_ACTIONABLE
        else:
            result = decide.OK
            row = state[pid]
            state[pid] = [pid, status, name or row[2], kind or row[3], who, when, why]
        results[pid, seq] = result
    return results, {tuple(r) for r in state.values()}


@pytest.mark.parametrize("seed", range(3))
def test_batches_match_the_replay(spark, seed):
    rng = random.Random(seed)
    kinds = ["ATTRIBUTE", "NODE_TYPE", "EDGE_TYPE", "FLAGGED", None]
    proposals = [
        (f"p{i}", rng.choice(["PENDING", "DEFERRED", "PENDING", "APPROVED", None]), "n", rng.choice(kinds), None, None, None)
        for i in range(60)
    ]
    drafted = {f"p{i}" for i in range(0, 60, 7)}
    statuses = ["deferred", "DEFERRED", "Deferred", "approved", "rejected", "odd", None]
    decisions = [
        (f"p{i}", seq, rng.choice(statuses), f"w{seq}", rng.choice([None, f"n{seq}"]),
         rng.choice(["flagged", None, None, "edge_type"]), "me", seq)
        for i in range(64)
        for seq in rng.sample(range(1, 400_000, 17), rng.randint(0, 9))
    ]
    frames = (
        local_rows(spark, proposals, PROPOSAL),
        local_rows(spark, decisions, DECISION),
        local_rows(spark, [(p,) for p in drafted] * 2, "proposal_id string"),
    )
    judged = decide.judge_decisions(*frames)
    results, state = replay(proposals, decisions, drafted)
    rows = judged.collect()
    assert {(r.proposal_id, r.decision_seq): r.result for r in rows} == results
    assert len(rows) == len(decisions)
    applied = decide.apply_decisions(frames[0], judged)
    assert {tuple(r) for r in applied.collect()} == state
    assert decide.audit_rows(judged).count() == list(results.values()).count("OK")


@pytest.mark.parametrize("chunk_rows", [1, 40, 100_000])
def test_a_hot_proposal_with_sparse_numbers(spark, chunk_rows):
    """Half of all decisions on a few proposals, numbered by microseconds; null ids; cut anywhere."""
    rng = random.Random(chunk_rows)
    proposals = [
        (f"p{i}", rng.choice(["PENDING", "DEFERRED"]), "n", rng.choice(["FLAGGED", None, "ATTRIBUTE"]), None, None, None)
        for i in range(24)
    ]
    drafted = {"p1", "p3", "p5", "p7"}
    decisions = []
    for i in range(26):
        # Mostly deferrals and approvals that fail, so that proposals stay open for long.
        calm = ["deferred"] * 30 + ["odd", None, "approved"] + (["rejected"] if i % 3 == 0 else [])
        seqs = rng.sample(range(1_700_000_000_000_000, 1_800_000_000_000_000), 300 if i < 8 else 5)
        decisions += [
            (f"p{i}", seq, rng.choice(calm), "w", rng.choice([None, None, "m"]),
             rng.choice(["flagged"] * 9 + [None] * 20 + ["edge_type"]), "me", seq)
            for seq in seqs
        ]
    frames = (
        local_rows(spark, proposals, PROPOSAL),
        local_rows(spark, decisions + [(None, 1, "approved", None, None, None, None, 1), (None, None, "odd", None, None, None, None, 1)], DECISION),
        local_rows(spark, [(p,) for p in drafted], "proposal_id string"),
    )
    results, _ = replay(proposals, decisions, drafted)
    rows = decide.judge_decisions(*frames, chunk_rows=chunk_rows).collect()
    assert {(r.proposal_id, r.decision_seq): r.result for r in rows if r.proposal_id} == results
    assert len(rows) == len(decisions) + 2
    assert sorted(r.result for r in rows if not r.proposal_id) == [decide.NOT_FOUND, decide.BAD_STATUS]
    assert len(set(results.values())) == 6


def test_recent_decisions_put_undecided_last(spark):
    rows = local_rows(spark, [("a", None), ("b", 2), ("c", 5)], "proposal_id string, decided_ts long")
    assert [r.proposal_id for r in decide.recent_decisions(rows).collect()] == ["c", "b", "a"]
    assert [r.proposal_id for r in decide.recent_decisions(rows, top=1).collect()] == ["c"]
    assert rows.where(F.col("decided_ts").isNull()).count() == 1


@pytest.mark.parametrize("query", ["judge_decisions", "apply_decisions", "decision_audit"])
def test_partitions_follow_the_size_of_the_decisions(spark, query):
    """More partitions than the session names, if the rows ask for them; other queries keep the session's number."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
    }
    before = {k: spark.conf.get(k, None) for k in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        rows = star_schema.queries()[query](spark, "/root/testdata/sf0.001")
        used = rows.select(F.spark_partition_id().alias("p"), F.xxhash64(*rows.columns)).collect()
        assert len({r.p for r in used}) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
        configure(spark)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
