import json

import pandas as pd
from pyspark.sql import functions as F

from weftgraph.operators import review
from weftgraph.session import local_rows

CANDIDATE = (
    "candidate_id string, run_id string, table_schema string, table_name string, "
    "column_name string, object_kind string, rule_applied string, proposed_name string, "
    "edge_from string, edge_to string, raw_details string"
)
CHANGE = "run_id string, table_schema string, table_name string, column_name string, detected_ts timestamp_ntz"
COMMENT = "table_schema string, table_name string, column_name string, comment string"


def candidates(spark, rows):
    full = [(i, "r", "s", t, c, k, "RULE", n, None, e, None) for i, t, c, k, n, e in rows]
    return review.as_candidates(local_rows(spark, full, CANDIDATE))


def answer(**changed):
    good = {"agrees_with_rule": True, "recommended_object_kind": "NODE_TYPE", "confidence": 0.9,
            "rationale": "why", "industry_note": ""}
    good.update(changed)
    return json.dumps({k: v for k, v in good.items() if v is not None})


def test_bad_answers_are_kept_apart(spark):
    texts = {
        "good": answer(), "kind": answer(recommended_object_kind="THING"), "high": answer(confidence=1.5),
        "low": answer(confidence=-0.1), "part": answer(rationale=None), "text": "no json", "cut": answer()[:30],
        "none": None,
    }
    rows = local_rows(spark, list(texts.items()), "candidate_id string, response string")
    parsed = review.parse_responses(rows)
    assert [r.candidate_id for r in parsed.where("is_valid").collect()] == ["good"]
    rejected = {r.candidate_id: r.response for r in review.rejected_responses(parsed).collect()}
    assert rejected == {k: v for k, v in texts.items() if k != "good"}


def test_write_back_keeps_opinions_and_takes_one_answer(spark):
    rows = candidates(spark, [("a", "T", None, "FLAGGED", "T", None), ("b", "U", None, "FLAGGED", "U", None)])
    answers = [("a", answer(confidence=0.9)), ("a", answer(confidence=0.3)), ("x", answer())]
    frame = local_rows(spark, answers, "candidate_id string, response string")
    done = review.write_back(rows, review.parse_responses(frame))
    got = {r.candidate_id: r.ai_confidence for r in done.collect()}
    assert got == {"a": 0.3, "b": None}
    again = local_rows(spark, [("a", answer(confidence=0.7))], "candidate_id string, response string")
    kept = review.write_back(done, review.parse_responses(again))
    assert {r.candidate_id: r.ai_confidence for r in kept.collect()} == got
    # What has an opinion is not asked about again.
    comments = local_rows(spark, [], COMMENT)
    assert [r.candidate_id for r in review.build_prompts(done, comments).collect()] == ["b"]


def test_prompts_take_comments_and_scorers_run_in_batches(spark):
    rows = candidates(spark, [("a", "T", "C", "ATTRIBUTE", "c", None), ("b", "U", None, "FLAGGED", "U", "X")])
    comments = local_rows(
        spark, [("s", "T", None, "about T"), ("s", "T", "C", "about C"), ("s", "U", "D", "other")], COMMENT
    )
    prompts = review.build_prompts(rows, comments, "books")
    text = {r.candidate_id: r.prompt for r in prompts.collect()}
    assert "Table comment: about T" in text["a"] and "Column comment: about C" in text["a"]
    assert "Table comment: none" in text["b"] and "To: X" in text["b"]

    def scorer(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: json.dumps({"n": len(t)}))

    scored = {r.candidate_id: json.loads(r.response)["n"] for r in review.score_prompts(prompts, scorer).collect()}
    assert scored == {k: len(v) for k, v in text.items()}


def test_evidence(spark):
    rows = candidates(spark, [(i, "T", c, "EDGE_TYPE", "n", "X") for i, c in
                              (("a", "C"), ("b", "C"), ("c", "C"), ("d", None))])
    number = F.col("candidate_id")
    rows = rows.withColumn("inclusion", F.when(number == "a", 1.0).when(number == "b", 0.6).when(number == "c", 0.1))
    rows = rows.withColumn("uniqueness", F.lit(1.0))
    parsed = review.parse_responses(review.evidence_responses(rows))
    got = {r.candidate_id: (r.ai_recommended_kind, r.band) for r in
           parsed.withColumn("band", review.confidence_band(F.col("ai_confidence"))).collect()}
    assert got == {"a": ("EDGE_TYPE", "EXPLICIT"), "b": ("EDGE_TYPE", "INFERRED"),
                   "c": ("ATTRIBUTE", "SPECULATIVE"), "d": ("EDGE_TYPE", "EXPLICIT")}


def test_batch_is_deduplicated_and_targets_can_be_told_apart(spark):
    rows = candidates(spark, [("a", "T", "C", "EDGE_TYPE", "n", "X"), ("b", "T", "C", "EDGE_TYPE", "n", "Y"),
                              ("c", "T", None, "FLAGGED", "n", None)])
    changes = local_rows(spark, [("r", "s", "T", "C"), ("r", "s", "T", None), ("r", "s", "T", "C")],
                         CHANGE.rsplit(",", 1)[0]).withColumn("detected_ts", F.localtimestamp())
    none = local_rows(spark, [], "fingerprint_key string, status string")
    assert review.new_proposals(rows, changes, none).count() == 2
    apart = review.new_proposals(rows, changes, none, with_target=True)
    assert sorted(r.edge_to or "" for r in apart.collect()) == ["", "X", "Y"]


def test_queue_order_and_deferred(spark):
    rows = candidates(spark, [(str(i), f"T{i}", None, "FLAGGED", f"n{i}", None) for i in range(3)])
    changes = rows.select(
        "run_id", "table_schema", "table_name", "column_name",
        (F.lit("2024-01-04").cast("timestamp_ntz") - F.make_dt_interval(days=F.col("candidate_id").cast("int"))).alias("detected_ts"),
    )
    proposals = review.to_proposals(rows, changes)
    queue = review.pending_queue(proposals)
    assert [r.table_name for r in queue.collect()] == ["T2", "T1", "T0"]
    late = proposals.withColumn("status", F.when(F.col("final_name") == "n1", "DEFERRED").otherwise(F.col("status")))
    assert review.pending_queue(late).count() == 2
    assert review.pending_queue(late, include_deferred=True).count() == 3


def test_a_worker_keeps_no_batches_that_are_done(spark):
    """40 batches of 10 MB through one worker: its memory stays that of a few."""

    def resident(prompts):
        with open("/proc/self/status") as status:
            mb = next(int(line.split()[1]) >> 10 for line in status if line.startswith("VmRSS"))
        return [str(mb)] * len(prompts)

    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "100")
    try:
        prompts = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat(cast(id % 10 AS string), 100000) AS prompt")
        rows = review.score_prompts(prompts, resident, "id").collect()
    finally:
        spark.conf.set(size, before)
    mb = {r.id: int(r.response) for r in rows}
    assert len(mb) == 4000 and mb[3999] - mb[0] < 120
