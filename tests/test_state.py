from pyspark.sql import functions as F

from weftgraph.session import cut_lineage, local_rows, shared_dir
from weftgraph.sources import versions
from weftgraph.streaming.first_seen import first_seen, known_keys, track_first_seen

EVENT = "ts timestamp, kind string, key string"


def events(spark, rows):
    return local_rows(spark, rows, "at string, kind string, key string").select(
        F.col("at").cast("timestamp").alias("ts"), "kind", "key"
    )


def test_versions_are_published_after_the_data(spark, tmp_path):
    base = str(tmp_path / "state")
    assert versions.latest_version(spark, base) == 0
    df = local_rows(spark, [("A", 1), ("B", 2)], "node_type string, n long")
    assert versions.write_version(df, base, ["node_type"]) == 1
    # A run that died: data without a manifest row.
    df.write.parquet(f"{base}/data/v000002-dead")
    assert versions.write_version(versions.read_version(spark, base).where("n = 2"), base) == 2
    assert versions.read_version(spark, base).count() == 1
    assert versions.read_version(spark, base, 1).count() == 2


def test_lineage_is_cut_in_the_shared_folder(spark):
    kept = cut_lineage(local_rows(spark, [(1,)], "n long"))
    assert shared_dir(spark).removeprefix("file:") in kept.inputFiles()[0]


def test_first_sightings_across_runs_and_a_repeated_batch(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(source)
        track_first_seen(stream, ["kind", "key"], "ts", out, state).awaitTermination()
        return {(r.kind, r.key): str(r.first_seen) for r in spark.read.parquet(out).collect()}

    events(spark, [("2024-01-02", "a", "x"), ("2024-01-01", "a", "x"), ("2024-01-03", "b", "x")]).coalesce(1).write.mode("append").parquet(source)
    assert run() == {("a", "x"): "2024-01-01 00:00:00", ("b", "x"): "2024-01-03 00:00:00"}
    events(spark, [("2024-01-05", "a", "x"), ("2024-01-06", "a", "y")]).coalesce(1).write.mode("append").parquet(source)
    second = run()
    assert len(second) == 3 and second["a", "x"] == "2024-01-01 00:00:00"
    assert run() == second
    assert known_keys(spark, out, 1).count() == 2
    assert known_keys(spark, str(tmp_path / "nothing"), 5) is None
    assert spark.read.parquet(out).groupBy("kind", "key").count().where("count > 1").count() == 0


def test_known_keys_are_compacted(spark, tmp_path):
    """A batch reads the latest table and the few batches after it, and forgets old keys if asked."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for day in range(1, 8):
        events(spark, [(f"2024-01-0{day}", "a", "x"), (f"2024-01-0{day}", "b", str(day))]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(source)
    track_first_seen(stream, ["kind", "key"], "ts", out, state, 2, "3 days").awaitTermination()
    rows = spark.read.parquet(out).groupBy("kind", "key").count().collect()
    # Key (a, x) of day 1 is dropped from the table of batch 4 (day 5) and is new again once.
    assert {(r.kind, r.key): r["count"] for r in rows} == {("a", "x"): 2, **{("b", str(d)): 1 for d in range(1, 8)}}
    read = {f.split("/out")[1].rsplit("/", 1)[0] for f in known_keys(spark, out, 6, 2).inputFiles()}
    assert read == {".known/4", "/batch=5"}
    assert known_keys(spark, out, 7, 2).where("key = '1'").count() == 0


def test_first_seen_drops_repeats(spark, tmp_path):
    source = str(tmp_path / "in")
    events(spark, [("2024-01-01", "a", "x"), ("2024-01-01", "a", "x"), ("2024-01-01", "b", "x")]).write.parquet(source)
    for number, delay in enumerate((None, "1 hour")):
        stream = spark.readStream.schema(EVENT).parquet(source)
        out = str(tmp_path / f"out{number}")
        first_seen(stream, ["kind", "key"], "ts", delay).writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / f"state{number}")
        ).trigger(availableNow=True).start(out).awaitTermination()
        assert spark.read.parquet(out).count() == 2
