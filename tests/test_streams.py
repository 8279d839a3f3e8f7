import pytest
from driftloom.operators import drift
from driftloom.sources.streams import file_stream
from driftloom.specs import FieldRule
from driftloom.streaming import buffers, sinks, windows
from pyspark.sql import functions as F

SCHEMA = "id long, ts timestamp, seg string, probability double, prediction int"


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def row(i, minute, seg="a", p=None):
    p = (i % 10) / 10 if p is None else p
    return (i, __import__("datetime").datetime(2024, 1, 1, minute // 60, minute % 60), seg, p, int(p >= 0.5))


@pytest.fixture
def arriving(spark, tmp_path):
    folder = str(tmp_path / "in")
    for at in range(0, 300, 100):
        write(spark, folder, [row(i, i) for i in range(at, at + 100)])
    return lambda: file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    rules = (FieldRule("id", required=True), FieldRule("probability", low=0.0, high=0.8))
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    sink = sinks.scoring_sink(lambda df: df.select("id", "probability"), out, bad, rules)
    batch = spark.createDataFrame([row(i, i) for i in range(100)], SCHEMA)
    for _ in range(2):
        sink(batch, 0)
    sink(batch.limit(0), 1)
    assert sinks.read_batches(spark, out).count() == 90 and sinks.read_batches(spark, bad).count() == 10


def test_restarted_stream_does_not_score_twice(spark, arriving, tmp_path):
    out, bad, state = (str(tmp_path / n) for n in ("out", "bad", "state"))
    sink = sinks.scoring_sink(lambda df: df.select("id"), out, bad, (FieldRule("id", required=True),))
    for _ in range(2):
        sinks.run_to_end(arriving(), sink, state)
    assert sinks.read_batches(spark, out).count() == 300


def test_last_n_state_follows_a_hot_segment(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [row(i, 0, "hot" if i % 3 else "cold", i / 300) for i in range(300)]
    for at in range(0, 300, 100):
        write(spark, folder, rows[at : at + 100])
    stream = file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    sinks.run_to_end(buffers.last_n_by_segment(stream, "seg", "id", 30), sinks.table_sink(out), str(tmp_path / "state"), "update")
    got = sinks.read_batches(spark, out).groupBy("seg").agg(F.max_by(F.struct("buffer_size", "average_probability"), "batch_id").alias("s"))
    for r in got.collect():
        mine = [p for _, _, seg, p, _ in rows if seg == r["seg"]][-30:]
        assert r["s"]["buffer_size"] == 30 and r["s"]["average_probability"] == pytest.approx(sum(mine) / 30)


def test_buffer_sink_compares_the_last_rows_with_the_baseline(spark, arriving, tmp_path):
    held, out = str(tmp_path / "held"), str(tmp_path / "status")
    baseline = spark.createDataFrame([row(i, 0, p=(i % 5) / 10) for i in range(50)], SCHEMA)
    sink = sinks.prediction_drift_sink(baseline, lambda df: df, held, out, ["id"], n=150)
    sinks.run_to_end(arriving(), sink, str(tmp_path / "state"))
    rows = sinks.read_batches(spark, out).orderBy("batch_id").collect()
    assert [r["sample_size"] for r in rows] == [100, 150, 150] and rows[-1]["overall_status"] == "CRITICAL_DRIFT"
    assert spark.read.parquet(f"{held}/batch_id=2").agg(F.min("id")).first()[0] == 150


def test_late_rows_are_left_out_of_closed_windows(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, folder, [row(i, i) for i in range(0, 60)])
    write(spark, folder, [row(i, i) for i in range(120, 200)])
    write(spark, folder, [row(i, i) for i in range(200, 210)])  # late is judged by the watermark of the batch before
    write(spark, folder, [row(i, i - 1000) for i in range(1000, 1030)])
    write(spark, folder, [row(2000, 900)])
    base = drift.Baseline((0.25, 0.5, 0.75), (25, 25, 25, 25))
    stream = windows.event_time(file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1), "ts", "10 minutes")
    per_hour = windows.window_psi(stream, "ts", "probability", base, F.window("ts", "1 hour"))
    sinks.run_to_end(per_hour, sinks.table_sink(out), str(tmp_path / "state"))
    got = {r["window_start"].hour: r["n"] for r in sinks.read_batches(spark, out).collect()}
    assert got == {0: 60, 2: 60, 3: 30}


def test_session_windows_in_a_stream(spark, arriving, tmp_path):
    out = str(tmp_path / "out")
    base = drift.Baseline((0.5,), (50, 50))
    stream = windows.event_time(arriving(), "ts", "1 minute")
    sessions = windows.window_psi(stream, "ts", "probability", base, F.session_window("ts", "5 minutes"), ["seg"])
    sinks.run_to_end(sessions, sinks.table_sink(out), str(tmp_path / "state"))
    assert sinks.read_batches(spark, out).count() == 0  # the one session is still open


def test_totals_and_replays(spark, arriving, tmp_path):
    out = str(tmp_path / "out")
    sinks.run_to_end(sinks.totals(arriving()), sinks.table_sink(out), str(tmp_path / "state"), "complete")
    assert sinks.read_batches(spark, out).agg(F.max("total_inferences")).first()[0] == 300
    twice = spark.createDataFrame([row(1, 1), row(1, 1), row(2, 2)], SCHEMA)
    assert windows.drop_replays(twice, ["id"]).count() == 2


def test_a_batch_leaves_nothing_in_the_durable_folder(spark, tmp_path):
    from pathlib import Path

    from driftloom.session import durable_dir

    rows = [(float(i % 31), "ab"[i % 2], i) for i in range(400)]
    table = spark.createDataFrame(rows, "value double, kind string, n int")
    sink = sinks.data_drift_sink(table, str(tmp_path / "reports"))
    folder = Path(durable_dir(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    sink(table.limit(90), 0)
    assert {p.name for p in folder.iterdir()} == before
    assert sinks.read_batches(spark, str(tmp_path / "reports")).count() == 3
