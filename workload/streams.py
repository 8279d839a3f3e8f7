"""Queries: streams over the events table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from driftloom.operators import drift, scoring
from driftloom.session import durable_dir
from driftloom.sources.streams import file_stream
from driftloom.specs import FieldRule
from driftloom.streaming import buffers, sinks, windows
from workload.registry import load, query, r6

EVENT_RULES = (
    FieldRule("event_id", required=True),
    FieldRule("event_type", required=True, allowed=("click", "purchase", "signup", "view"), case="lower"),
    FieldRule("value", required=True, low=0.0, high=200.0),
)


def _folder(spark, name):
    return f"{durable_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _arriving(spark, sf, parts=3, twice=False):
    """The events table as files that arrive one after the other, in the order of their ids."""
    events = load(spark, sf, "events")
    folder = _folder(spark, "arriving")
    top = events.agg(F.max("event_id")).first()[0] + 1
    for i in range(parts):
        part = events.where((F.col("event_id") >= top * i // parts) & (F.col("event_id") < top * (i + 1) // parts))
        part.write.mode("append").parquet(folder)
    if twice:
        events.where(F.col("event_id") >= top * (parts - 1) // parts).write.mode("append").parquet(folder)
    return file_stream(spark, folder, events.schema, files_per_trigger=1)


def _probability():
    return F.col("value") / (F.col("value") + 20)


def _score(valid):
    return scoring.decide(valid.withColumn("p", _probability()), "event_id", "p", 0.39)


CHECKED_SQL = """
checked AS (SELECT event_id, value / (value + 20) AS p,
  concat_ws(',', CASE WHEN event_type NOT IN ('click','purchase','signup','view') THEN 'event_type:enum' END,
                 CASE WHEN NOT value BETWEEN 0 AND 200 THEN 'value:range' END) AS violations FROM events)
"""


@query(
    f"""WITH {CHECKED_SQL} SELECT event_id AS id, CAST(p >= 0.39 AS INTEGER) AS prediction, round(p, 4) AS probability,
    CASE WHEN p >= 0.39 THEN 'Survived' ELSE 'Did Not Survive' END AS status,
    CASE WHEN p >= 0.7 THEN 'High' WHEN p >= 0.4 THEN 'Moderate' ELSE 'Low' END AS risk_level
    FROM checked WHERE violations = ''"""
)
def stream_score(spark, sf):
    out, rejects = _folder(spark, "predictions"), _folder(spark, "rejects")
    sink = sinks.scoring_sink(_score, out, rejects, EVENT_RULES)
    sinks.run_to_end(_arriving(spark, sf), sink, _folder(spark, "state"))
    return sinks.read_batches(spark, out).drop("batch_id")


@query(f"WITH {CHECKED_SQL} SELECT event_id, violations FROM checked WHERE violations <> ''")
def stream_quarantine(spark, sf):
    out, rejects = _folder(spark, "predictions"), _folder(spark, "rejects")
    sink = sinks.scoring_sink(_score, out, rejects, EVENT_RULES)
    sinks.run_to_end(_arriving(spark, sf), sink, _folder(spark, "state"))
    return sinks.read_batches(spark, rejects).select("event_id", F.array_join("violations", ",").alias("violations"))


@query(
    """SELECT count(*) AS total_inferences, CAST(sum(CAST(value / (value + 20) >= 0.39 AS INTEGER)) AS BIGINT) AS positives
    FROM events"""
)
def stream_totals(spark, sf):
    out = _folder(spark, "totals")
    scored = _arriving(spark, sf).select((_probability() >= 0.39).cast("int").alias("prediction"))
    sinks.run_to_end(sinks.totals(scored), sinks.table_sink(out), _folder(spark, "state"), "complete")
    batches = sinks.read_batches(spark, out)
    return batches.groupBy().agg(F.max("total_inferences").alias("total_inferences"), F.max("positives").alias("positives"))


@query(
    """WITH r AS (SELECT event_type, value / (value + 20) AS p, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS k
      FROM events)
    SELECT event_type, count(*) AS buffer_size, round(avg(p), 6) AS average_probability,
    round(avg(CAST(p >= 0.39 AS INTEGER)), 6) AS positive_rate FROM r WHERE k <= 200 GROUP BY event_type"""
)
def stream_last_n(spark, sf):
    out = _folder(spark, "segments")
    p = _probability()
    scored = _arriving(spark, sf).select("event_type", "event_id", p.alias("probability"), (p >= 0.39).cast("int").alias("prediction"))
    updates = buffers.last_n_by_segment(scored, "event_type", "event_id", 200)
    sinks.run_to_end(updates, sinks.table_sink(out), _folder(spark, "state"), "update")
    latest = F.max_by(F.struct("buffer_size", "average_probability", "positive_rate"), "batch_id").alias("s")
    return r6(sinks.read_batches(spark, out).groupBy("event_type").agg(latest).select("event_type", "s.*"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_dedup(spark, sf):
    out = _folder(spark, "unique")
    replayed = windows.event_time(_arriving(spark, sf, twice=True), "ts", "40 days")
    unique = windows.drop_replays(replayed, ["event_id"]).select("event_id", "user_id", "event_type", "value")
    sinks.run_to_end(unique, sinks.table_sink(out), _folder(spark, "state"))
    return sinks.read_batches(spark, out).drop("batch_id")


def _psi_sql(windows_sql: str, start: str, end: str, closed: str = "") -> str:
    return f"""WITH q AS (SELECT list_sort(list_distinct(quantile_cont(value, [0,.1,.2,.3,.4,.5,.6,.7,.8,.9,1]))) AS e FROM events),
    binned AS (SELECT ts, value, len([x FOR x IN e[2:-2] IF x <= value]) AS bin, len(e) - 1 AS k FROM events, q),
    base AS (SELECT bin, count(*) AS r FROM binned GROUP BY bin),
    wins AS ({windows_sql}),
    per AS (SELECT s, bin, count(*) AS c, any_value(k) AS k FROM wins GROUP BY s, bin),
    sizes AS (SELECT s, CAST(sum(c) AS BIGINT) AS n, any_value(k) AS k FROM per GROUP BY s),
    cells AS (SELECT sizes.s, sizes.n, (base.r / (SELECT count(*) FROM events) + 1e-4) / (1 + sizes.k * 1e-4) AS r,
        (coalesce(per.c, 0) / sizes.n + 1e-4) / (1 + sizes.k * 1e-4) AS q
      FROM sizes CROSS JOIN base LEFT JOIN per ON per.s = sizes.s AND per.bin = base.bin)
    SELECT CAST({start} AS VARCHAR) AS window_start, n,
      round(CASE WHEN n >= 10 THEN least(greatest(sum((q - r) * ln(q / r)), 0), 10) ELSE 0 END, 6) AS psi
    FROM cells {closed} GROUP BY s, n"""


def _psi_out(df):
    return r6(df.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "psi"))


TUMBLING = _psi_sql("SELECT date_trunc('day', ts) AS s, bin, k FROM binned", "s", "s + INTERVAL 1 DAY")


@query(TUMBLING)
def window_psi(spark, sf):
    events = windows.event_time(load(spark, sf, "events"), "ts")
    baseline = drift.psi_baseline(events, "value")
    return _psi_out(windows.window_psi(events, "ts", "value", baseline, F.window("ts", "1 day")))


@query(
    _psi_sql(
        "SELECT date_trunc('day', ts) - d * INTERVAL 1 DAY AS s, bin, k FROM binned, (VALUES (0), (1)) AS v(d)",
        "s",
        "s + INTERVAL 2 DAY",
    )
)
def sliding_psi(spark, sf):
    events = windows.event_time(load(spark, sf, "events"), "ts")
    baseline = drift.psi_baseline(events, "value")
    return _psi_out(windows.window_psi(events, "ts", "value", baseline, F.window("ts", "2 days", "1 day")))


SESSIONS = """WITH q AS (SELECT list_sort(list_distinct(quantile_cont(value, [0,.1,.2,.3,.4,.5,.6,.7,.8,.9,1]))) AS e FROM events),
    binned AS (SELECT user_id, ts, len([x FOR x IN e[2:-2] IF x <= value]) AS bin, len(e) - 1 AS k FROM events, q),
    base AS (SELECT bin, count(*) AS r FROM binned GROUP BY bin),
    g AS (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR
        OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS fresh FROM binned),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM g),
    per AS (SELECT user_id, session, bin, count(*) AS c FROM s GROUP BY ALL),
    sizes AS (SELECT user_id, session, min(ts) AS began, count(*) AS n, any_value(k) AS k FROM s GROUP BY ALL),
    cells AS (SELECT z.*, (base.r / (SELECT count(*) FROM events) + 1e-4) / (1 + k * 1e-4) AS r,
        (coalesce(per.c, 0) / n + 1e-4) / (1 + k * 1e-4) AS q
      FROM sizes z CROSS JOIN base LEFT JOIN per ON per.user_id = z.user_id AND per.session = z.session AND per.bin = base.bin)
    SELECT user_id, strftime(began, '%Y-%m-%d %H:%M:%S') AS window_start, n,
      round(CASE WHEN n >= 10 THEN least(greatest(sum((q - r) * ln(q / r)), 0), 10) ELSE 0 END, 6) AS psi
    FROM cells GROUP BY user_id, session, began, n"""


@query(SESSIONS)
def session_psi(spark, sf):
    events = windows.event_time(load(spark, sf, "events"), "ts")
    baseline = drift.psi_baseline(events, "value")
    sessions = windows.window_psi(events, "ts", "value", baseline, F.session_window("ts", "6 hours"), ["user_id"])
    return r6(sessions.select("user_id", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "psi"))


@query(
    _psi_sql(
        "SELECT date_trunc('day', ts) AS s, bin, k FROM binned",
        "s",
        "s + INTERVAL 1 DAY",
        "WHERE s + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR",
    )
)
def stream_window_psi(spark, sf):
    out = _folder(spark, "windows")
    baseline = drift.psi_baseline(load(spark, sf, "events"), "value")
    arriving = windows.event_time(_arriving(spark, sf), "ts", "2 hours")
    per_day = windows.window_psi(arriving, "ts", "value", baseline, F.window("ts", "1 day"))
    sinks.run_to_end(per_day, sinks.table_sink(out), _folder(spark, "state"))
    return _psi_out(sinks.read_batches(spark, out))


@query()
def stream_data_drift(spark, sf):
    out = _folder(spark, "reports")
    reference = load(spark, sf, "events").select("value", "event_type", "user_id")
    sink = sinks.data_drift_sink(reference, out)
    sinks.run_to_end(_arriving(spark, sf, parts=2), sink, _folder(spark, "state"))
    return sinks.read_batches(spark, out)


@query()
def stream_prediction_drift(spark, sf):
    held, out = _folder(spark, "buffers"), _folder(spark, "statuses")
    p = _probability()

    def score(df):
        return df.select("event_id", p.alias("probability"), (p >= 0.39).cast("int").alias("prediction"))

    sink = sinks.prediction_drift_sink(score(load(spark, sf, "events")), score, held, out, ["event_id"])
    sinks.run_to_end(_arriving(spark, sf, parts=2), sink, _folder(spark, "state"))
    return sinks.read_batches(spark, out)
