"""Structured Streaming: windowed aggregates with watermarks, sessions, document states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.runtime import table


def tumbling(events: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """Counts and sums by window and type; the same plan for a table and, with a watermark, for a stream."""
    e = events.withWatermark("ts", late) if late else events
    g = e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    return g.select(F.col("w.start").alias("window_start"), "event_type", "n", F.round("v", 4).alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    g = events.where("user_id is not null").groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start_at"), F.col("w.end").alias("end_at"), "n")


def document_states(events: DataFrame) -> DataFrame:
    """Per document the first terminal state wins, later ones are idempotent: (document_id, state, n_ignored).

    events: (document_id, ts, state) with states pending, processing, completed, failed."""
    end = F.col("state").isin("completed", "failed")
    g = events.groupBy("document_id").agg(F.min(F.when(end, F.struct("ts", "state"))).alias("first"), F.count_if(end).alias("ends"), F.max(F.struct("ts", "state")).alias("last"))
    return g.select("document_id", F.coalesce(F.col("first.state"), F.col("last.state")).alias("state"), F.greatest(F.col("ends") - 1, F.lit(0)).alias("n_ignored"))


def event_windows(s, d):
    return tumbling(table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))


def event_sessions(s, d):
    x = sessions(table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return x.groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.max("n").alias("longest"))


def document_state_machine(s, d):
    state = F.expr("case event_type when 'signup' then 'pending' when 'view' then 'processing' when 'click' then 'processing' when 'purchase' then 'completed' else 'failed' end")
    e = table(s, d, "events").where("user_id is not null").select(F.col("user_id").alias("document_id"), F.struct("ts", "event_id").alias("ts"), state.alias("state"))
    return document_states(e)


QUERIES = {f.__name__: f for f in (event_windows, event_sessions, document_state_machine)}
SQL = {
    "event_windows": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "event_sessions": "SELECT user_id, count(*) AS n_sessions, max(n) AS longest FROM (SELECT user_id, g, count(*) AS n FROM (SELECT user_id, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS f FROM events WHERE user_id IS NOT NULL)) GROUP BY 1, 2) GROUP BY 1",
    "document_state_machine": "WITH e AS (SELECT user_id AS document_id, ts, event_id, CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'processing' WHEN 'click' THEN 'processing' WHEN 'purchase' THEN 'completed' ELSE 'failed' END AS state FROM events WHERE user_id IS NOT NULL) SELECT document_id, coalesce(arg_min(state, {'t': ts, 'i': event_id}) FILTER (state IN ('completed', 'failed')), arg_max(state, {'t': ts, 'i': event_id})) AS state, greatest(count(*) FILTER (state IN ('completed', 'failed')) - 1, 0) AS n_ignored FROM e GROUP BY 1",
}
