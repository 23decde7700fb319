"""State of work items, documents and jobs: leases with fencing, terminal states once, progress, eviction.

One step function decides every transition; a table of events is replayed through it by item, and a stream goes through the
same function with its state kept by Spark, timers returning expired leases to the queue.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.runtime import prepare, table

# Seconds of a lease, deliveries of an item, seconds a finished or silent job is kept, jobs kept at most.
LEASE, DELIVERIES, KEPT, SILENT, MOST = 60.0, 3, 4 * 3600.0, 4 * 3600.0, 200_000

STATE = "status string, attempts int, generation int, expires double, seq bigint"
NEW = ("", 0, 0, 0.0, -1)
EVENT = "item_id bigint, seq bigint, at double, kind string, generation int"
OUTCOME = "item_id bigint, seq bigint, kind string, outcome string, status string, attempts int, generation int"


def step(state: tuple, seq: int, at: float, kind: str, generation: int | None) -> tuple[tuple, str]:
    """The state of an item after an event, and what became of the event.

    Kinds: enqueue, claim, heartbeat, complete, fail, expire. A lease that ran out is given up before the event: its item is
    queued again, or failed after DELIVERIES. An event already seen is 'replayed', one for an item that was never enqueued
    'unknown', one with another generation than the lease's 'stale', one after the end 'idempotent'; none changes anything.
    """
    status, attempts, gen, expires, last = state
    if seq <= last:
        return state, "replayed"
    if not status and kind != "enqueue":
        return (status, attempts, gen, expires, seq), "unknown"
    if status == "leased" and at >= expires:
        status = "failed" if attempts >= DELIVERIES else "queued"
    out = "ok"
    if status in ("completed", "failed"):
        out = "exhausted" if kind == "expire" and state[0] == "leased" else "idempotent"
    elif kind == "enqueue":
        status, out = ("queued", "ok") if not status else (status, "idempotent")
    elif kind == "claim":
        if status == "queued":
            status, attempts, gen, expires = "leased", attempts + 1, gen + 1, at + LEASE
        else:
            out = "busy"
    elif kind != "expire":
        if status != "leased" or generation != gen:
            out = "stale"
        elif kind == "heartbeat":
            expires = at + LEASE
        else:
            status = "completed" if kind == "complete" else "failed"
    return (status, attempts, gen, expires, seq), out


def _fed(key: int, rows: pd.DataFrame, state: tuple) -> tuple[tuple, pd.DataFrame]:
    out = []
    for r in rows.sort_values(["at", "seq"]).itertuples():
        state, what = step(state, int(r.seq), float(r.at), r.kind, None if pd.isna(r.generation) else int(r.generation))
        out.append((key, int(r.seq), r.kind, what, state[0], state[1], state[2]))
    return state, pd.DataFrame(out, columns=[c.split()[0] for c in OUTCOME.split(", ")])


def replayed(events: DataFrame) -> DataFrame:
    """What becomes of each event (EVENT columns; seq rises within an item), by item: OUTCOME columns."""
    prepare(events.sparkSession)

    def of(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return _fed(int(key[0]), pdf, NEW)[1]

    return events.where("item_id is not null").select("item_id", "seq", "at", "kind", "generation").groupBy("item_id").applyInPandas(of, OUTCOME)


def brokered(events: DataFrame) -> DataFrame:
    """replayed for a stream: the state of each item stays between batches, and a timer gives up its lease."""
    prepare(events.sparkSession)

    def of(key, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        state = tuple(held.get) if held.exists else NEW
        if held.hasTimedOut:
            state, what = step(state, state[4] + 1, state[3], "expire", None)
            state = (*state[:4], state[4] - 1)  # the timer's event has no number of its own
            yield pd.DataFrame([(int(key[0]), None, "expire", what, state[0], state[1], state[2])], columns=[c.split()[0] for c in OUTCOME.split(", ")])
        else:
            rows = pd.concat(list(batches))
            state, out = _fed(int(key[0]), rows, state)
            yield out
        held.update(state)
        if state[0] == "leased":
            held.setTimeoutDuration(int(LEASE * 1000))

    return events.select("item_id", "seq", "at", "kind", "generation").groupBy("item_id").applyInPandasWithState(of, OUTCOME, STATE, "append", "ProcessingTimeTimeout")


def claimable(outcomes: DataFrame, n: int) -> DataFrame:
    """The n items to hand out next: those given back first, then the oldest. outcomes: OUTCOME columns."""
    last = outcomes.groupBy("item_id").agg(F.max_by(F.struct("status", "attempts"), "seq").alias("s"), F.min("seq").alias("first"))
    return last.where("s.status = 'queued'").orderBy(F.desc(F.col("s.attempts") > 0), "first", "item_id").limit(n).select("item_id")


def job_states(jobs: DataFrame, documents: DataFrame, progress: int = 10) -> DataFrame:
    """Jobs (job_id, expected) with their documents' ends (job_id, state): counts, whether all have ended, how, and the last
    progress step that was reached. Documents of an unknown job are left out."""
    d = documents.groupBy("job_id").agg(F.count_if(F.col("state") == "completed").alias("n_completed"), F.count_if(F.col("state") == "failed").alias("n_failed"))
    done, bad = F.coalesce("n_completed", F.lit(0)), F.coalesce("n_failed", F.lit(0))
    status = F.when(done + bad < F.col("expected"), "processing").when(bad == 0, "completed").when(done == 0, "failed").otherwise("partial_success")
    return jobs.join(d, "job_id", "left").select("job_id", "expected", done.alias("n_completed"), bad.alias("n_failed"), status.alias("status"), (F.floor((done + bad) / progress) * progress).alias("progress"))


def evicted(jobs: DataFrame, now: Column, most: int = MOST) -> DataFrame:
    """The jobs (job_id, finished_at, seen_at) to forget: finished or silent for too long, then the longest unseen beyond the
    most that are kept."""
    age = lambda c: F.unix_timestamp(now) - F.unix_timestamp(c)
    old = F.coalesce(age("finished_at") > KEPT, F.lit(False)) | (F.col("finished_at").isNull() & F.coalesce(age("seen_at") > SILENT, F.lit(False)))
    gone = jobs.where(old).select("job_id", F.lit("old").alias("why"))
    left = jobs.where(~old)
    stay = left.orderBy(F.desc("seen_at"), "job_id").limit(most).select("job_id")
    return gone.union(left.join(stay, "job_id", "left_anti").select("job_id", F.lit("beyond the most").alias("why")))


def epoch_writer(path: str, name: str = "epoch"):
    """A foreachBatch function that writes each batch to a folder of its epoch: a batch that is replayed takes the place of
    its first writing, so it changes nothing."""

    def of(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{name}={epoch}")

    return of


def job_progress(s, d):
    o = table(s, d, "orders")
    jobs = o.groupBy(F.col("o_custkey").alias("job_id")).agg(F.count("*").alias("expected"))
    docs = o.where("o_orderstatus <> 'O'").select(F.col("o_custkey").alias("job_id"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("state"))
    return job_states(jobs, docs, 5)


def job_eviction(s, d):
    e = table(s, d, "events").where("user_id is not null")
    ts = F.col("ts").cast("timestamp")
    jobs = e.groupBy(F.col("user_id").alias("job_id")).agg(F.max(F.when(F.col("event_type") == "purchase", ts)).alias("finished_at"), F.max(ts).alias("seen_at"))
    now = table(s, d, "events").agg(F.max(ts).alias("now"))
    return evicted(jobs.join(F.broadcast(now)), F.col("now"), 20)  # one row


def lease_outcomes(s, d):
    """Events as deliveries of work items: the first of an item enqueues it, the others claim, beat or complete in turn."""
    e = table(s, d, "events").where("user_id is not null").withColumn("seq", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("bigint"))
    kind = F.when(F.col("seq") == 1, "enqueue").when(F.col("event_type") == "view", "claim").when(F.col("event_type") == "click", "heartbeat").when(F.col("event_type") == "purchase", "complete").otherwise("claim")
    x = replayed(e.select(F.col("user_id").alias("item_id"), "seq", (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000.0).alias("at"), kind.alias("kind"), F.expr("int(event_id % 3)").alias("generation")))
    return x.groupBy("outcome", "status").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (job_progress, job_eviction, lease_outcomes)}
SQL = {
    "job_progress": "SELECT o_custkey AS job_id, count(*) AS expected, count_if(o_orderstatus = 'F') AS n_completed, count_if(o_orderstatus = 'P') AS n_failed, CASE WHEN count_if(o_orderstatus = 'O') > 0 THEN 'processing' WHEN count_if(o_orderstatus = 'P') = 0 THEN 'completed' WHEN count_if(o_orderstatus = 'F') = 0 THEN 'failed' ELSE 'partial_success' END AS status, (floor(count_if(o_orderstatus <> 'O') / 5) * 5)::BIGINT AS progress FROM orders GROUP BY 1",
    "job_eviction": "WITH j AS (SELECT user_id AS job_id, max(ts) FILTER (event_type = 'purchase') AS f, max(ts) AS seen FROM events WHERE user_id IS NOT NULL GROUP BY 1), a AS (SELECT *, epoch(date_trunc('second', (SELECT max(ts) FROM events))) AS now FROM j), o AS (SELECT *, CASE WHEN f IS NOT NULL THEN now - epoch(date_trunc('second', f)) > 14400 ELSE now - epoch(date_trunc('second', seen)) > 14400 END AS old FROM a) SELECT job_id, 'old' AS why FROM o WHERE old UNION ALL SELECT job_id, 'beyond the most' FROM (SELECT job_id, row_number() OVER (ORDER BY seen DESC, job_id) AS n FROM o WHERE NOT old) WHERE n > 20",
}
