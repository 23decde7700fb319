"""A catalogue of tables and its query log, candidates from it, runners and their jobs, store policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators.elements import filled
from pagemill.runtime import table

# The columns of a catalogue's tables, and the type of a table that has none.
CATALOGUE = {"tables": "table_schema string, table_name string, table_type string", "columns": "table_schema string, table_name string, column_name string, ordinal_position int, data_type string, is_nullable string"}
BASE_TABLE = "base table"
#: Heartbeats a runner may miss, and the seconds between two where it has none of its own.
MISSED, BEAT = 3, 30


def normalised(rows: DataFrame, schema: str) -> DataFrame:
    """Catalogue rows in a fixed schema: missing columns null, others dropped, values cast, 'base table' for a missing type."""
    out = []
    for field in schema.split(","):
        name, kind = field.split()
        c = F.expr(f"try_cast({name} as {kind})") if name in rows.columns else F.lit(None).cast(kind)
        out.append((F.coalesce(c, F.lit(BASE_TABLE)) if name == "table_type" else c).alias(name))
    return rows.select(*out)


def introspect(spark: SparkSession, database: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The tables and columns of the session's catalogue, in the schemas of CATALOGUE."""
    tables, columns = [], []
    for t in spark.catalog.listTables(database):
        schema = (t.namespace or [""])[-1]
        tables.append((schema, t.name, t.tableType.lower() if t.tableType else None))
        where = t.name if t.isTemporary else f"{schema}.{t.name}"
        columns += [(schema, t.name, c.name, i, c.dataType, "YES" if c.nullable else "NO") for i, c in enumerate(spark.catalog.listColumns(where), 1)]
    return spark.createDataFrame(tables, CATALOGUE["tables"]), spark.createDataFrame(columns, CATALOGUE["columns"])


def canonical_sql(c: Column) -> Column:
    """A query without its literals, in lower case and single blanks, with its select list in order."""
    x = F.regexp_replace(F.regexp_replace(c, r"'(?:[^']|'')*'", "?"), r"\b[0-9]+(?:\.[0-9]+)?\b", "?")
    x = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(F.lower(x), r"\s+", " ")), r";$", ""), r" ?([,()=<>]) ?", "$1")
    listed = F.array_join(F.array_sort(F.split(F.regexp_extract(x, r"^select (.*?) from ", 1), ",")), ",")
    return F.when(x.rlike(r"^select [^()]* from "), F.concat(F.lit("select "), listed, F.lit(" from "), F.regexp_extract(x, r"^select .*? from (.*)$", 1))).otherwise(x)


def distinct_queries(log: DataFrame) -> DataFrame:
    """Structurally equal queries of a log (query_text, end_time, count) as one: (query, example, total, by_month)."""
    x = log.where(filled(F.col("query_text"))).withColumn("query", canonical_sql(F.col("query_text"))).withColumn("month", F.date_format("end_time", "yyyy_MM"))
    m = x.groupBy("query", "month").agg(F.sum(F.coalesce("count", F.lit(1))).alias("n"), F.min(F.struct("end_time", "query_text")).alias("first"))
    g = m.groupBy("query").agg(F.sum("n").alias("total"), F.min("first").alias("first"), F.array_sort(F.collect_list(F.struct("month", "n"))).alias("months"))
    month = F.transform("months", lambda s: F.concat(F.lit("count_"), s.month, F.lit("="), s.n.cast("string")))
    return g.select("query", F.col("first.query_text").alias("example"), "total", F.array_join(month, " ").alias("by_month"))


def merged_candidates(found: DataFrame) -> DataFrame:
    """One row an id of relevant-table hits (id, text, name, distance): the longest text, the first name that isn't blank by
    distance, the least distance; a missing distance is the farthest."""
    near = F.struct(F.coalesce("distance", F.lit(float("inf"))), "name")
    g = found.groupBy("id").agg(F.max_by("text", F.struct(F.length("text"), "text")).alias("text"), F.min_by("name", F.when(filled(F.col("name")), near)).alias("name"), F.min("distance").alias("distance"))
    return g.withColumn("place", F.row_number().over(W.orderBy(F.asc_nulls_last("distance"), "id")))


def enriched(candidates: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidates (label, id) with the properties of their node (label, id, name, parent), columns with their table's too."""
    own = nodes.select("label", "id", "name", "parent")
    up = nodes.where("label = 'table'").select(F.col("id").alias("parent"), F.col("name").alias("table_name"))
    return candidates.join(own, ["label", "id"], "left").join(up, "parent", "left").select(*candidates.columns, "name", F.when(F.col("label") == "column", F.col("table_name")).alias("table_name"))


def backfilled(rows: DataFrame, known: DataFrame, names: list[str]) -> DataFrame:
    """Rows with the id that their names have already, else a new one from the names."""
    ids = known.groupBy(*names).agg(F.min("id").alias("_id"))
    return rows.drop("id").join(ids, names, "left").withColumn("id", F.coalesce("_id", F.md5(F.concat_ws("\u0001", *names)))).drop("_id")


def edges_between(edges: DataFrame, reached: DataFrame) -> DataFrame:
    """The distinct edges (a < b) whose ends are both among the reached nodes."""
    e = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return e.join(reached.select(F.col("node").alias("a")), "a", "left_semi").join(reached.select(F.col("node").alias("b")), "b", "left_semi").select("a", "b")


def pending_for(jobs: DataFrame, runner: int) -> DataFrame:
    """The pending jobs a runner may take, in its order: assigned ones first, then the oldest; none while it runs one, and
    none it has rejected. jobs: job_id, status, runner_id, created_at, rejected array<string>."""
    busy = jobs.where((F.col("runner_id") == runner) & (F.col("status") == "running")).limit(1).select(F.lit(1).alias("_b"))
    free = jobs.where("status = 'pending'").where((F.col("runner_id") == runner) | F.col("runner_id").isNull()).where(~F.coalesce(F.array_contains("rejected", str(runner)), F.lit(False)))
    x = free.join(F.broadcast(busy), F.lit(True), "left_anti")  # at most one row
    return x.withColumn("place", F.row_number().over(W.orderBy(F.col("runner_id").isNull(), "created_at", "job_id")))


def claimed(jobs: DataFrame, claims: DataFrame) -> DataFrame:
    """Jobs after claims (job_id, runner_id, at): of the claims of a pending job the first takes it, all others change
    nothing."""
    first = claims.groupBy("job_id").agg(F.min(F.struct("at", "runner_id")).alias("_c"))
    won = F.coalesce((F.col("status") == "pending") & F.col("_c").isNotNull(), F.lit(False))
    j = jobs.join(first, "job_id", "left")
    return j.select(*[F.when(won, F.lit("running") if c == "status" else F.col("_c.runner_id")).otherwise(F.col(c)).alias(c) if c in ("status", "runner_id") else F.col(c) for c in jobs.columns], F.when(won, F.col("_c.at")).alias("started_at"))


def stale(runners: DataFrame, now: Column) -> DataFrame:
    """The runners (online or paused, with a heartbeat) whose last heartbeat is longer ago than the beats they may miss."""
    late = F.unix_timestamp(now) - F.unix_timestamp("last_heartbeat") > F.coalesce(F.when(F.col("heartbeat_interval") > 0, F.col("heartbeat_interval")), F.lit(BEAT)) * MISSED
    return runners.where(F.col("status").isin("online", "paused") & late)


def page_texts(hits: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages of each query's hits once (query_id, doc, page, distance, text), in the order first met, and the number of
    pages without a text by query."""
    once = hits.groupBy("query_id", "doc", "page").agg(F.min("distance").alias("distance"), F.min("rank").alias("rank"))
    x = once.join(pages.groupBy("doc", "page").agg(F.min("text").alias("text")), ["doc", "page"], "left")
    return x.where("text is not null"), x.where("text is null").groupBy("query_id").agg(F.count("*").alias("misses"))


def page_hits(golden: DataFrame, run: DataFrame, ks: tuple[int, ...], whole_files: bool = False) -> DataFrame:
    """(n, hit_k): the share of golden keys (query_id, doc, page) met by the first k of a run (query_id, doc, page, rank); the
    page -1 stands for a whole file; with whole_files any page of the file will do."""
    r = run.select("query_id", "doc", F.col("page").alias("p"), "rank")
    ok = F.lit(True) if whole_files else (F.col("p") == F.col("page")) | (F.col("p") == -1)
    first = golden.join(r, ["query_id", "doc"]).where(ok).groupBy("query_id", "doc", "page").agg(F.min("rank").alias("at"))
    x = golden.join(first.withColumnsRenamed({"query_id": "q", "doc": "d", "page": "g"}), (F.col("query_id") == F.col("q")) & (F.col("doc") == F.col("d")) & F.col("page").eqNullSafe(F.col("g")), "left")
    return x.agg(F.count("*").alias("n"), *[F.round(F.coalesce(F.avg(F.coalesce(F.col("at") <= k, F.lit(False)).cast("int")), F.lit(0.0)), 6).alias(f"hit_{k}") for k in ks])


def bad_vectors(df: DataFrame, dim: int, policy: str = "drop", fill: float = 0.0) -> DataFrame:
    """Rows by what becomes of vectors that are null, of another length, or hold nulls or no numbers: dropped, filled, an
    error."""
    bad = F.coalesce((F.size("embedding") != dim) | F.exists("embedding", lambda v: v.isNull() | F.isnan(v)), F.lit(True))
    if policy == "drop":
        return df.where(~bad)
    if policy == "fill":
        return df.withColumn("embedding", F.when(bad, F.array_repeat(F.lit(fill), dim).cast(df.schema["embedding"].dataType)).otherwise(F.col("embedding")))
    if policy == "error":
        return df.where(F.when(bad, F.raise_error(F.lit("a vector of the wrong length")).cast("boolean")).otherwise(F.lit(True)))
    raise ValueError(f"unknown policy: {policy}")


def _log(s, d) -> DataFrame:
    e = table(s, d, "events").where("user_id is not null")
    q = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("SELECT value,  User_id FROM events WHERE event_type='"), "event_type", F.lit("' and user_id = "), "user_id", F.lit(";"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("select user_id, value from events\nwhere event_type = '"), "event_type", F.lit("' and user_id="), "user_id")).otherwise(F.concat(F.lit("select count(*) from "), "event_type"))
    return e.select(q.alias("query_text"), F.col("ts").cast("timestamp").alias("end_time"), F.expr("event_id % 4").alias("count"))


def query_log_dedup(s, d):
    return distinct_queries(_log(s, d))


def relevant_table_merge(s, d):
    """Files as tables, their registrations as hits."""
    x = table(s, d, "sources").select(F.col("source_id").alias("id"), F.col("source_location").alias("text"), F.col("source_name").alias("name"), F.when(F.col("partition_id") % 3 > 0, F.col("partition_id") / 10.0).alias("distance"))
    return merged_candidates(x.where("id is not null"))


def candidate_enrichment(s, d):
    n, c = table(s, d, "nation"), table(s, d, "customer")
    none = F.lit(None).cast("bigint")
    nodes = n.select(F.lit("table").alias("label"), F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"), none.alias("parent")).union(c.select(F.lit("column"), F.col("c_custkey").cast("bigint"), F.col("c_name"), F.col("c_nationkey").cast("bigint")))
    cand = table(s, d, "orders").select(F.when(F.col("o_orderkey") % 2 == 0, "column").otherwise("table").alias("label"), (F.col("o_custkey") + F.col("o_orderkey") % 3).cast("bigint").alias("id")).distinct()
    return enriched(cand, nodes)


def fk_edges_between_reached(s, d):
    from pagemill.operators import relational as R

    reached = R.expand(R._fk(s, d), s.createDataFrame([("supplier:1",)], "node string"), 3)
    return edges_between(R._fk(s, d), reached)


def id_backfill(s, d):
    src = table(s, d, "sources").where("source_id is not null and source_name is not null")
    known = src.where("partition_id % 2 = 0").select("source_id", "source_name", F.concat(F.lit("k"), F.col("partition_id").cast("string")).alias("id"))
    rows = src.select("source_id", "source_name").distinct()
    return backfilled(rows, known, ["source_id", "source_name"])


def _jobs(s, d) -> DataFrame:
    e = table(s, d, "events")
    status = F.expr("case when event_type in ('view', 'click') then 'pending' when event_type = 'error' then 'failed' else 'done' end")
    return e.select(F.col("event_id").alias("job_id"), status.alias("status"), F.when(F.col("event_id") % 5 > 0, F.expr("int(event_id % 4)")).alias("runner_id"), F.col("ts").cast("timestamp").alias("created_at"), F.when(F.col("event_id") % 7 == 0, F.array(F.lit("1"), F.lit("9"))).alias("rejected"))


def pending_jobs(s, d):
    return pending_for(_jobs(s, d), 1).select("job_id", "runner_id", "place")


def job_claims(s, d):
    """Two runners claim every sixth job, some at the same time."""
    c = _jobs(s, d).where("job_id % 6 = 0")
    claims = c.select("job_id", F.lit(2).alias("runner_id"), F.expr("job_id % 10").alias("at")).union(c.select("job_id", F.lit(3), F.expr("(job_id * 7) % 10")))
    return claimed(_jobs(s, d).drop("rejected", "created_at"), claims)


def stale_runners(s, d):
    e = table(s, d, "events").where("user_id is not null")
    r = e.groupBy("user_id").agg(F.max(F.col("ts").cast("timestamp")).alias("last_heartbeat"))
    r = r.select(F.col("user_id").alias("runner_id"), F.expr("case user_id % 4 when 0 then 'offline' when 1 then 'paused' else 'online' end").alias("status"), "last_heartbeat", F.when(F.col("user_id") % 3 > 0, F.expr("int(user_id % 3 * 6000)")).alias("heartbeat_interval"))
    now = table(s, d, "events").agg(F.max(F.col("ts").cast("timestamp")).alias("now"))
    return stale(r.join(F.broadcast(now)), F.col("now")).select("runner_id", "status")  # one row


def distinct_datasets(s, d):
    return table(s, d, "sources").where("collection_id is not null").select("collection_id").distinct()


def audit_top(s, d):
    """The ten files with most chunks sent, of each type."""
    c = table(s, d, "chunks").groupBy("content_type", "path").agg(F.count("*").alias("n"))
    return c.withColumn("place", F.row_number().over(W.partitionBy("content_type").orderBy(F.desc("n"), "path"))).where("place <= 10")


def catalogue_normalise(s, d):
    x = table(s, d, "sources").select(F.col("collection_id").alias("table_schema"), F.col("source_id").alias("table_name"), F.col("summary").alias("owner"), F.when(F.col("partition_id") % 2 == 0, F.col("source_type")).alias("table_type"))
    return normalised(x, CATALOGUE["tables"]).groupBy("table_schema", "table_type").agg(F.count("*").alias("n"))


def page_hit_rate(s, d):
    c = table(s, d, "chunks").groupBy("chunk_id").agg(F.min("path").alias("path"), F.min("page_number").alias("page"))
    doc = T.path_stem(F.col("path"))
    golden = c.where("chunk_id % 10 = 0").select(F.col("chunk_id").alias("query_id"), doc.alias("doc"), "page")
    run = c.where("chunk_id % 3 = 0").select(F.expr("chunk_id div 10 * 10").alias("query_id"), doc.alias("doc"), F.when(F.col("chunk_id") % 4 == 0, -1).otherwise(F.col("page")).alias("page"), F.expr("chunk_id % 10 + 1").alias("rank"))
    a, b = page_hits(golden, run, (1, 5, 10)), page_hits(golden, run, (1, 5, 10), True)
    return a.withColumn("mode", F.lit("pdf_page")).union(b.withColumn("mode", F.lit("pdf_only")))


def full_page_texts(s, d):
    c = table(s, d, "chunks").groupBy("chunk_id").agg(F.min("path").alias("doc"), F.min("page_number").alias("page"), F.min("text").alias("text"))
    hits = c.select(F.expr("chunk_id div 10").alias("query_id"), "doc", "page", (F.col("chunk_id") % 7).cast("double").alias("distance"), (F.col("chunk_id") % 10 + 1).alias("rank"))
    x, _ = page_texts(hits, c.where("chunk_id % 4 > 0 and trim(text) <> ''"))
    return x.select("query_id", "doc", "page", "distance", "rank", F.md5("text").alias("text_md5"))


QUERIES = {f.__name__: f for f in (query_log_dedup, relevant_table_merge, candidate_enrichment, fk_edges_between_reached, id_backfill, pending_jobs, job_claims, stale_runners, distinct_datasets, audit_top, catalogue_normalise, page_hit_rate, full_page_texts)}

_LOG = "SELECT CASE event_id % 3 WHEN 0 THEN 'select user_id,value from events where event_type=? and user_id=?' WHEN 1 THEN 'select user_id,value from events where event_type=? and user_id=?' ELSE 'select count(*)from ' || event_type END AS query, CASE event_id % 3 WHEN 0 THEN 'SELECT value,  User_id FROM events WHERE event_type=''' || event_type || ''' and user_id = ' || user_id || ';' WHEN 1 THEN 'select user_id, value from events' || chr(10) || 'where event_type = ''' || event_type || ''' and user_id=' || user_id ELSE 'select count(*) from ' || event_type END AS t, ts, event_id % 4 AS n FROM events WHERE user_id IS NOT NULL"
_JOBS = "SELECT event_id AS job_id, CASE WHEN event_type IN ('view', 'click') THEN 'pending' WHEN event_type = 'error' THEN 'failed' ELSE 'done' END AS status, CASE WHEN event_id % 5 > 0 THEN (event_id % 4)::INT END AS runner_id, ts AS created_at, event_id % 7 = 0 AS rejected FROM events"
_NODES = "SELECT 'table' AS label, n_nationkey::BIGINT AS id, n_name AS name, NULL::BIGINT AS parent FROM nation UNION ALL SELECT 'column', c_custkey, c_name, c_nationkey FROM customer"
_FK = "SELECT 'nation:' || n_nationkey AS a, 'region:' || n_regionkey AS b FROM nation UNION SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer UNION SELECT 'supplier:' || s_suppkey, 'nation:' || s_nationkey FROM supplier"
_CH = "SELECT chunk_id, min(path) AS path, min(page_number) AS page, min(text) AS text, regexp_replace(regexp_extract(min(path), '([^/\\\\]*)$', 1), '\\.[^.]*$', '') AS doc FROM chunks GROUP BY 1"
_RATE = lambda mode, ok: f"SELECT '{mode}' AS mode, count(*) AS n, " + ", ".join(f"round(avg(coalesce(a <= {k}, false)::INT), 6) AS hit_{k}" for k in (1, 5, 10)) + f" FROM (SELECT g.chunk_id, min(r.chunk_id % 10 + 1) AS a FROM c g LEFT JOIN c r ON r.chunk_id % 3 = 0 AND r.chunk_id // 10 * 10 = g.chunk_id AND r.doc = g.doc AND ({ok}) WHERE g.chunk_id % 10 = 0 GROUP BY 1)"
SQL = {
    "query_log_dedup": f"SELECT query, arg_min(t, {{'a': ts, 'b': t}}) AS example, sum(n)::BIGINT AS total, any_value(m) AS by_month FROM ({_LOG}) JOIN (SELECT query, string_agg('count_' || month || '=' || n, ' ' ORDER BY month) AS m FROM (SELECT query, strftime(ts, '%Y_%m') AS month, sum(n)::BIGINT AS n FROM ({_LOG}) GROUP BY 1, 2) GROUP BY 1) USING (query) GROUP BY 1",
    "relevant_table_merge": "WITH x AS (SELECT source_id AS id, source_location AS text, source_name AS name, CASE WHEN partition_id % 3 > 0 THEN partition_id / 10.0 END AS distance FROM sources WHERE source_id IS NOT NULL), g AS (SELECT id, arg_max(text, {'n': length(text), 't': text}) AS text, arg_min(name, {'d': coalesce(distance, 'inf'::DOUBLE), 'n': name}) FILTER (coalesce(trim(name, ' '), '') <> '') AS name, min(distance) AS distance FROM x GROUP BY 1) SELECT *, row_number() OVER (ORDER BY distance NULLS LAST, id) AS place FROM g",
    "candidate_enrichment": f"WITH n AS ({_NODES}), c AS (SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN 'column' ELSE 'table' END AS label, o_custkey + o_orderkey % 3 AS id FROM orders) SELECT c.label, c.id, n.name, t.name AS table_name FROM c LEFT JOIN n USING (label, id) LEFT JOIN n t ON t.label = 'table' AND t.id = n.parent AND c.label = 'column'",
    "fk_edges_between_reached": f"WITH RECURSIVE e AS ({_FK}), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, hop) AS (SELECT 'supplier:1', 0 UNION SELECT u.b, hop + 1 FROM r JOIN u ON u.a = node WHERE hop < 3) SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM e WHERE a IN (SELECT node FROM r) AND b IN (SELECT node FROM r)",
    "id_backfill": "WITH s AS (SELECT * FROM sources WHERE source_id IS NOT NULL AND source_name IS NOT NULL), k AS (SELECT source_id, source_name, min('k' || partition_id) AS id FROM s WHERE partition_id % 2 = 0 GROUP BY 1, 2) SELECT source_id, source_name, coalesce(id, md5(source_id || chr(1) || source_name)) AS id FROM (SELECT DISTINCT source_id, source_name FROM s) LEFT JOIN k USING (source_id, source_name)",
    "pending_jobs": f"SELECT job_id, runner_id, row_number() OVER (ORDER BY runner_id IS NULL, created_at, job_id) AS place FROM ({_JOBS}) WHERE status = 'pending' AND (runner_id = 1 OR runner_id IS NULL) AND NOT rejected",
    "job_claims": f"SELECT job_id, CASE WHEN w THEN 'running' ELSE status END AS status, CASE WHEN w THEN CASE WHEN job_id % 10 <= job_id * 7 % 10 THEN 2 ELSE 3 END ELSE runner_id END AS runner_id, CASE WHEN w THEN least(job_id % 10, job_id * 7 % 10) END AS started_at FROM (SELECT *, status = 'pending' AND job_id % 6 = 0 AS w FROM ({_JOBS}))",
    "stale_runners": "SELECT user_id AS runner_id, CASE user_id % 4 WHEN 1 THEN 'paused' ELSE 'online' END AS status FROM (SELECT user_id, max(ts) AS t FROM events WHERE user_id IS NOT NULL GROUP BY 1), (SELECT max(ts) AS now FROM events) WHERE user_id % 4 > 0 AND epoch(date_trunc('second', now)) - epoch(date_trunc('second', t)) > 3 * CASE WHEN user_id % 3 > 0 THEN user_id % 3 * 6000 ELSE 30 END",
    "distinct_datasets": "SELECT DISTINCT collection_id FROM sources WHERE collection_id IS NOT NULL",
    "audit_top": "SELECT * FROM (SELECT content_type, path, n, row_number() OVER (PARTITION BY content_type ORDER BY n DESC, path) AS place FROM (SELECT content_type, path, count(*) AS n FROM chunks GROUP BY 1, 2)) WHERE place <= 10",
    "catalogue_normalise": "SELECT collection_id AS table_schema, coalesce(CASE WHEN partition_id % 2 = 0 THEN source_type END, 'base table') AS table_type, count(*) AS n FROM sources GROUP BY 1, 2",
    "page_hit_rate": f"WITH c AS ({_CH}) {_RATE('pdf_page', 'r.chunk_id % 4 = 0 OR r.page = g.page OR r.page = -1')} UNION ALL {_RATE('pdf_only', 'true')}",
    "full_page_texts": f"WITH c AS ({_CH}), p AS (SELECT path, page, min(text) AS text FROM c WHERE chunk_id % 4 > 0 AND trim(text, ' ') <> '' GROUP BY 1, 2) SELECT q AS query_id, path AS doc, page, distance, rank, md5(text) AS text_md5 FROM (SELECT chunk_id // 10 AS q, path, page, min((chunk_id % 7)::DOUBLE) AS distance, min(chunk_id % 10 + 1) AS rank FROM c GROUP BY 1, 2, 3) JOIN p USING (path, page)",
}
