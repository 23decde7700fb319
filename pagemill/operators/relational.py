"""Relational steps around a document store: enrichment, merges, diffs, de-duplication, graph expansion, history queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.runtime import table


def first_match(left: DataFrame, right: DataFrame, keys: list[Column], key: Column, order: list, values: list[str]) -> DataFrame:
    """Left join with the first row of `right` by key; the keys of `left` are tried in turn. Rows without a match stay."""
    r = right.withColumn("_k", key).where("_k is not null and _k <> ''")
    r = r.withColumn("_n", F.row_number().over(W.partitionBy("_k").orderBy(*order))).where("_n = 1").select("_k", F.struct(*values).alias("_v"))
    out = left
    for i, k in enumerate(keys):
        out = out.join(r.select(F.col("_k").alias(f"_k{i}"), F.col("_v").alias(f"_v{i}")), k == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    got = F.coalesce(*[F.col(f"_v{i}") for i in range(len(keys))])
    return out.select(*left.columns, *[got[v].alias(v) for v in values])


def path_key(c: Column) -> Column:
    """A file path in one form: trimmed, lower case, forward slashes, no scheme, no doubled or last slash."""
    x = F.replace(F.lower(F.trim(c)), F.lit("\\"), F.lit("/"))
    x = F.regexp_replace(F.regexp_replace(x, "^file://", ""), "/+", "/")
    return F.regexp_replace(F.regexp_replace(x, r"/\./", "/"), "/$", "")


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))).where("_n = 1").drop("_n")


def diff(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One full outer join, each row added, removed, changed or same."""
    o, n = old.select(*keys, F.struct(*values).alias("o")), new.select(*keys, F.struct(*values).alias("n"))
    return o.join(n, keys, "full").select(*keys, F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("o") != F.col("n"), "changed").otherwise("same").alias("state"))


def put(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Update-only merge: matched rows take the update's values, nulls too, nothing is inserted. A null, unknown or repeated
    key of the updates is an error, raised inside the job by the rows that have it."""
    fail = lambda what: F.raise_error(F.concat(F.lit(what), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean")
    u = updates.groupBy(key).agg(F.count("*").alias("_n"), F.first(F.struct(*[c for c in updates.columns if c != key])).alias("_u"))
    j = target.withColumn("_there", F.lit(True)).join(u, key, "full")
    ok = F.when(F.col("_there").isNull(), fail("no such id: ")).when(F.col("_n") > 1, fail("repeated id: ")).otherwise(F.lit(True))
    have = set(updates.columns)
    pick = lambda c: F.when(F.col("_n").isNotNull(), F.col("_u")[c]).otherwise(F.col(c)).alias(c) if c in have and c != key else F.col(c)
    return j.where(ok).select(*map(pick, target.columns))


def expand(edges: DataFrame, start: DataFrame, hops: int) -> DataFrame:
    """(node, hop): nodes within so many undirected hops of the start nodes, with the least hop. Each hop is one semi-join
    with the edges; nodes reached before are not expanded again."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    seen = start.select("node", F.lit(0).alias("hop"))
    front = seen
    for h in range(1, hops + 1):
        front = both.join(front.select(F.col("node").alias("a")), "a", "left_semi").select(F.col("b").alias("node")).distinct().join(seen, "node", "left_anti").select("node", F.lit(h).alias("hop"))
        seen = seen.union(front)
    return seen.groupBy("node").agg(F.min("hop").alias("hop"))


def content_hash_dedup(s, d):
    t = table(s, d, "documents").where("text is not null and trim(text) <> ''")
    return t.groupBy(F.md5("text").alias("text_md5")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"))


def sidecar_left_first_match(s, d):
    src = latest(table(s, d, "sources"), "source_id", "last_modified").select("source_id", "source_name")
    side = table(s, d, "sidecar").select(F.col("source").alias("file"), "meta_a", "meta_b")
    return first_match(src, side, [path_key(F.col("source_id"))], path_key(F.col("file")), [F.asc_nulls_last("meta_b"), F.asc_nulls_last("meta_a"), F.asc("file")], ["meta_a", "meta_b"])


def schema_diff_full_outer(s, d):
    src = table(s, d, "sources").select("source_id", "source_type", "access_level", "last_modified", "partition_id")
    old = src.groupBy("source_id").agg(F.min(F.struct("last_modified", "partition_id")).alias("x")).select("source_id", "x.*").where("partition_id % 5 <> 0")
    new = src.groupBy("source_id").agg(F.max(F.struct("last_modified", "partition_id")).alias("x")).select("source_id", "x.*").where("partition_id % 7 <> 0")
    return diff(old, new, ["source_id"], ["last_modified"])


def put_update_only(s, d):
    t = table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    u = t.where("o_orderkey % 3 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "X").alias("o_orderstatus"))
    return put(t, u, "o_orderkey")


def _fk(s, d) -> DataFrame:
    key = lambda name, c: F.concat(F.lit(f"{name}:"), F.col(c).cast("string"))
    n, c, p = table(s, d, "nation"), table(s, d, "customer"), table(s, d, "supplier")
    return n.select(key("nation", "n_nationkey").alias("a"), key("region", "n_regionkey").alias("b")).union(c.select(key("customer", "c_custkey").alias("a"), key("nation", "c_nationkey").alias("b"))).union(p.select(key("supplier", "s_suppkey").alias("a"), key("nation", "s_nationkey").alias("b")))


def fk_expand_3hop(s, d):
    start = s.createDataFrame([("supplier:1",)], "node string")
    return expand(_fk(s, d), start, 3)


def distinct_edges(s, d):
    e = table(s, d, "lineitem").select(F.least("l_suppkey", F.col("l_partkey") % 100).alias("a"), F.greatest("l_suppkey", F.col("l_partkey") % 100).alias("b"))
    return e.distinct()


def union_null_pad(s, d):
    r = table(s, d, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("region_name"))
    n = table(s, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("nation_name"))
    return r.unionByName(n, allowMissingColumns=True)


def except_names(s, d):
    a = latest(table(s, d, "sources"), "source_id", "last_modified").select("source_id")
    b = table(s, d, "chunks").select("source_id").distinct()
    left = a.join(b, "source_id", "left_anti").select("source_id", F.lit("no chunks").alias("side"))
    return left.union(b.where("source_id is not null").join(a, "source_id", "left_anti").select("source_id", F.lit("no file").alias("side")))


def candidate_best_score_cap(s, d):
    o = table(s, d, "observations").where("score is not null").groupBy("model", "chunk_id").agg(F.max("score").alias("score"))
    return o.withColumn("rank", F.row_number().over(W.partitionBy("model").orderBy(F.desc("score"), "chunk_id"))).where("rank <= 15")


def table_text_docs(s, d):
    src = latest(table(s, d, "sources"), "source_id", "last_modified")
    c = table(s, d, "chunks").where("source_id is not null").groupBy("source_id").agg(F.countDistinct("chunk_id").alias("n"), F.array_join(F.array_sort(F.collect_set("content_type")), ",").alias("types"))
    return src.join(c, "source_id").select("source_id", F.concat_ws(" ", F.lit("file"), F.coalesce("source_name", F.lit("?")), F.lit("has"), F.col("n").cast("string"), F.lit("chunks of"), F.col("types")).alias("line"))


def job_status_rollup(s, d):
    """Jobs are customers' orders: completed, failed or partly so by the states of their documents."""
    o = table(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_orderstatus") == "P").alias("failed"), F.count_if(F.col("o_orderstatus") == "O").alias("pending"))
    return o.withColumn("status", F.when(F.col("pending") > 0, "processing").when(F.col("failed") == 0, "completed").when(F.col("done") == 0, "failed").otherwise("partial_success"))


def status_counts_by_group(s, d):
    e = table(s, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return e.groupBy("user_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "n"))))).alias("counts"))


def run_history_page(s, d):
    return table(s, d, "events").where("event_type = 'error' and props like '%1%'").orderBy(F.desc("ts"), F.desc("event_id")).offset(20).limit(20).select("event_id", "user_id", F.round("value", 4).alias("value"))


def audit_stats(s, d):
    e = table(s, d, "events")
    return e.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.count_if(F.col("event_type") == "error") / F.count("*"), 4).alias("error_rate"), F.countDistinct(F.coalesce("user_id", F.lit(-1))).alias("n_users"))


RULES = [(1, "p50", ">", 50.0, None), (2, "p95", ">=", 90.0, "click"), (3, "n", "<", 1000.0, None), (4, "p50", "<=", 49.0, "view"), (5, "worst", ">", 0.0, None)]
OPERATORS = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "=": lambda a, b: a == b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b}


def compare(op: Column, a: Column, b: Column) -> Column:
    out = F.lit(None).cast("boolean")
    for name, f in OPERATORS.items():
        out = F.when(op == name, f(a, b)).otherwise(out)
    return out


def _metrics(s, d) -> DataFrame:
    m = table(s, d, "events").where("value is not null").groupBy("event_type").agg(F.round(F.percentile("value", F.lit(0.5)), 3).alias("p50"), F.round(F.percentile("value", F.lit(0.95)), 3).alias("p95"), F.count("*").cast("double").alias("n"))
    return m.unpivot("event_type", ["p50", "p95", "n"], "metric", "measured")


def alert_rule_matches(s, d):
    """Rules with null filters match any run; a metric that isn't there matches none. The rules are a fixed table."""
    rules = s.createDataFrame(RULES, "rule_id int, metric string, op string, bound double, only string")
    j = _metrics(s, d).join(F.broadcast(rules), "metric").where("only is null or only = event_type")
    return j.where(compare(F.col("op"), F.col("measured"), F.col("bound"))).select("rule_id", "event_type", "metric", "measured")


def metric_gate_eval(s, d):
    rules = s.createDataFrame(RULES, "rule_id int, metric string, op string, bound double, only string")
    m = _metrics(s, d).groupBy("metric").agg(F.max("measured").alias("measured"))
    return rules.join(m, "metric", "left").select("rule_id", "metric", F.coalesce(compare(F.col("op"), F.col("measured"), F.col("bound")), F.lit(False)).alias("passed"))


def run_diff_full_outer(s, d):
    e = table(s, d, "events").where("value is not null")
    day = lambda odd, name: e.where(f"user_id % 2 = {odd} and event_type <> '{'view' if odd else 'click'}'").groupBy("event_type").agg(F.round(F.avg("value"), 4).alias(name))
    j = day(0, "a").join(day(1, "b"), "event_type", "full")
    return j.select("event_type", "a", "b", F.round(F.col("b") - F.col("a"), 4).alias("delta"), F.when(F.col("a") != 0, F.round((F.col("b") - F.col("a")) / F.col("a") * 100, 2)).alias("percent"))


def metadata_like_filter(s, d):
    t = table(s, d, "chunks").select("chunk_id", F.to_json(F.struct(F.col("content_type").alias("label"), F.col("source_name").alias("database"))).alias("metadata")).distinct()
    return t.where(F.expr(T.metadata_predicate(["table", "Text"], "imhath-minutes"))).select("chunk_id").distinct()


def json_field_extract(s, d):
    e = table(s, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.length("props").alias("n"))


def row_validity_counters(s, d):
    """What a vector table's writer takes and drops: null or short vectors, blank texts."""
    v = table(s, d, "embeddings").join(table(s, d, "documents"), F.col("vec_id") == F.col("doc_id"), "left")
    text = F.coalesce(F.trim("text"), F.lit("")) != ""
    return v.agg(F.count_if(F.col("embedding").isNull()).alias("dropped_no_embedding"), F.count_if(F.col("embedding").isNotNull() & (F.size("embedding") != 64)).alias("dropped_bad_length"), F.count_if(F.col("embedding").isNotNull() & (F.size("embedding") == 64) & ~text).alias("dropped_no_text"), F.count_if(F.col("embedding").isNotNull() & (F.size("embedding") == 64) & text).alias("written"))


def latest_chunks_by_source(s, d):
    c = latest(table(s, d, "chunks"), "chunk_id", "ingested_at")
    return c.groupBy("source_name").agg(F.count("*").alias("n"), F.countDistinct("path").alias("files"), F.sum(F.length("text")).alias("characters"))


QUERIES = {f.__name__: f for f in (content_hash_dedup, sidecar_left_first_match, schema_diff_full_outer, put_update_only, fk_expand_3hop, distinct_edges, union_null_pad, except_names, candidate_best_score_cap, table_text_docs, job_status_rollup, status_counts_by_group, run_history_page, audit_stats, alert_rule_matches, metric_gate_eval, run_diff_full_outer, metadata_like_filter, json_field_extract, row_validity_counters, latest_chunks_by_source)}

_LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY last_modified DESC) AS n FROM sources) WHERE n = 1"
_KEY = lambda c: f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(lower(trim({c}, ' ')), '\\', '/'), '^file://', ''), '/+', '/', 'g'), '/\\./', '/', 'g'), '/$', '')"
_RULES = ", ".join(f"({i}, '{m}', '{o}', {b}, {'NULL' if w is None else repr(w)})" for i, m, o, b, w in RULES)
_METRICS = "SELECT event_type, unnest(['p50', 'p95', 'n']) AS metric, unnest([round(quantile_cont(value, 0.5), 3), round(quantile_cont(value, 0.95), 3), count(*)::DOUBLE]) AS measured FROM events WHERE value IS NOT NULL GROUP BY event_type"
_OP = "CASE op WHEN '>' THEN measured > bound WHEN '>=' THEN measured >= bound WHEN '<' THEN measured < bound WHEN '<=' THEN measured <= bound END"
SQL = {
    "content_hash_dedup": "SELECT md5(text) AS text_md5, min(doc_id) AS doc_id, count(*) AS n_copies FROM documents WHERE text IS NOT NULL AND trim(text, ' ') <> '' GROUP BY 1",
    "sidecar_left_first_match": f"WITH s AS (SELECT source_id, source_name FROM ({_LATEST})), r AS (SELECT * FROM (SELECT *, {_KEY('source')} AS k, row_number() OVER (PARTITION BY {_KEY('source')} ORDER BY meta_b NULLS LAST, meta_a NULLS LAST, source) AS n FROM sidecar) WHERE n = 1 AND k <> '') SELECT source_id, source_name, meta_a, meta_b FROM s LEFT JOIN r ON {_KEY('source_id')} = k",
    "schema_diff_full_outer": "WITH o AS (SELECT * FROM (SELECT source_id, last_modified, partition_id, row_number() OVER (PARTITION BY source_id ORDER BY last_modified NULLS FIRST, partition_id NULLS FIRST) AS n FROM sources) WHERE n = 1 AND partition_id % 5 <> 0), w AS (SELECT * FROM (SELECT source_id, last_modified, partition_id, row_number() OVER (PARTITION BY source_id ORDER BY last_modified DESC NULLS LAST, partition_id DESC NULLS LAST) AS n FROM sources) WHERE n = 1 AND partition_id % 7 <> 0) SELECT coalesce(o.source_id, w.source_id) AS source_id, CASE WHEN o.source_id IS NULL THEN 'added' WHEN w.source_id IS NULL THEN 'removed' WHEN o.last_modified IS DISTINCT FROM w.last_modified THEN 'changed' ELSE 'same' END AS state FROM o FULL JOIN w USING (source_id)",
    "put_update_only": "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'X' WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders",
    "fk_expand_3hop": "WITH RECURSIVE e AS (SELECT 'nation:' || n_nationkey AS a, 'region:' || n_regionkey AS b FROM nation UNION SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer UNION SELECT 'supplier:' || s_suppkey, 'nation:' || s_nationkey FROM supplier), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, hop) AS (SELECT 'supplier:1', 0 UNION SELECT u.b, hop + 1 FROM r JOIN u ON u.a = node WHERE hop < 3) SELECT node, min(hop) AS hop FROM r GROUP BY 1",
    "distinct_edges": "SELECT DISTINCT least(l_suppkey, l_partkey % 100) AS a, greatest(l_suppkey, l_partkey % 100) AS b FROM lineitem",
    "union_null_pad": "SELECT r_regionkey AS id, r_name AS region_name, NULL::VARCHAR AS nation_name FROM region UNION ALL SELECT n_nationkey, NULL, n_name FROM nation",
    "except_names": "SELECT source_id, 'no chunks' AS side FROM (SELECT source_id FROM sources EXCEPT SELECT source_id FROM chunks) UNION ALL SELECT source_id, 'no file' FROM (SELECT source_id FROM chunks WHERE source_id IS NOT NULL EXCEPT SELECT source_id FROM sources)",
    "candidate_best_score_cap": "SELECT * FROM (SELECT model, chunk_id, score, row_number() OVER (PARTITION BY model ORDER BY score DESC, chunk_id) AS rank FROM (SELECT model, chunk_id, max(score) AS score FROM observations WHERE score IS NOT NULL GROUP BY 1, 2)) WHERE rank <= 15",
    "table_text_docs": f"SELECT s.source_id, 'file ' || coalesce(source_name, '?') || ' has ' || c.n || ' chunks of ' || coalesce(types, '') AS line FROM ({_LATEST}) s JOIN (SELECT source_id, count(DISTINCT chunk_id) AS n, string_agg(DISTINCT content_type, ',' ORDER BY content_type) AS types FROM chunks GROUP BY 1) c USING (source_id)",
    "job_status_rollup": "SELECT *, CASE WHEN pending > 0 THEN 'processing' WHEN failed = 0 THEN 'completed' WHEN done = 0 THEN 'failed' ELSE 'partial_success' END AS status FROM (SELECT o_custkey, count(*) AS n, count_if(o_orderstatus = 'F') AS done, count_if(o_orderstatus = 'P') AS failed, count_if(o_orderstatus = 'O') AS pending FROM orders GROUP BY 1)",
    "status_counts_by_group": "SELECT user_id, '{' || string_agg('\"' || event_type || '\":' || n, ',' ORDER BY event_type) || '}' AS counts FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1",
    "run_history_page": "SELECT event_id, user_id, round(value, 4) AS value FROM events WHERE event_type = 'error' AND props LIKE '%1%' ORDER BY ts DESC, event_id DESC LIMIT 20 OFFSET 20",
    "audit_stats": "SELECT ts::DATE AS day, count(*) AS n, round(count_if(event_type = 'error') / count(*), 4) AS error_rate, count(DISTINCT coalesce(user_id, -1)) AS n_users FROM events GROUP BY 1",
    "alert_rule_matches": f"SELECT rule_id, event_type, metric, measured FROM ({_METRICS}) JOIN (VALUES {_RULES}) r(rule_id, metric, op, bound, only_type) USING (metric) WHERE (only_type IS NULL OR only_type = event_type) AND {_OP}",
    "metric_gate_eval": f"SELECT rule_id, metric, coalesce({_OP}, false) AS passed FROM (VALUES {_RULES}) r(rule_id, metric, op, bound, only_type) LEFT JOIN (SELECT metric, max(measured) AS measured FROM ({_METRICS}) GROUP BY 1) USING (metric)",
    "run_diff_full_outer": "WITH a AS (SELECT event_type, round(avg(value), 4) AS a FROM events WHERE value IS NOT NULL AND user_id % 2 = 0 AND event_type <> 'click' GROUP BY 1), b AS (SELECT event_type, round(avg(value), 4) AS b FROM events WHERE value IS NOT NULL AND user_id % 2 = 1 AND event_type <> 'view' GROUP BY 1) SELECT event_type, a, b, round(b - a, 4) AS delta, CASE WHEN a <> 0 THEN round((b - a) / a * 100, 2) END AS percent FROM a FULL JOIN b USING (event_type)",
    "metadata_like_filter": "SELECT DISTINCT chunk_id FROM chunks WHERE content_type IN ('table', 'Text') AND source_name = 'imhath-minutes'",
    "json_field_extract": "SELECT event_id, json_extract_string(props, '$.k') AS k, length(props)::INT AS n FROM events",
    "row_validity_counters": "SELECT count_if(embedding IS NULL) AS dropped_no_embedding, count_if(len(embedding) <> 64) AS dropped_bad_length, count_if(len(embedding) = 64 AND coalesce(trim(text, ' '), '') = '') AS dropped_no_text, count_if(len(embedding) = 64 AND coalesce(trim(text, ' '), '') <> '') AS written FROM embeddings LEFT JOIN documents ON vec_id = doc_id",
    "latest_chunks_by_source": "SELECT source_name, count(*) AS n, count(DISTINCT path) AS files, sum(length(text)) AS characters FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY ingested_at DESC) AS n FROM chunks) WHERE n = 1 GROUP BY 1",
}
