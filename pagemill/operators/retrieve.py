"""Retrieval: exact vector search, lexical search, fusion, shaping, reranking, caps, metrics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators.evaluate import content_types
from pagemill.runtime import prepare, small, staged, table

#: Query vectors, and query texts, compared in one pass over the corpus; what is shipped is bounded by it.
QUERY_BLOCK, TEXT_BLOCK = 8192, 1024
#: Documents scored at a time, and rows of a staged table of terms that may be broadcast (under 50 MB).
SLICE, BROADCAST_ROWS = 512, 1_000_000
#: A term: a run of letters and digits of any script.
TERM = r"[\p{L}\p{N}]+"
KS = (1, 3, 5, 10)


def top(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each group, with their rank."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def _in_blocks(queries: DataFrame, key: str, size: int):
    """The queries in blocks of about that size, by a hash of their key."""
    n = queries.count()
    blocks = -(-n // size)
    q = queries.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(max(blocks, 1))))
    for b in range(blocks):
        yield q.where(F.col("_block") == b).drop("_block")


def _first(who: np.ndarray, ids: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the candidates (query, id, order) the k first of each query, ties by id."""
    at = np.lexsort((ids, order, who))
    who, ids, order = who[at], ids[at], order[at]
    start = np.searchsorted(who, who)
    keep = np.arange(len(who)) - start < k
    return who[keep], ids[keep], order[keep]


def _least(d: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the entries of each row that are within slack of its k least."""
    bound = np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] > k else np.full(len(d), np.inf)
    return np.nonzero((d <= bound[:, None] + slack) & np.isfinite(d))


def knn(queries: DataFrame, corpus: DataFrame, k: int, same: bool = False) -> DataFrame:
    """Exact nearest neighbours by squared L2: (query_id, vec_id, distance, rank), distance to 4 places, ties by id.

    queries and corpus: (vec_id, embedding). Queries go in blocks over the corpus: a matrix product tells which distances
    can be among the k least, these are computed exactly; every partition keeps its k best of each query, so what is
    shuffled doesn't grow with the corpus but with its partitions. Null vectors, and those of another length than a query,
    have no neighbours.
    """
    prepare(corpus.sparkSession)
    out = None
    for block in _in_blocks(queries.where("embedding is not null").select("vec_id", "embedding"), "vec_id", QUERY_BLOCK):
        by_size: dict[int, list] = {}
        for r in block.collect():
            by_size.setdefault(len(r[1]), []).append(r)
        for size, rows in by_size.items():
            ids, q = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)

            def best(batches, ids=ids, q=q, size=size):
                norm, got = (q * q).sum(axis=1), (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    v, x = batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
                    d = norm[:, None] + (x * x).sum(axis=1)[None, :] - 2.0 * (q @ x.T)
                    if not same:
                        d[ids[:, None] == v[None, :]] = np.inf
                    i, j = _least(d, k, 2e-4 + 1e-9 * float(norm.max(initial=0.0)))
                    exact = np.round(((x[j] - q[i]) ** 2).sum(axis=1), 4)
                    got = _first(*(np.concatenate(p) for p in zip(got, (i, v[j], exact))), k)
                yield pa.RecordBatch.from_arrays([pa.array(ids[got[0]]), pa.array(got[1]), pa.array(got[2])], names=["query_id", "vec_id", "distance"])

            near = corpus.where(f"embedding is not null and size(embedding) = {size}").select("vec_id", "embedding").mapInArrow(best, "query_id bigint, vec_id bigint, distance double")
            out = near if out is None else out.union(near)
    if out is None:
        return corpus.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, distance double, rank int")
    return top(out, ["query_id"], [F.asc("distance"), F.asc("vec_id")], k)


def pooled(queries: DataFrame, corpus: DataFrame, top_k: int, candidate_k: int | None = None) -> DataFrame:
    """knn with the pool that filters and de-duplication start from; a pool below what is wanted is an error."""
    pool = candidate_k or top_k
    if top_k <= 0 or pool < top_k:
        raise ValueError("candidate_k must be at least top_k, and top_k positive")
    return knn(queries, corpus, pool)


def fuse(ranked: DataFrame, k: int = 60) -> DataFrame:
    """Reciprocal rank fusion of (query_id, step, doc_id, rank) rows: score is the sum of 1 / (rank + k); order by score,
    then first appearance (step, rank), then id. With columns text and final_rank, also the text seen first, whether a
    query has any final rank, and the document's least one."""
    extra = []
    if "text" in ranked.columns:
        extra.append(F.min_by("text", F.struct("step", "rank")).alias("text"))
    if "final_rank" in ranked.columns:
        extra.append(F.min("final_rank").alias("react_final_rank"))
    s = ranked.groupBy("query_id", "doc_id").agg(F.round(F.sum(1 / (F.col("rank") + k)), 8).alias("score"), F.min(F.struct("step", "rank")).alias("first"), *extra)
    if "final_rank" in ranked.columns:
        s = s.withColumn("has_valid_final_results", F.max(F.col("react_final_rank").isNotNull()).over(W.partitionBy("query_id")))
    return s.withColumn("final_rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "first", "doc_id"))).drop("first")


def fuse_scored(lists: DataFrame, k: int = 60) -> DataFrame:
    """fuse of (query_id, step, doc_id, score): the rank in each list follows from its scores, ties by id."""
    w = W.partitionBy("query_id", "step").orderBy(F.desc_nulls_last("score"), "doc_id")
    return fuse(lists.withColumn("rank", F.row_number().over(w)).drop("score"), k)


def selected(fused: DataFrame, k: int) -> DataFrame:
    """The final documents of each query: by their final ranks where the query has any, else by fusion."""
    own = F.col("has_valid_final_results")
    rows = fused.where(~own | F.col("react_final_rank").isNotNull())
    order = F.when(own, F.col("react_final_rank"))
    return top(rows.drop("rank"), ["query_id"], [order.asc_nulls_last(), F.asc("final_rank")], k).select("query_id", "doc_id", "rank")


def terms(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TERM), F.lit(0))


def bm25(queries: DataFrame, docs: DataFrame, k: int, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """The k best documents of each query: (query_id, doc_id, score, rank), score to 6 places, ties by id.

    queries: (query_id, text), all distinct terms of which count; docs: (doc_id, text). Document frequencies are counted for
    the queries' terms only. Queries go in blocks over the documents, each batch of which is scored against all queries that
    have its terms; a partition keeps its k best of each query, so no posting is shuffled. Texts without a term are in no
    result.
    """
    spark = prepare(docs.sparkSession)
    wanted = staged(queries.where("text is not null").select("query_id", F.explode(F.array_distinct(terms(F.col("text")))).alias("term")), "terms")
    docs = docs.where("text is not null").select("doc_id", terms(F.col("text")).alias("terms")).where("size(terms) > 0")
    n, average = docs.agg(F.count("*"), F.avg(F.size("terms"))).first()
    vocabulary = small(staged(wanted.select("term").distinct(), "vocabulary"), BROADCAST_ROWS)
    df = docs.select(F.explode(F.array_distinct("terms")).alias("term")).join(vocabulary, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    weighted = staged(wanted.join(df, "term").select("query_id", "term", F.log(1 + (F.lit(n or 0) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")), "weighted")
    out = None
    for block in _in_blocks(weighted.select("query_id").distinct(), "query_id", TEXT_BLOCK):
        rows = weighted.join(F.broadcast(block), "query_id").collect()  # the terms of a bounded number of queries
        ids, who = np.unique([r["query_id"] for r in rows], return_inverse=True)
        words, what = np.unique([r["term"] for r in rows], return_inverse=True)
        idf = np.zeros(len(words))
        idf[what] = [r["idf"] for r in rows]
        order = np.argsort(what, kind="stable")
        lists = np.split(who[order], np.cumsum(np.bincount(what, minlength=len(words)))[:-1])

        def score(batches, ids=ids, words=words.tolist(), idf=idf, lists=lists):
            value_set, got = pa.array(words, pa.string()), (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            for whole in batches:
                for s in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(s, SLICE)
                    doc_id, size = batch.column(0).to_numpy(), pc.list_value_length(batch.column(1)).to_numpy()
                    term = pc.fill_null(pc.index_in(batch.column(1).flatten(), value_set=value_set), -1).to_numpy()
                    doc = np.repeat(np.arange(len(doc_id)), size)[term >= 0]
                    pair, tf = np.unique(term[term >= 0].astype(np.int64) * SLICE + doc, return_counts=True)
                    t, d = pair // SLICE, pair % SLICE
                    w = idf[t] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * size[d] / average))
                    total = np.zeros((len(ids), len(doc_id)))
                    cut = np.flatnonzero(np.diff(t)) + 1
                    for at, v in zip(np.split(np.arange(len(t)), cut), np.split(w, cut)):
                        if len(at):
                            total[lists[t[at[0]]][:, None], d[at]] += v
                    total[total == 0] = -np.inf
                    i, j = _least(-total, k, 1e-6)
                    got = _first(*(np.concatenate(p) for p in zip(got, (i, doc_id[j], -np.round(total[i, j], 6)))), k)
            yield pa.RecordBatch.from_arrays([pa.array(ids[got[0]]), pa.array(got[1]), pa.array(-got[2])], names=["query_id", "doc_id", "score"])

        part = docs.mapInArrow(score, "query_id bigint, doc_id bigint, score double")
        out = part if out is None else out.union(part)
    if out is None:
        return spark.createDataFrame([], "query_id bigint, doc_id bigint, score double, rank int")
    return top(out, ["query_id"], [F.desc("score"), F.asc("doc_id")], k)


def metrics(run: DataFrame, qrels: DataFrame, ks: tuple[int, ...] = KS) -> DataFrame:
    """(query_id, recall_k, ndcg_k) at each k for each query of qrels (query_id, doc_id, grade), to 6 places: of the grades
    above 0, gain linear. A query without a run, or without a relevant document, scores 0. run: (query_id, doc_id, score),
    in the order of score, then id."""
    if not ks or min(ks) <= 0:
        raise ValueError("cutoffs must be positive")
    most = max(ks)
    gain = F.col("grade") / F.log2(F.col("rank") + 1)
    cut = lambda name, x: [F.coalesce(F.sum(F.when(F.col("rank") <= k, x)), F.lit(0.0)).alias(f"{name}_{k}") for k in ks]
    good = qrels.where("grade > 0")
    ideal = top(good, ["query_id"], [F.desc("grade"), F.asc("doc_id")], most).groupBy("query_id").agg(*cut("ideal", gain))
    count = good.groupBy("query_id").agg(F.count("*").alias("n_rel"))
    got = top(run.select("query_id", "doc_id", "score"), ["query_id"], [F.desc("score"), F.asc("doc_id")], most).join(good, ["query_id", "doc_id"])
    got = got.groupBy("query_id").agg(*cut("hits", F.lit(1)), *cut("dcg", gain))
    x = qrels.select("query_id").distinct().join(count, "query_id", "left").join(ideal, "query_id", "left").join(got, "query_id", "left")
    share = lambda a, b: F.round(F.coalesce(F.when(F.col(b) > 0, F.col(a) / F.col(b)), F.lit(0.0)), 6)
    return x.select("query_id", *[share(f"hits_{k}", "n_rel").alias(f"recall_{k}") for k in ks], *[share(f"dcg_{k}", f"ideal_{k}").alias(f"ndcg_{k}") for k in ks])


def shape(hits: DataFrame, top_k: int, types: str | None = None, dedup: bool = False) -> DataFrame:
    """The first top_k hits of each query, in their order, after the allow-list of content types and, with dedup, only the
    first hit of each page. hits: (query_id, rank, content_type, doc, page)."""
    if types is not None:
        hits = hits.where(F.lower(F.trim("content_type")).isin(content_types(types)))
    if dedup:
        hits = page_dedup(hits, "doc", "page")
    return top(hits.withColumnRenamed("rank", "_rank"), ["query_id"], [F.asc("_rank")], top_k).drop("_rank")


def page_dedup(hits: DataFrame, doc: str, page: str) -> DataFrame:
    """The first hit of each page of a document in each query; hits without a page all stay."""
    w = W.partitionBy("query_id", doc, page).orderBy("rank")
    return hits.withColumn("nth", F.row_number().over(w)).where((F.col("nth") == 1) | F.col(page).isNull()).drop("nth")


def _vectors(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "embeddings")


def _queries(v: DataFrame) -> DataFrame:
    return v.where("vec_id % 50 = 0")


def knn_topk(s, d):
    v = _vectors(s, d)
    return knn(_queries(v), v, 10)


def knn_where_prefilter(s, d):
    v = _vectors(s, d)
    return knn(_queries(v), v.where("label % 2 = 0"), 5)


def knn_label_capped(s, d):
    v = _vectors(s, d)
    hits = pooled(_queries(v), v, 3, 40).join(v.select("vec_id", "label"), "vec_id").drop("rank")
    return top(hits, ["query_id", "label"], [F.asc("distance"), F.asc("vec_id")], 3)


def _hits(s, d) -> DataFrame:
    v = _vectors(s, d)
    return pooled(_queries(v), v, 10, 40).withColumn("page", F.expr("case when vec_id % 7 = 0 then null else vec_id div 10 end")).withColumn("doc", F.expr("vec_id div 50"))


def knn_page_dedup(s, d):
    return page_dedup(_hits(s, d), "doc", "page").select("query_id", "vec_id", "doc", "page", "rank")


def knn_shaped(s, d):
    """Allow-list, then one hit a page, then the first ten."""
    kind = F.expr("element_at(array('text', 'Table ', 'image', null), int(vec_id % 4) + 1)")
    return shape(_hits(s, d).withColumn("content_type", kind), 10, "tables, text", True).select("query_id", "vec_id", "page", "rank")


def _text_queries(s, d) -> DataFrame:
    return table(s, d, "documents").where("doc_id % 50 = 0 and text is not null").select(F.col("doc_id").alias("query_id"), "text")


def bm25_topk(s, d):
    return bm25(_text_queries(s, d), table(s, d, "documents").select("doc_id", "text"), 10)


def rrf_fusion(s, d):
    v = _vectors(s, d)
    near = knn(_queries(v), v, 10).select("query_id", F.lit(0).alias("step"), F.col("vec_id").alias("doc_id"), "rank")
    other = knn(_queries(v), v.where("label % 2 = 0"), 10).select("query_id", F.lit(1).alias("step"), F.col("vec_id").alias("doc_id"), "rank")
    return fuse(near.union(other))


def hybrid_rank(s, d):
    """Dense and lexical ranks of the same ids, fused."""
    v = _vectors(s, d)
    dense = knn(_queries(v), v, 10).select("query_id", F.lit(0).alias("step"), F.col("vec_id").alias("doc_id"), "rank")
    lexical = bm25_topk(s, d).select("query_id", F.lit(1).alias("step"), "doc_id", "rank")
    return fuse(dense.union(lexical)).where("final_rank <= 10")


def rrf_final_ranks(s, d):
    """Two searches with texts and, for some queries, final ranks: fused, and the documents selected from them."""
    v = _vectors(s, d)
    near = knn(_queries(v), v, 10).select("query_id", F.lit(0).alias("step"), F.col("vec_id").alias("doc_id"), "rank")
    other = knn(_queries(v), v.where("label % 2 = 0"), 10).select("query_id", F.lit(1).alias("step"), F.col("vec_id").alias("doc_id"), "rank")
    lists = near.union(other).withColumn("text", F.concat_ws(":", "step", "doc_id")).withColumn("final_rank", F.expr("case when query_id % 100 = 0 and doc_id % 3 = 0 then 30 - rank end"))
    f = fuse(lists)
    return f.join(selected(f, 5).withColumnRenamed("rank", "selected"), ["query_id", "doc_id"], "left")


def rrf_by_scores(s, d):
    v = _vectors(s, d)
    hits = knn(_queries(v), v, 10).select("query_id", F.expr("int(vec_id % 2)").alias("step"), F.col("vec_id").alias("doc_id"), (-F.col("distance")).alias("score"))
    return fuse_scored(hits)


def rerank_topk(s, d):
    """Candidates of the lexical search, ordered anew by the share of the query's terms they hold."""
    t = table(s, d, "documents").where("text is not null").select("doc_id", F.array_distinct(terms(F.col("text"))).alias("have"))
    cand = bm25_topk(s, d).select("query_id", "doc_id").join(t, "doc_id")
    q = t.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), F.col("have").alias("want"))
    sc = cand.join(q, "query_id").select("query_id", "doc_id", F.round(F.size(F.array_intersect("want", "have")) / F.size("want"), 6).alias("score"))
    return top(sc, ["query_id"], [F.desc("score"), F.asc("doc_id")], 5)


def _judged(s, d) -> DataFrame:
    """Metrics of a run that lacks every other query; relevant are the vectors of the query's label, in two grades."""
    v = _vectors(s, d)
    q = _queries(v).select(F.col("vec_id").alias("query_id"), "label")
    qrels = q.join(v.select(F.col("vec_id").alias("doc_id"), "label"), "label").where("query_id <> doc_id").select("query_id", "doc_id", F.expr("int(doc_id % 3)").alias("grade"))
    run = knn(_queries(v).where("vec_id % 100 = 0"), v, 10).select("query_id", F.col("vec_id").alias("doc_id"), (-F.col("distance")).alias("score"))
    return metrics(run, qrels)


def beir_recall_ndcg(s, d):
    return _judged(s, d)


def beir_means(s, d):
    m = _judged(s, d)
    return m.agg(F.count("*").alias("n"), *[F.round(F.avg(c), 6).alias(c) for c in m.columns if c != "query_id"])


def recall_hit_rate(s, d):
    v = _vectors(s, d)
    q = _queries(v).select(F.col("vec_id").alias("query_id"), F.col("label").alias("q_label"))
    run = q.join(knn(_queries(v), v, 10).join(v.select("vec_id", "label"), "vec_id"), "query_id", "left")
    per = run.groupBy("query_id").agg(*[F.coalesce(F.max(((F.col("label") == F.col("q_label")) & (F.col("rank") <= k)).cast("int")), F.lit(0)).alias(f"h{k}") for k in (1, 5, 10)])
    return per.agg(F.count("*").alias("n"), *[F.round(F.avg(f"h{k}"), 6).alias(f"hit_{k}") for k in (1, 5, 10)])


QUERIES = {f.__name__: f for f in (knn_topk, knn_where_prefilter, knn_label_capped, knn_page_dedup, knn_shaped, bm25_topk, rrf_fusion, rrf_final_ranks, rrf_by_scores, hybrid_rank, rerank_topk, beir_recall_ndcg, beir_means, recall_hit_rate)}

_KNN = "SELECT q.vec_id AS query_id, c.vec_id, round(list_sum(list_transform(list_zip(q.embedding, c.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))), 4) AS distance, c.label, q.label AS q_label FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0"
_RANK = lambda k, where="true", keep="query_id, vec_id, distance, rank": f"SELECT {keep} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM ({_KNN}) WHERE {where}) WHERE rank <= {k}"
_FUSE = lambda lists: f"SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, f, doc_id) AS final_rank FROM (SELECT query_id, doc_id, round(sum(1.0 / (rank + 60)), 8) AS score, min(step * 100000 + rank) AS f FROM ({lists}) GROUP BY query_id, doc_id)"
_LISTS = f"SELECT query_id, 0 AS step, vec_id AS doc_id, rank FROM ({_RANK(10)}) UNION ALL SELECT query_id, 1, vec_id, rank FROM ({_RANK(10, 'label % 2 = 0')})"
_TERMS = f"regexp_extract_all(lower(text), '{TERM}')"
_WORDS = f"SELECT doc_id, unnest({_TERMS}) AS term FROM documents WHERE text IS NOT NULL"
_QTERMS = f"SELECT doc_id AS query_id, unnest(list_distinct({_TERMS})) AS term FROM documents WHERE text IS NOT NULL AND doc_id % 50 = 0"
_BM25 = f"""WITH w AS ({_WORDS}), tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL), dl AS (SELECT doc_id, sum(tf) AS dl FROM tf GROUP BY ALL),
 st AS (SELECT count(*) AS n, avg(dl) AS a FROM dl), q AS ({_QTERMS}), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
 sc AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / a))), 6) AS score FROM tf JOIN q USING (term) JOIN df USING (term) JOIN dl USING (doc_id), st GROUP BY query_id, doc_id)
 SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc) WHERE rank <= 10"""
_POOL = f"SELECT *, CASE WHEN vec_id % 7 = 0 THEN NULL ELSE vec_id // 10 END AS page, vec_id // 50 AS doc FROM ({_RANK(40)})"
_JUDGED = f"""WITH v AS (SELECT vec_id, label FROM embeddings), qr AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, (b.vec_id % 3)::INT AS grade FROM v a JOIN v b USING (label) WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
 g AS (SELECT * FROM qr WHERE grade > 0), i AS (SELECT query_id, count(*) AS n, {', '.join(f"coalesce(sum(grade / log2(r + 1)) FILTER (r <= {k}), 0) AS i{k}" for k in KS)} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, doc_id) AS r FROM g) GROUP BY 1),
 h AS (SELECT query_id, {', '.join(f"coalesce(sum(grade / log2(rank + 1)) FILTER (rank <= {k}), 0) AS d{k}, count(*) FILTER (rank <= {k}) AS h{k}" for k in KS)} FROM (SELECT query_id, vec_id AS doc_id, rank FROM ({_RANK(10)}) WHERE query_id % 100 = 0) JOIN g USING (query_id, doc_id) GROUP BY 1)
 SELECT query_id, {', '.join(f"round(coalesce(h{k} / n, 0), 6) AS recall_{k}, round(coalesce(d{k} / nullif(i{k}, 0), 0), 6) AS ndcg_{k}" for k in KS)} FROM (SELECT DISTINCT query_id FROM qr) LEFT JOIN i USING (query_id) LEFT JOIN h USING (query_id)"""
SQL = {
    "knn_topk": _RANK(10),
    "knn_where_prefilter": _RANK(5, "label % 2 = 0"),
    "knn_label_capped": f"SELECT * FROM (SELECT query_id, vec_id, distance, label, row_number() OVER (PARTITION BY query_id, label ORDER BY distance, vec_id) AS rank FROM ({_RANK(40, keep='query_id, vec_id, distance, label')})) WHERE rank <= 3",
    "knn_page_dedup": f"SELECT query_id, vec_id, doc, page, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id, doc, page ORDER BY rank) AS nth FROM (SELECT *, CASE WHEN vec_id % 7 = 0 THEN NULL ELSE vec_id // 10 END AS page, vec_id // 50 AS doc FROM ({_RANK(40)}))) WHERE nth = 1 OR page IS NULL",
    "bm25_topk": _BM25,
    "rrf_fusion": _FUSE(_LISTS),
    "hybrid_rank": f"SELECT * FROM ({_FUSE(f'SELECT query_id, 0 AS step, vec_id AS doc_id, rank FROM ({_RANK(10)}) UNION ALL SELECT query_id, 1, doc_id, rank FROM ({_BM25})')}) WHERE final_rank <= 10",
    "knn_shaped": f"SELECT * FROM (SELECT query_id, vec_id, page, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id, doc, page ORDER BY rank) AS nth FROM ({_POOL}) WHERE vec_id % 4 IN (0, 1)) WHERE nth = 1 OR page IS NULL) WHERE rank <= 10",
    "rrf_final_ranks": f"WITH l AS (SELECT *, CASE WHEN query_id % 100 = 0 AND doc_id % 3 = 0 THEN 30 - rank END AS fr FROM ({_LISTS})), f AS (SELECT query_id, doc_id, round(sum(1.0 / (rank + 60)), 8) AS score, min(fr) AS react_final_rank, min(step * 100000 + rank) AS o, arg_min(step || ':' || doc_id, step * 100000 + rank) AS text FROM l GROUP BY 1, 2), g AS (SELECT *, bool_or(react_final_rank IS NOT NULL) OVER (PARTITION BY query_id) AS has_valid_final_results, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, o, doc_id) AS final_rank FROM f), s AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY CASE WHEN has_valid_final_results THEN react_final_rank END NULLS LAST, final_rank) AS selected FROM g WHERE NOT has_valid_final_results OR react_final_rank IS NOT NULL QUALIFY selected <= 5) SELECT g.* EXCLUDE (o), selected FROM g LEFT JOIN s USING (query_id, doc_id)",
    "rrf_by_scores": _FUSE(f"SELECT query_id, vec_id % 2 AS step, vec_id AS doc_id, row_number() OVER (PARTITION BY query_id, vec_id % 2 ORDER BY distance, vec_id) AS rank FROM ({_RANK(10)})"),
    "rerank_topk": f"WITH c AS (SELECT query_id, doc_id FROM ({_BM25})), t AS (SELECT doc_id, list_distinct({_TERMS}) AS w FROM documents WHERE text IS NOT NULL), sc AS (SELECT c.query_id, c.doc_id, round(len(list_intersect(q.w, t.w)) / len(q.w), 6) AS score FROM c JOIN t USING (doc_id) JOIN t q ON q.doc_id = c.query_id) SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc) WHERE rank <= 5",
    "beir_recall_ndcg": _JUDGED,
    "beir_means": f"SELECT count(*) AS n, {', '.join(f'round(avg({m}_{k}), 6) AS {m}_{k}' for m in ('recall', 'ndcg') for k in KS)} FROM ({_JUDGED})",
    "recall_hit_rate": f"SELECT count(*) AS n, round(avg(h1), 6) AS hit_1, round(avg(h5), 6) AS hit_5, round(avg(h10), 6) AS hit_10 FROM (SELECT query_id, max((label = q_label AND rank <= 1)::INT) AS h1, max((label = q_label AND rank <= 5)::INT) AS h5, max((label = q_label)::INT) AS h10 FROM ({_RANK(10, keep='query_id, rank, label, q_label')}) GROUP BY 1)",
}
