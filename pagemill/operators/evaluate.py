"""Scores of answers and their roll-ups, percentiles, and projections of retrieval results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.runtime import table

def fidelity_tier(content_type: Column, needs_ocr: Column, page_image: Column) -> Column:
    """How close an element's text is to its source."""
    t = F.lower(content_type)
    return (
        F.when(t.isin("audio", "video", "video_frame"), "transcribed")
        .when(t == "image", F.when(page_image, "ocr").otherwise("vlm_caption"))
        .when(t.rlike("^(table|chart|infographic)"), "ocr")
        .when(t == "text", F.when(needs_ocr, "ocr").otherwise("verbatim"))
    )


def content_types(spec: str, aliases: dict[str, str] | None = None) -> list[str]:
    """An allow-list from comma-separated names with aliases, a caption's being its base type; an empty one is an error."""
    aliases = {"images": "image", "tables": "table", "charts": "chart", "texts": "text"} | (aliases or {})
    names = [aliases.get(x, x) for x in (y.strip().lower().removesuffix("_caption") for y in spec.split(",")) if x]
    if not names:
        raise ValueError("no content type is left")
    return sorted(set(names))


def _pairs(s, d) -> DataFrame:
    """Answers to score: each text a model read in a chunk, once, against the chunk's text."""
    o = table(s, d, "observations").where("text is not null and trim(text) <> ''").groupBy("observation_id").agg(F.min(F.struct("chunk_id", "text", "model", "score", "error")).alias("o")).select("observation_id", "o.chunk_id", F.col("o.text").alias("answer"), "o.model", "o.score", "o.error")
    c = table(s, d, "chunks").where("text is not null and trim(text) <> ''").groupBy("chunk_id").agg(F.min("text").alias("reference"))
    return o.join(c, "chunk_id")


def answer_normalise(s, d):
    return _pairs(s, d).select("observation_id", F.md5(T.comparable(T.without_thinking(F.col("answer")))).alias("answer_md5"))


def token_f1(s, d):
    return _pairs(s, d).select("observation_id", T.token_scores(F.col("answer"), F.col("reference")).alias("t")).select("observation_id", "t.*")


def answer_in_context_share(s, d):
    p = _pairs(s, d).withColumn("ok", T.answer_in_context(F.col("answer"), F.col("reference")))
    return p.groupBy("model").agg(F.count("*").alias("n"), F.round(F.avg(F.col("ok").cast("int")), 6).alias("share"))


def failure_mode_breakdown(s, d):
    """The answer stands for the reference answer, the chunk for the context; only those whose mode depends on it are compared."""
    needed = T.by_context(F.col("score"), F.col("error"), F.col("answer"))
    p = _pairs(s, d).withColumn("ok", T.answer_in_context(F.when(needed, F.col("answer")), F.when(needed, F.col("reference"))))
    mode = T.failure_mode(F.col("ok"), F.col("score"), F.col("error"), F.col("answer"))
    return p.groupBy("model", mode.alias("mode")).agg(F.count("*").alias("n"))


def qa_rollup(s, d):
    o = table(s, d, "observations").groupBy("observation_id").agg(F.min("model").alias("model"), F.min("score").alias("score"), F.max(F.col("error").isNotNull()).alias("failed"))
    step = F.round(F.col("score") * 4) / 4
    return o.groupBy("model").agg(F.round(F.avg("score"), 4).alias("mean_score"), *[F.count_if(step == v).alias(f"n_{int(v * 100)}") for v in (0.0, 0.25, 0.5, 0.75, 1.0)], F.count_if("failed").alias("n_failed"))


def language_metric_rollup(s, d):
    t = table(s, d, "documents").where("text is not null").withColumn("l", F.lower(F.trim("lang")))
    r = t.rollup("l").agg(F.count("*").alias("n"), F.round(F.avg(F.length("text")), 4).alias("mean_chars"), F.grouping("l").alias("overall"))
    return r.select(F.when(F.col("overall") == 1, "overall").otherwise(F.coalesce("l", F.lit("unlabelled"))).alias("language"), "n", "mean_chars")


def latency_percentiles(s, d):
    return table(s, d, "events").groupBy("event_type").agg(F.round(F.percentile("value", F.lit(0.5)), 3).alias("p50"), F.round(F.percentile("value", F.lit(0.95)), 3).alias("p95"))


def fidelity_tiers(s, d):
    c = table(s, d, "chunks").groupBy("chunk_id").agg(F.min("content_type").alias("t"), F.min("page_number").alias("p"))
    tier = fidelity_tier(F.lower("t"), F.coalesce(F.col("p"), F.lit(-1)) < 0, F.lit(False))
    return c.groupBy(tier.alias("tier")).agg(F.count("*").alias("n"))


def content_type_filter(s, d):
    c = table(s, d, "chunks").select("chunk_id", F.lower(F.trim("content_type")).alias("content_type"))
    return c.where(F.col("content_type").isin(content_types(" Table, images"))).distinct()


def hit_normalise(s, d):
    c = table(s, d, "chunks").select("chunk_id", T.path_stem(F.col("metadata.source_path")).alias("pdf_basename"), F.when(F.col("page_number") >= 0, F.col("page_number")).alias("page")).distinct()
    return c.select("chunk_id", "pdf_basename", F.concat_ws("_", "pdf_basename", "page").alias("pdf_page"))


def evidence_projection(s, d):
    """Locator and citation of each chunk: page, then box, else the file alone; score 0 where nothing was scored."""
    o = table(s, d, "observations").groupBy("chunk_id").agg(F.round(F.max("score"), 6).alias("score"))
    c = table(s, d, "chunks").groupBy("chunk_id").agg(F.min("path").alias("path"), F.min("page_number").alias("p"))
    cite = F.when(F.col("p") >= 0, F.concat(T.path_stem(F.col("path")), F.lit(" p."), F.col("p").cast("string"))).otherwise(T.path_stem(F.col("path")))
    return c.join(o, "chunk_id", "left").select("chunk_id", cite.alias("citation"), F.coalesce("score", F.lit(0.0)).alias("score"))


def audio_recall(s, d):
    """Golden segments hit by the middle of a retrieved one strictly within two seconds of their ends; retrieved rows meet
    them in cells of ten seconds."""
    e = table(s, d, "events").where("user_id is not null").select("event_id", "user_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000.0).alias("t"))
    gold = e.where("event_type = 'purchase'").select("event_id", "user_id", (F.col("t") - 2).alias("lo"), (F.col("t") + 300 + 2).alias("hi"))
    got = e.where("event_type = 'click'").select("user_id", (F.col("t") + 20).alias("mid"))
    g = gold.withColumn("cell", F.explode(F.expr("sequence(bigint(floor(lo / 60)), bigint(floor(hi / 60)))")))
    hit = g.join(got.withColumn("cell", F.floor(F.col("mid") / 60)), ["user_id", "cell"]).where("mid > lo and mid < hi").select("event_id").distinct().withColumn("hit", F.lit(1))
    return gold.join(hit, "event_id", "left").agg(F.count("*").alias("n"), F.round(F.avg(F.coalesce("hit", F.lit(0))), 6).alias("recall"))


QUERIES = {f.__name__: f for f in (answer_normalise, token_f1, answer_in_context_share, failure_mode_breakdown, qa_rollup, language_metric_rollup, latency_percentiles, fidelity_tiers, content_type_filter, hit_normalise, evidence_projection, audio_recall)}

_TAGS = lambda c: f"trim(regexp_replace(regexp_replace({c}, '<think>.*?</think>', '', 'gs'), '<think>.*', '', 's'), ' ')"
_NUMBERS = lambda c: f"regexp_replace(regexp_replace(regexp_replace({c}, ',([0-9]{{3}})', '\\1', 'g'), '([0-9]+\\.[0-9]*[1-9])0*', '\\1', 'g'), '([0-9]+)\\.0+([^0-9]|$)', '\\1\\2', 'g')"
# no lookaround here: twice, since neighbouring articles share a boundary
_DROP = lambda c: f"regexp_replace({c}, '(^|[^\\p{{L}}\\p{{N}}_])(a|an|the)($|[^\\p{{L}}\\p{{N}}_])', '\\1 \\3', 'g')"
_NORM = lambda c: f"trim(regexp_replace(replace(regexp_replace(regexp_replace({_DROP(_DROP(f'lower({_NUMBERS(c)})'))}, '([0-9])\\.([0-9])', '\\1\x01\\2', 'g'), '[!-/:-@\\[-`{{-~]', '', 'g'), '\x01', '.'), '[\\s\\p{{Z}}]+', ' ', 'g'), ' ')"
_PAIRS = "SELECT observation_id, model, score, error, o.text AS answer, reference FROM (SELECT observation_id, unnest(min({'chunk_id': chunk_id, 'text': text, 'model': model, 'score': score, 'error': error})) FROM observations WHERE text IS NOT NULL AND trim(text, ' ') <> '' GROUP BY 1) o JOIN (SELECT chunk_id, min(text) AS reference FROM chunks WHERE text IS NOT NULL AND trim(text, ' ') <> '' GROUP BY 1) c USING (chunk_id)"
_TOK = lambda c: f"list_filter(string_split({_NORM(c)}, ' '), lambda x: x <> '')"
_STOP = ", ".join(repr(x) for x in T.STOP)
_IN = f"SELECT *, len(a) = 0 OR len(list_filter(a, lambda x: list_contains(r, x))) / len(a) >= 0.5 AS ok FROM (SELECT *, list_filter({_TOK('answer')}, lambda x: x NOT IN ({_STOP})) AS a, list_distinct({_TOK('reference')}) AS r FROM ({_PAIRS}))"
_STEM = lambda c: f"regexp_replace(regexp_extract({c}, '([^/\\\\]*)$', 1), '\\.[^.]*$', '')"
SQL = {
    "answer_normalise": f"SELECT observation_id, md5({_NORM(_TAGS('answer'))}) AS answer_md5 FROM ({_PAIRS})",
    "token_f1": f"WITH p AS (SELECT observation_id, {_TOK(_TAGS('answer'))} AS a, {_TOK('reference')} AS r FROM ({_PAIRS})), x AS (SELECT observation_id, a, r, coalesce(list_sum(list_transform(list_distinct(a), lambda t: least(len(list_filter(a, lambda u: u = t)), len(list_filter(r, lambda u: u = t))))), 0) AS n FROM p) SELECT observation_id, array_to_string(a, ' ') = array_to_string(r, ' ') AS exact_match, " + ", ".join(f"CASE WHEN len(a) = 0 AND len(r) = 0 THEN 1.0::DOUBLE WHEN n = 0 THEN 0.0::DOUBLE ELSE round({v}, 4) END AS {k}" for k, v in (("f1", "2 * (n / len(a)) * (n / len(r)) / (n / len(a) + n / len(r))"), ("precision", "n / len(a)"), ("recall", "n / len(r)"))) + " FROM x",
    "answer_in_context_share": f"SELECT model, count(*) AS n, round(avg(ok::INT), 6) AS share FROM ({_IN}) GROUP BY 1",
    "failure_mode_breakdown": f"SELECT model, CASE WHEN error = 'thinking_truncated' THEN error WHEN score IS NULL THEN 'judge_error' WHEN score >= 0.75 THEN 'correct' WHEN regexp_matches(answer, '(?i){'|'.join(T.NO_CONTEXT)}') THEN CASE WHEN ok THEN 'refused_with_context' ELSE 'refused_missing_context' END WHEN score >= 0.25 THEN 'partial' WHEN ok THEN 'generation_miss' ELSE 'retrieval_miss' END AS mode, count(*) AS n FROM ({_IN}) GROUP BY 1, 2",
    "qa_rollup": "WITH o AS (SELECT observation_id, min(model) AS model, min(score) AS score, bool_or(error IS NOT NULL) AS failed FROM observations GROUP BY 1) SELECT model, round(avg(score), 4) AS mean_score, count_if(round(score * 4) / 4 = 0) AS n_0, count_if(round(score * 4) / 4 = 0.25) AS n_25, count_if(round(score * 4) / 4 = 0.5) AS n_50, count_if(round(score * 4) / 4 = 0.75) AS n_75, count_if(round(score * 4) / 4 = 1) AS n_100, count_if(failed) AS n_failed FROM o GROUP BY 1",
    "language_metric_rollup": "SELECT CASE WHEN grouping(l) = 1 THEN 'overall' ELSE coalesce(l, 'unlabelled') END AS language, count(*) AS n, round(avg(length(text)), 4) AS mean_chars FROM (SELECT lower(trim(lang, ' ')) AS l, text FROM documents WHERE text IS NOT NULL) GROUP BY ROLLUP (l)",
    "latency_percentiles": "SELECT event_type, round(quantile_cont(value, 0.5), 3) AS p50, round(quantile_cont(value, 0.95), 3) AS p95 FROM events GROUP BY 1",
    "fidelity_tiers": "SELECT CASE WHEN t IN ('audio', 'video') THEN 'transcribed' WHEN t = 'image' THEN 'vlm_caption' WHEN regexp_matches(t, '^(table|chart|infographic)') THEN 'ocr' WHEN t = 'text' THEN CASE WHEN coalesce(p, -1) < 0 THEN 'ocr' ELSE 'verbatim' END END AS tier, count(*) AS n FROM (SELECT lower(min(content_type)) AS t, min(page_number) AS p FROM chunks GROUP BY chunk_id) GROUP BY 1",
    "content_type_filter": "SELECT DISTINCT chunk_id, lower(trim(content_type, ' ')) AS content_type FROM chunks WHERE lower(trim(content_type, ' ')) IN ('table', 'image')",
    "hit_normalise": f"SELECT DISTINCT chunk_id, {_STEM('metadata.source_path')} AS pdf_basename, concat_ws('_', {_STEM('metadata.source_path')}, CASE WHEN page_number >= 0 THEN page_number END) AS pdf_page FROM chunks",
    "evidence_projection": f"SELECT chunk_id, CASE WHEN p >= 0 THEN {_STEM('path')} || ' p.' || p ELSE {_STEM('path')} END AS citation, coalesce(score, 0) AS score FROM (SELECT chunk_id, min(path) AS path, min(page_number) AS p FROM chunks GROUP BY 1) LEFT JOIN (SELECT chunk_id, round(max(score), 6) AS score FROM observations GROUP BY 1) USING (chunk_id)",
    "audio_recall": "WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) / 1000000.0 AS t FROM events WHERE user_id IS NOT NULL), g AS (SELECT event_id, user_id, t - 2 AS lo, t + 302 AS hi FROM e WHERE event_type = 'purchase') SELECT count(*) AS n, round(avg(CASE WHEN EXISTS (SELECT 1 FROM e c WHERE c.event_type = 'click' AND c.user_id = g.user_id AND c.t + 20 > lo AND c.t + 20 < hi) THEN 1 ELSE 0 END), 6) AS recall FROM g",
}
