"""Ordered operators per group: gaps and islands, interval and nearest joins, bands, reading order, token windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.runtime import table


def merge_runs(df: DataFrame, by: list[str], start: str, end: str, gap: float, rate: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Runs of intervals whose start is within `gap` of the furthest end so far: (by, run_start, run_end, mid, n, keep).

    With `rate`, a column of units a second, the gap is in units of the first positive rate of the group, else of 1.
    `keep`: columns whose value in the run's first row stays. Rows with a null or blank key or a null start belong to no run
    and are left out; take them with `unmerged`.
    """
    df = df.where(_keyed(by, start))
    order = [start, end, *[c for c in keep or []]]
    w = W.partitionBy(*by).orderBy(*order)
    far = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    most = F.lit(gap)
    if rate is not None:
        every = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        most = F.lit(gap) / F.coalesce(F.first(F.when(F.col(rate) > 0, F.col(rate)), ignorenulls=True).over(every), F.lit(1.0))
    x = df.withColumn("_new", F.when(far.isNull() | (F.col(start) - far > most), 1).otherwise(0))
    x = x.withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    first = [F.min_by(c, F.struct(*order)).alias(c) for c in keep or []]
    r = x.groupBy(*by, "_run").agg(F.min(start).alias("run_start"), F.max(end).alias("run_end"), F.count("*").alias("n"), *first)
    return r.select(*by, "run_start", "run_end", ((F.col("run_start") + F.col("run_end")) / 2).alias("mid"), "n", *(keep or []))


def _keyed(by: list[str], start: str) -> Column:
    ok = F.col(start).isNotNull()
    for c in by:
        ok = ok & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return ok


def unmerged(df: DataFrame, by: list[str], start: str) -> DataFrame:
    return df.where(~_keyed(by, start))


def overlap_nearest(left: DataFrame, right: DataFrame, by: str, width: float) -> DataFrame:
    """For each left interval (id, start, end) the overlapping right one with the nearest middle, and how many overlap;
    touching counts; ties by the longer right text (if there is a column text), then right id; left rows without one stay.
    Both sides meet in time cells of the given width, not by all pairs of a key."""
    cells = lambda df: df.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    size = F.length("text") if "text" in right.columns else F.lit(0)
    r = cells(right.select(by, F.col("id").alias("right_id"), "start", "end", size.alias("size"))).select(by, "cell", "right_id", "size", F.col("start").alias("rs"), F.col("end").alias("re"))
    j = cells(left).join(r, [by, "cell"]).where("greatest(start, rs) <= least(end, re)")
    # a pair that shares several cells counts in the first of them
    j = j.where(F.col("cell") == F.floor(F.greatest("start", "rs") / width))
    near = F.struct(F.abs((F.col("start") + F.col("end")) - (F.col("rs") + F.col("re"))).alias("dist"), (-F.col("size")).alias("size"), "right_id")
    best = j.groupBy("id").agg(F.min(near).alias("m"), F.count("*").alias("n_right"))
    return left.join(best, "id", "left").select("id", by, F.col("m.right_id").alias("right_id"), F.coalesce("n_right", F.lit(0)).alias("n_right"))


#: Characters of a frame's text that a fused row keeps.
VISUAL = 100


def fused(audio: DataFrame, frames: DataFrame, by: str, width: float) -> DataFrame:
    """Each audio row (id, by, start, end, text) with the text of the frame that is nearest of those it overlaps, cut to
    VISUAL characters: (id, by, start, end, text, modality, n_frames). Audio without one stays as it is, blank audio or
    frames fuse with nothing, frames are gone."""
    said, seen = F.coalesce(F.trim("text"), F.lit("")) != "", F.trim("text")
    hit = overlap_nearest(audio.where(said).drop("text"), frames.where(said).withColumn("text", seen), by, width).where("right_id is not null")
    shown = frames.select(F.col("id").alias("right_id"), F.regexp_replace(F.substring(seen, 1, VISUAL), r"\s+$", "").alias("visual"))
    j = audio.join(hit.join(shown, "right_id").select("id", "visual", "n_right"), "id", "left")
    both = F.concat(F.lit("[AUDIO] "), F.trim("text"), F.lit(" | [VISUAL] "), F.col("visual"))
    return j.select("id", by, "start", "end", F.when(F.col("visual").isNotNull(), both).otherwise(F.col("text")).alias("text"), F.when(F.col("visual").isNotNull(), "audio_visual").otherwise("audio").alias("modality"), F.coalesce("n_right", F.lit(0)).alias("n_frames"))


def bands(df: DataFrame, by: list[str], value: str, gap: float) -> DataFrame:
    """A band starts where the value is more than `gap` above the one before: one-dimensional clusters of single link."""
    w = W.partitionBy(*by).orderBy(value)
    x = df.withColumn("_new", F.when(F.col(value) - F.lag(value).over(w) > gap, 1).otherwise(0))
    return x.withColumn("band", F.sum("_new").over(w.rangeBetween(W.unboundedPreceding, 0))).drop("_new")


def token_windows(text: Column, size: int, overlap: int) -> Column:
    """Windows of white-space tokens as an array of texts: step max(1, size - overlap), the last window ends the text."""
    if size <= 0:
        raise ValueError("size must be positive")
    step = max(1, size - overlap)

    def windows(t: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil((F.size(t) - size) / F.lit(step)).cast("int"))
        return F.when(F.size(t) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(t, i * step + 1, F.lit(size)), " ")))

    # the tokens are a lambda's variable, so that a text is split once and not once a window
    return F.element_at(F.transform(F.array(F.filter(F.split(text, r"\s+"), lambda x: x != "")), windows), 1)


_encodings: dict = {}


def _encoding(path: str):
    if path not in _encodings:
        from tokenizers import Tokenizer

        _encodings[path] = Tokenizer.from_file(path)
    return _encodings[path]


def tokenizer_windows(df: DataFrame, path: str, size: int = 1024, overlap: int = 0, text: str = "text") -> DataFrame:
    """The rows once for each window of `size` tokens of a tokenizer file, with chunk_index, chunk_count and the window's
    part of the text in place of it: cut at token borders, nothing changed. Step max(1, size - overlap), the last window
    ends the text, blank windows are dropped; a null or blank text gives no row."""
    if size <= 0:
        raise ValueError("size must be positive")
    step = max(1, size - overlap)
    fields = [f for f in df.schema.fields if f.name not in (text, "chunk_index", "chunk_count")]

    def of(batches):
        import pyarrow as pa

        t = _encoding(path)
        for batch in batches:
            at, n, i, out = [], [], [], []
            for row, x in enumerate(batch.column(batch.schema.get_field_index(text)).to_pylist()):
                if x and not x.isspace():
                    spans = t.encode(x, add_special_tokens=False).offsets
                    starts = range(0, max(1, len(spans) - size + step), step)
                    parts = [x[spans[a][0] : spans[min(a + size, len(spans)) - 1][1]] for a in starts] if spans else [x]
                    parts = [p for p in parts if p.strip()] or [x]
                    at += [row] * len(parts)
                    n += [len(parts)] * len(parts)
                    i += range(len(parts))
                    out += parts
            kept = batch.select([f.name for f in fields]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(i, pa.int32()), pa.array(n, pa.int32()), pa.array(out, pa.string())], names=[*[f.name for f in fields], "chunk_index", "chunk_count", text])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "chunk_index int", "chunk_count int", f"`{text}` string"])
    return df.mapInArrow(of, schema)


def _intervals(s, d) -> DataFrame:
    e = table(s, d, "events").where("user_id is not null and value is not null")
    return e.select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).withColumn("start", F.col("us") / 1_000_000.0).withColumn("end", F.col("start") + F.col("event_id") % 900)


def run_merge_gaps_islands(s, d):
    r = merge_runs(_intervals(s, d), ["user_id", "event_type"], "start", "end", 3600.0)
    return r.select("user_id", "event_type", F.round("run_start", 3).alias("run_start"), F.round("run_end", 3).alias("run_end"), F.round("mid", 3).alias("mid"), "n")


def interval_overlap_nearest(s, d):
    i = _intervals(s, d).withColumnRenamed("event_id", "id").select("id", "user_id", "start", "end", "event_type")
    return overlap_nearest(i.where("event_type = 'click'").drop("event_type"), i.where("event_type = 'view'").drop("event_type"), "user_id", 900.0)


def frame_run_merge(s, d):
    """Runs of equal texts of a source with the gap by its frame rate, null where it is unknown, first rows kept."""
    e = _intervals(s, d).withColumn("fps", F.when(F.col("event_id") % 3 > 0, F.col("user_id") % 4 + 0.5))
    r = merge_runs(e.withColumn("end", F.col("start") + F.col("event_id") % 600), ["user_id", "event_type"], "start", "end", 7200.0, "fps", ["event_id"])
    return r.select("user_id", "event_type", F.round("run_start", 3).alias("run_start"), F.round("run_end", 3).alias("run_end"), F.round("mid", 3).alias("mid"), "n", "event_id")


def audio_visual_fuse(s, d):
    i = _intervals(s, d).withColumnRenamed("event_id", "id").withColumn("text", F.concat("event_type", F.lit(" "), F.repeat(F.lit("x "), F.expr("int(id % 70)"))))
    audio, frames = i.where("event_type = 'click'").select("id", "user_id", "start", "end", "text"), i.where("event_type = 'view'").select("id", "user_id", "start", "end", F.when(F.col("id") % 5 > 0, F.col("text")).otherwise(" ").alias("text"))
    f = fused(audio, frames, "user_id", 900.0)
    return f.select("id", "user_id", F.md5("text").alias("text_md5"), "modality", "n_frames")


def prefix_start_seconds(s, d):
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, -1)
    return table(s, d, "events").select("event_id", "user_id", F.coalesce(F.sum(F.col("event_id") % 60).over(w), F.lit(0)).alias("chunk_start"))


def reading_order(s, d):
    o = table(s, d, "observations").groupBy("observation_id").agg(F.min("chunk_id").alias("chunk_id"), F.min("bbox_xyxy_norm").alias("b"))
    y, x = F.coalesce(F.get("b", F.lit(1)), F.lit(0.0)), F.coalesce(F.get("b", F.lit(0)), F.lit(0.0))
    return o.select("observation_id", "chunk_id", F.row_number().over(W.partitionBy("chunk_id").orderBy(y, x, "observation_id")).alias("place"))


def line_cluster_1d(s, d):
    o = table(s, d, "observations").groupBy("observation_id").agg(F.min("chunk_id").alias("chunk_id"), F.min("bbox_xyxy_norm").alias("b")).where("get(b, 1) is not null")
    b = bands(o.withColumn("y", F.get("b", F.lit(1))), ["chunk_id"], "y", 0.03)
    return b.groupBy("chunk_id", "band").agg(F.count("*").alias("n"), F.round(F.min("y"), 6).alias("top"), F.round(F.max("y"), 6).alias("bottom"))


def band_split(s, d):
    x = table(s, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    b = bands(x, ["l_suppkey"], "l_partkey", 1)
    return b.groupBy("l_suppkey", "band").agg(F.min("l_partkey").alias("first"), F.max("l_partkey").alias("last"))


def _chunked(s, d, size, overlap):
    t = table(s, d, "documents").where("text is not null")
    return t.select("doc_id", F.posexplode(token_windows(F.col("text"), size, overlap)).alias("chunk_index", "chunk")).select("doc_id", "chunk_index", F.md5("chunk").alias("chunk_md5"))


def token_chunks(s, d):
    return _chunked(s, d, 64, 0)


def token_chunks_overlap(s, d):
    return _chunked(s, d, 64, 16)


def chunk_explode_metadata(s, d):
    """Chunk rows with page_number as the place in the document, counts, and structured values on the first chunk only."""
    t = table(s, d, "documents").where("text is not null").withColumn("w", token_windows(F.col("text"), 128, 8))
    x = t.select("doc_id", "page_count", F.size("w").alias("chunk_count"), F.posexplode("w").alias("pos", "chunk"))
    return x.select("doc_id", (F.col("pos") + 1).alias("page_number"), "chunk_count", F.length("chunk").alias("n_chars"), F.when(F.col("pos") == 0, F.col("page_count")).alias("page_count"))


def markdown_page_render(s, d):
    """The texts of a file's pages in order, equal blocks once, unknown pages last."""
    c = table(s, d, "chunks").where("text is not null and trim(text) <> ''").select("path", F.when(F.col("page_number") > 0, F.col("page_number")).alias("page"), "chunk_id", F.trim("text").alias("t")).distinct()
    first = c.withColumn("n", F.row_number().over(W.partitionBy("path", "page", "t").orderBy("chunk_id"))).where("n = 1")
    page = first.groupBy("path", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_id", "t"))), lambda x: x.t), "\n\n").alias("md"))
    return page.select("path", "page", F.row_number().over(W.partitionBy("path").orderBy(F.asc_nulls_last("page"))).alias("place"), F.md5("md").alias("page_md5"))


QUERIES = {f.__name__: f for f in (run_merge_gaps_islands, frame_run_merge, interval_overlap_nearest, audio_visual_fuse, prefix_start_seconds, reading_order, line_cluster_1d, band_split, token_chunks, token_chunks_overlap, chunk_explode_metadata, markdown_page_render)}

_IV = "SELECT event_id, user_id, event_type, epoch_us(ts) / 1000000.0 AS s, epoch_us(ts) / 1000000.0 + event_id % 900 AS e FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL"
_OBS = "SELECT observation_id, min(chunk_id) AS chunk_id, min(bbox_xyxy_norm) AS b FROM observations GROUP BY 1"
_CH = lambda n, o: f"SELECT doc_id, i AS chunk_index, md5(array_to_string(t[i * {max(1, n - o)} + 1 : i * {max(1, n - o)} + {n}], ' ')) AS chunk_md5 FROM (SELECT doc_id, t, unnest(range(0, greatest(0, ceil((len(t) - {n}) / {float(max(1, n - o))}))::INT + 1))::INT AS i FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS t FROM documents WHERE text IS NOT NULL) WHERE len(t) > 0)"
SQL = {
    "run_merge_gaps_islands": f"SELECT user_id, event_type, round(min(s), 3) AS run_start, round(max(e), 3) AS run_end, round((min(s) + max(e)) / 2, 3) AS mid, count(*) AS n FROM (SELECT *, sum(f) OVER (PARTITION BY user_id, event_type ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN m IS NULL OR s - m > 3600 THEN 1 ELSE 0 END AS f FROM (SELECT *, max(e) OVER (PARTITION BY user_id, event_type ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM ({_IV})))) GROUP BY user_id, event_type, run",
    "interval_overlap_nearest": f"WITH i AS ({_IV}), c AS (SELECT * FROM i WHERE event_type = 'click'), v AS (SELECT * FROM i WHERE event_type = 'view') SELECT c.event_id AS id, c.user_id, arg_min(v.event_id, {{'d': abs((c.s + c.e) - (v.s + v.e)), 'i': v.event_id}}) AS right_id, count(v.event_id) AS n_right FROM c LEFT JOIN v ON c.user_id = v.user_id AND greatest(c.s, v.s) <= least(c.e, v.e) GROUP BY 1, 2",
    "frame_run_merge": f"WITH i AS (SELECT * EXCLUDE (e), s + event_id % 600 AS e, CASE WHEN event_id % 3 > 0 THEN user_id % 4 + 0.5 END AS fps FROM ({_IV})), g AS (SELECT user_id, event_type, coalesce(arg_min(fps, {{'s': s, 'e': e, 'i': event_id}}) FILTER (fps > 0), 1.0) AS rate FROM i GROUP BY 1, 2) SELECT user_id, event_type, round(min(s), 3) AS run_start, round(max(e), 3) AS run_end, round((min(s) + max(e)) / 2, 3) AS mid, count(*) AS n, arg_min(event_id, {{'s': s, 'e': e, 'i': event_id}}) AS event_id FROM (SELECT *, sum(f) OVER (PARTITION BY user_id, event_type ORDER BY s, e, event_id ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN m IS NULL OR s - m > 7200.0 / rate THEN 1 ELSE 0 END AS f FROM (SELECT i.*, rate, max(e) OVER (PARTITION BY user_id, event_type ORDER BY s, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM i JOIN g USING (user_id, event_type)))) GROUP BY user_id, event_type, run",
    "audio_visual_fuse": f"WITH i AS (SELECT *, event_type || ' ' || repeat('x ', (event_id % 70)::INT) AS t FROM ({_IV})), c AS (SELECT * FROM i WHERE event_type = 'click'), v AS (SELECT * EXCLUDE (t), trim(t, ' ') AS t FROM i WHERE event_type = 'view' AND event_id % 5 > 0), m AS (SELECT c.event_id AS id, c.user_id, any_value(c.t) AS a, arg_min(v.t, {{'d': abs((c.s + c.e) - (v.s + v.e)), 'n': -length(v.t), 'i': v.event_id}}) AS b, count(v.event_id) AS n_frames FROM c LEFT JOIN v ON c.user_id = v.user_id AND greatest(c.s, v.s) <= least(c.e, v.e) GROUP BY 1, 2) SELECT id, user_id, md5(CASE WHEN b IS NULL THEN a ELSE '[AUDIO] ' || trim(a, ' ') || ' | [VISUAL] ' || rtrim(b[1:100], ' ') END) AS text_md5, CASE WHEN b IS NULL THEN 'audio' ELSE 'audio_visual' END AS modality, n_frames FROM m",
    "prefix_start_seconds": "SELECT event_id, user_id, coalesce(sum(event_id % 60) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS chunk_start FROM events",
    "reading_order": f"SELECT observation_id, chunk_id, row_number() OVER (PARTITION BY chunk_id ORDER BY coalesce(b[2], 0), coalesce(b[1], 0), observation_id) AS place FROM ({_OBS})",
    "line_cluster_1d": f"SELECT chunk_id, band, count(*) AS n, round(min(y), 6) AS top, round(max(y), 6) AS bottom FROM (SELECT *, sum(f) OVER (PARTITION BY chunk_id ORDER BY y)::BIGINT AS band FROM (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY chunk_id ORDER BY y) > 0.03 THEN 1 ELSE 0 END AS f FROM (SELECT chunk_id, b[2] AS y FROM ({_OBS}) WHERE b[2] IS NOT NULL))) GROUP BY 1, 2",
    "band_split": "SELECT l_suppkey, band, min(p) AS first, max(p) AS last FROM (SELECT *, sum(f) OVER (PARTITION BY l_suppkey ORDER BY p)::BIGINT AS band FROM (SELECT l_suppkey, p, CASE WHEN p - lag(p) OVER (PARTITION BY l_suppkey ORDER BY p) > 1 THEN 1 ELSE 0 END AS f FROM (SELECT DISTINCT l_suppkey, l_partkey AS p FROM lineitem))) GROUP BY 1, 2",
    "token_chunks": _CH(64, 0),
    "token_chunks_overlap": _CH(64, 16),
    "chunk_explode_metadata": "SELECT doc_id, (i + 1)::INT AS page_number, n::INT AS chunk_count, length(array_to_string(t[i * 120 + 1 : i * 120 + 128], ' '))::INT AS n_chars, CASE WHEN i = 0 THEN page_count END AS page_count FROM (SELECT *, unnest(range(0, n)) AS i FROM (SELECT *, greatest(0, ceil((len(t) - 128) / 120.0))::INT + 1 AS n FROM (SELECT doc_id, page_count, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS t FROM documents WHERE text IS NOT NULL) WHERE len(t) > 0))",
    "markdown_page_render": "SELECT path, page, row_number() OVER (PARTITION BY path ORDER BY page NULLS LAST) AS place, md5(md) AS page_md5 FROM (SELECT path, page, string_agg(t, chr(10) || chr(10) ORDER BY chunk_id) AS md FROM (SELECT path, page, t, min(chunk_id) AS chunk_id FROM (SELECT path, CASE WHEN page_number > 0 THEN page_number END AS page, chunk_id, trim(text, ' ') AS t FROM chunks WHERE text IS NOT NULL AND trim(text, ' ') <> '') GROUP BY 1, 2, 3) GROUP BY 1, 2)",
}
