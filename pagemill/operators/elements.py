"""From pages to elements and client records: explode, collapse, reading order, images once, projections of results."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.functions import geometry as G
from pagemill.functions import text as T
from pagemill.operators.evaluate import fidelity_tier
from pagemill.runtime import prepare, table

# The content columns of a page in their order, the visual labels, the order of types at one place.
CONTENT = ("table", "chart", "infographic")
VISUAL = ("image", "chart", "infographic", "stamp")
TYPE_ORDER = ("text", "table", "chart", "infographic", "stamp")
#: Difference of an edge up to which two boxes are one.
TOLERANCE = 0.01
ITEM = "struct<text: string, caption: string, bbox: array<double>>"
IMAGE = "struct<label: string, text: string, caption: string, bbox: array<double>, source: string>"


def filled(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) != ""


def first_filled(*columns: Column) -> Column:
    """The first of the texts that isn't blank, as it is; null if there is none."""
    return F.coalesce(*[F.when(filled(c), c) for c in columns])


def whole(box: Column) -> Column:
    """The box if it has four numbers, else null."""
    return F.when((F.size(box) == 4) & ~F.exists(box, lambda v: v.isNull()), box)


def _near(a: Column, b: Column) -> Column:
    return F.coalesce(F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= TOLERANCE), lambda v: v), F.lit(False))


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def explode_page(pages: DataFrame, content: tuple[str, ...] = CONTENT) -> DataFrame:
    """One row for each element of a page, in reading order, in place of its text and content columns.

    pages: text, blocks array<struct<text, bbox>> (of the text layer or of reading; else the page's text counts as one), a
    column of ITEM lists for each content type, images (IMAGE list), and any other columns, which stay. New columns:
    content_type, bbox, element (its place in the row's lists). First the text blocks, then text and caption of each item,
    then visual images that match no item's box. Blank elements are left out; a page without any stays as it is.
    """
    rest = [c for c in pages.columns if c not in ("text", "blocks", "images", *content)]
    row = lambda kind, text, bbox: F.struct(kind.alias("content_type"), F.trim(text).alias("text"), whole(bbox).alias("bbox"))
    blocks = F.coalesce(F.when(F.size("blocks") > 0, F.col("blocks")), F.array(F.struct(F.col("text"), F.lit(None).cast("array<double>").alias("bbox"))))
    parts = [F.transform(blocks, lambda b: row(F.lit("text"), b.text, b.bbox))]
    both = lambda name: lambda i: F.array(row(F.lit(name), i.text, i.bbox), row(F.lit(f"{name}_caption"), i.caption, i.bbox))
    parts += [F.flatten(F.transform(F.coalesce(name, _empty(ITEM)), both(name))) for name in content]
    parts = [F.filter(p, lambda e: filled(e.text)) for p in parts]
    boxes = F.flatten(F.array(*[F.transform(F.coalesce(name, _empty(ITEM)), lambda i: whole(i.bbox)) for name in content]))
    alone = F.filter(F.coalesce("images", _empty(IMAGE)), lambda m: m.label.isin(*VISUAL) & whole(m.bbox).isNotNull() & ~F.exists(boxes, lambda b: _near(b, m.bbox)))
    parts.append(F.transform(alone, lambda m: row(m.label, F.coalesce(first_filled(m.text, m.caption), F.lit("")), m.bbox)))
    every = F.concat(*parts)
    kept = F.array(row(F.lit("text"), F.col("text"), F.lit(None).cast("array<double>")))
    x = pages.select(*rest, F.posexplode(F.when(F.size(every) > 0, every).otherwise(kept)).alias("element", "_e"))
    return x.select(*rest, "element", "_e.*")


def reading_order(elements: DataFrame, page: list[str], ordinal: str = "element") -> DataFrame:
    """With `place`, the number of each element in its page (source and page) from top to bottom and left to right, ties by
    type, then ordinal; elements without a box count as at the top left."""
    kind = F.element_at(F.create_map(*[F.lit(v) for i, t in enumerate(TYPE_ORDER) for v in (t, i)]), F.col("content_type"))
    at = lambda i: F.coalesce(F.get("bbox", F.lit(i)), F.lit(0.0))
    return elements.withColumn("place", F.row_number().over(W.partitionBy(*page).orderBy(at(1), at(0), F.coalesce(kind, F.lit(9)), ordinal)))


def first_owner(elements: DataFrame, page: list[str], value: str) -> DataFrame:
    """`value` stays on the first text element of a page only."""
    text = F.coalesce(F.col("content_type") == "text", F.lit(False))
    nth = F.row_number().over(W.partitionBy(*page, text).orderBy("place"))
    return elements.withColumn(value, F.when(text & (nth == 1), F.col(value)))


def images_once(elements: DataFrame, page: list[str]) -> DataFrame:
    """`images` without those that an earlier element of the page has: the same label, box to 4 places and source."""
    key = lambda m: F.struct(F.coalesce(m.label, F.lit("")), F.transform(whole(m.bbox), lambda v: F.round(v, 4)), F.coalesce(m.source, F.lit("")))
    x = elements.select(*page, "place", F.posexplode("images").alias("_i", "_m")).withColumn("_k", F.to_json(key(F.col("_m"))))
    first = x.withColumn("_n", F.row_number().over(W.partitionBy(*page, "_k").orderBy("place", "_i"))).where("_n = 1")
    kept = first.groupBy(*page, "place").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"]).alias("_kept"))
    return elements.join(kept, [*page, "place"], "left").withColumn("images", F.coalesce("_kept", _empty(IMAGE))).drop("_kept")


def collapse_page(pages: DataFrame, content: tuple[str, ...] = CONTENT) -> DataFrame:
    """The page's text with the texts and captions of its elements, blank ones skipped, a blank line between."""
    items = [F.flatten(F.transform(F.coalesce(name, _empty(ITEM)), lambda i: F.array(i.text, i.caption))) for name in content]
    every = F.filter(F.concat(F.array("text"), *items), filled)
    return pages.withColumn("text", F.array_join(F.transform(every, lambda x: F.trim(x)), "\n\n"))


def element_text(kind: Column, content: Column, table_text: Column, caption: Column, read: Column, said: Column, page_image: Column) -> Column:
    """The searchable text of an element by its document type; never an image's bytes."""
    return F.when(kind == "structured", table_text).when(kind == "image", F.when(page_image, read).otherwise(caption)).when(kind == "audio", said).otherwise(content)


def client_records(rows: DataFrame, need_embedding: bool = True) -> DataFrame:
    """(text, embedding, page_number, content_type, fidelity, source_id, source_name, image_only) of elements with text, or
    with an image if they have a vector.

    rows: text, content, meta_content, embedding, meta_page, page_number, meta_type, content_type, needs_ocr, page_image,
    source_path, path, source_id, image; a value of the metadata comes before the row's own.
    """
    text = first_filled(F.col("text"), F.col("content"), F.col("meta_content"))
    image_only = text.isNull() & filled(F.col("image")) & F.lit(need_embedding)
    kind = F.when(image_only, "image").otherwise(first_filled(F.col("meta_type"), F.col("content_type")))
    source = F.trim(first_filled(F.col("source_path"), F.col("path"), F.col("source_id")))
    fidelity = F.when(~image_only, fidelity_tier(kind, F.coalesce("needs_ocr", F.lit(False)), F.coalesce("page_image", F.lit(False))))
    r = rows.where(text.isNotNull() | image_only)
    if need_embedding:
        r = r.where("embedding is not null")
    return r.select(*[c for c in rows.columns if c.endswith("_key")], F.coalesce(text, F.lit("")).alias("text"), "embedding", F.coalesce("meta_page", "page_number").alias("page_number"), kind.alias("content_type"), fidelity.alias("fidelity"), source.alias("source_id"), F.regexp_extract(source, r"([^/\\]*)$", 1).alias("source_name"), image_only.alias("image_only"))


def compact(rows: DataFrame) -> DataFrame:
    """Results in short: (key, text, source_id, element_type, start, end, duration, page_number): media have times, all else a
    page. rows: key, text, source_id, element_type, start, end, duration, page_number."""
    media = F.coalesce(F.col("element_type").isin("audio", "video", "video_frame", "audio_visual"), F.lit(False)) | F.col("start").isNotNull() | F.col("end").isNotNull()
    length = F.when(F.col("start").isNotNull() & F.col("end").isNotNull(), F.greatest(F.lit(0.0), F.col("end") - F.col("start"))).otherwise(F.col("duration"))
    when = lambda c: F.when(media, c)
    return rows.select("key", "text", "source_id", "element_type", when(F.col("start")).alias("start"), when(F.col("end")).alias("end"), when(length).alias("duration"), F.when(~media, F.col("page_number")).alias("page_number"))


def evidence(hits: DataFrame) -> DataFrame:
    """Locator, citation, fidelity and score of each hit: by page, else segment, else time of a frame, else box. hits: key,
    text, source, page, segment_start, frame_time, bbox, content_type, score, distance."""
    src = F.regexp_replace(F.regexp_extract(F.coalesce("source", F.lit("")), r"([^/\\]*)$", 1), r"(?i)\.pdf$", "")
    at = lambda c: F.concat(src, F.lit(" @"), F.col(c).cast("string"))
    page = F.col("page").isNotNull()
    kind = F.when(page, "page").when(F.col("segment_start").isNotNull(), "segment").when(F.col("frame_time").isNotNull(), "timestamp").when(F.size("bbox") > 0, "bbox").otherwise("page")
    cite = F.when(page, F.concat(src, F.lit(" p."), F.col("page").cast("string"))).when(kind == "segment", at("segment_start")).when(kind == "timestamp", at("frame_time")).otherwise(src)
    tier = F.coalesce(fidelity_tier(F.coalesce("content_type", F.lit("text")), F.lit(False), F.lit(False)), F.lit("verbatim"))
    return hits.select("key", "text", src.alias("source"), kind.alias("locator"), cite.alias("citation"), tier.alias("fidelity"), F.coalesce("score", "distance", F.lit(0.0)).alias("score"))


def coverage(found: DataFrame, by: str) -> DataFrame:
    """Of the evidence of each query: sources seen, items ready to answer from, and what is thin about them."""
    ready = filled(F.col("text"))
    g = found.groupBy(by).agg(F.countDistinct(F.when(F.col("source") != "", F.col("source"))).alias("n_sources"), F.count_if(ready).alias("n_ready"), F.count_if(~ready).alias("n_omitted"), F.countDistinct(F.when(ready & (F.col("source") != ""), F.col("source"))).alias("_s"), F.bool_and(F.when(ready, F.col("fidelity") == "vlm_caption")).alias("_low"))
    thin = F.filter(F.array(F.when(F.col("n_ready") == 0, "no answer-ready text"), F.when((F.col("n_ready") > 0) & (F.col("_s") == 1), "single source"), F.when(F.col("_low"), "only low-fidelity evidence"), F.when((F.col("n_ready") > 0) & (F.col("n_omitted") > 0), "matches omitted")), lambda x: x.isNotNull())
    return g.select(by, "n_sources", "n_ready", "n_omitted", F.array_join(thin, "; ").alias("thin"))


def segments(rows: DataFrame, enabled: bool = True) -> DataFrame:
    """One row for each punctuation segment of a transcript (key, start, end, text), its times shifted by the chunk's start;
    without segments the chunk's own window. rows: key, text, chunk_start, duration, segments array<struct<start, end, text>>
    in seconds or milliseconds: the latter where a segment ends more than a second after the chunk does."""
    have = F.filter(F.coalesce("segments", _empty("struct<start: double, end: double, text: string>")), lambda g: filled(g.text))
    unit = F.when(F.array_max(F.transform(have, lambda g: g.end)) > F.col("duration") + 1, 1000.0).otherwise(1.0)
    own = F.array(F.struct(F.lit(0.0).alias("start"), F.col("duration").alias("end"), F.col("text").alias("text")))
    timed = F.transform(have, lambda g: F.struct((g.start / unit).alias("start"), (g.end / unit).alias("end"), F.trim(g.text).alias("text")))
    x = rows.select("key", "chunk_start", F.posexplode(F.when((F.size(have) > 0) & F.lit(enabled), timed).otherwise(own)).alias("segment", "g"))
    return x.select("key", "segment", (F.col("chunk_start") + F.col("g.start")).alias("start"), (F.col("chunk_start") + F.col("g.end")).alias("end"), F.col("g.text").alias("text"))


def tile_starts(length: Column, tile: int, overlap: float) -> Column:
    """Starts of tiles over a length, the last flush with its end."""
    stride = max(1, int(tile * (1 - overlap)))
    return F.when(length <= tile, F.array(F.lit(0))).otherwise(F.array_distinct(F.concat(F.sequence(F.lit(0), length - tile, F.lit(stride)), F.array(length - tile))))


def by_headings(text: Column) -> Column:
    """The sections of a Markdown text, each with its heading; blank ones are left out."""
    return F.filter(F.split(text, r"(?m)(?=^#{1,6} )"), filled)


def sub_queries(reply: Column, query: Column) -> Column:
    """The queries in a model's reply, a JSON list perhaps within a fence; the query itself if there is none."""
    listed = F.from_json(F.regexp_extract(reply, r"(?s)(\[.*\])", 1), "array<string>")
    some = F.filter(listed, filled)
    return F.when(F.size(some) > 0, F.transform(some, lambda x: F.trim(x))).otherwise(F.array(query))


def difference_hash(image: np.ndarray, side: int = 8) -> int:
    """64 bits of a grey image: whether each of side x (side + 1) areas is darker than the one to its right."""
    rows, cols = (np.linspace(0, n, k + 1).astype(int) for n, k in zip(image.shape, (side, side + 1)))
    cell = np.array([[image[a : max(b, a + 1), c : max(d, c + 1)].mean() for c, d in zip(cols, cols[1:])] for a, b in zip(rows, rows[1:])])
    bits = (cell[:, :-1] < cell[:, 1:]).ravel()
    return int(np.packbits(bits).view(">i8")[0])


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def merge_frames(frames: DataFrame, distance: int = 5, dropped: int = 2) -> DataFrame:
    """Runs of frames of a source that look alike: (source, frame, start, end, n) of each run's first frame.

    frames: source, frame, start, end, fps, hash. A frame joins the run if its hash is within `distance` bits of the hash of
    the run's head, and it starts within `dropped` frames of the end of the run's last one. A null hash is a run of its own.
    The walk depends on the head, so a source is walked in one task; its rows are numbers only.
    """
    prepare(frames.sparkSession)

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = []
        head, end = None, None
        for r in pdf.sort_values(["start", "frame"]).itertuples():
            h = None if pd.isna(r.hash) else int(r.hash) & (1 << 64) - 1
            rate = 1.0 if pd.isna(r.fps) or not r.fps else max(float(r.fps), 0.001)
            if head is not None and h is not None and (h ^ head).bit_count() <= distance and r.start - end <= dropped / rate:
                out[-1][3], out[-1][4] = max(out[-1][3], r.end), out[-1][4] + 1
            else:
                out.append([r.source, r.frame, r.start, r.end, 1])
                head = h
            end = r.end
        return pd.DataFrame(out, columns=["source", "frame", "start", "end", "n"])

    cols = [F.col(c) for c in ("source", "frame", "start", "end", "fps", "hash")]
    return frames.where("source is not null").select(*cols).groupBy("source").applyInPandas(walk, "source string, frame bigint, start double, end double, n bigint")


def drop_duplicates_by_box(rows: DataFrame, page: str, threshold: float = 0.45, structured_wins: bool = True) -> DataFrame:
    """Rows (id, kind, box and the page) without the images whose box is alike with that of a structured row of their page;
    with structured_wins off, without structured rows: each image takes the first such that is left."""
    images = rows.where("kind = 'image'").select(page, F.col("id").alias("image_id"), F.col("box").alias("a"))
    others = rows.where("kind = 'structured'").select(page, F.col("id").alias("other_id"), F.col("box").alias("b"))
    pairs = images.join(others, page).where(G.valid(F.col("a")) & G.valid(F.col("b"))).where(G.iou(F.col("a"), F.col("b")) >= threshold).select(page, "image_id", "other_id")
    if structured_wins:
        return rows.join(pairs.select(F.col("image_id").alias("id")).distinct(), "id", "left_anti")

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        gone: set = set()
        for _, g in pdf.sort_values(["image_id", "other_id"]).groupby("image_id"):
            left = [o for o in g["other_id"] if o not in gone]
            gone.update(left[:1])
        return pd.DataFrame({"id": sorted(gone)})

    return rows.join(pairs.groupBy(page).applyInPandas(greedy, "id bigint"), "id", "left_anti")


def table_markdown(words: DataFrame, by: str, header: bool = True) -> DataFrame:
    """Words with their row and column as a Markdown table each: (by, markdown). words: by, row, col, x, y, text; the words of
    a cell in lines of ten units, then from left to right. Rows and columns without text are left out."""
    w = words.where(filled(F.col("text"))).withColumn("_l", F.floor((F.col("y") - F.min("y").over(W.partitionBy(by, "row", "col"))) / 10))
    cell = w.groupBy(by, "row", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_l", "x", "text"))), lambda s: s.text), " ").alias("t"))
    cols = cell.groupBy(by).agg(F.array_sort(F.collect_set("col")).alias("cols"))
    line = cell.groupBy(by, "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "t"))).alias("m")).join(cols, by)
    line = line.select(by, "row", F.size("cols").alias("n"), F.concat(F.lit("| "), F.array_join(F.transform("cols", lambda c: F.coalesce(F.col("m")[c], F.lit(""))), " | "), F.lit(" |")).alias("t"))
    lines = line.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "t"))), lambda s: s.t).alias("ts"), F.max("n").alias("n"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.col("n")), " | "), F.lit(" |"))
    whole_ = F.concat(F.slice("ts", 1, 1), F.array(rule), F.slice("ts", 2, F.size("ts"))) if header else F.col("ts")
    return lines.select(by, F.array_join(whole_, "\n").alias("markdown"))


def _pages(s, d) -> DataFrame:
    """Chunks as pages, what was observed in them as their tables, charts and images."""
    text = table(s, d, "chunks").groupBy("chunk_id").agg(F.min("text").alias("text"), F.min("path").alias("path"))
    o = table(s, d, "observations").groupBy("observation_id").agg(F.min("chunk_id").alias("chunk_id"), F.min("text").alias("t"), F.min("model").alias("model"), F.min("bbox_xyxy_norm").alias("bbox"))
    k = F.col("observation_id") % 3
    item = F.struct("observation_id", F.struct(F.col("t").alias("text"), F.when(F.col("observation_id") % 2 == 0, F.col("model")).alias("caption"), "bbox").alias("i"))
    label = F.when(F.col("observation_id") % 4 == 0, "photo").otherwise("image")
    image = F.struct("observation_id", F.struct(label.alias("label"), F.lit("").alias("text"), F.col("model").alias("caption"), F.when(k == 0, F.transform("bbox", lambda v: v + 0.002)).otherwise(F.col("bbox")).alias("bbox"), F.lit("x").alias("source")).alias("i"))
    listed = lambda c: F.transform(F.array_sort(F.collect_list(c)), lambda x: x.i)
    g = o.groupBy("chunk_id").agg(listed(F.when(k == 0, item)).alias("table"), listed(F.when(k == 1, item)).alias("chart"), listed(F.when(k != 1, image)).alias("images"))
    return text.join(g, "chunk_id", "left").withColumn("infographic", _empty(ITEM)).withColumn("blocks", _empty("struct<text: string, bbox: array<double>>"))


def page_elements(s, d):
    x = reading_order(explode_page(_pages(s, d)), ["chunk_id"])
    return x.select("chunk_id", "place", "content_type", F.md5("text").alias("text_md5"), F.col("bbox").isNotNull().alias("has_box"))


def page_collapse(s, d):
    return collapse_page(_pages(s, d)).select("chunk_id", F.md5("text").alias("text_md5"))


def _last_chunks(s, d) -> DataFrame:
    c = table(s, d, "chunks")
    return c.groupBy("chunk_id").agg(F.max_by(F.struct(*[x for x in c.columns if x != "chunk_id"]), "ingested_at").alias("c")).select("chunk_id", "c.*")


def client_record_projection(s, d):
    c = _last_chunks(s, d).join(table(s, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding"), "chunk_id", "left")
    none = F.lit(None).cast("string")
    r = c.select(F.col("chunk_id").alias("chunk_key"), "text", none.alias("content"), F.col("source_name").alias("meta_content"), "embedding", F.when(F.col("page_number") >= 0, F.col("page_number")).alias("meta_page"), F.col("metadata.chunk_index").alias("page_number"), F.col("metadata.content_metadata.type").alias("meta_type"), "content_type", F.lit(False).alias("needs_ocr"), F.lit(False).alias("page_image"), F.col("metadata.source_path").alias("source_path"), "path", "source_id", F.when(F.col("chunk_id") % 2 == 0, "uri").alias("image"))
    x = client_records(r, False)
    return x.select(F.col("chunk_key").alias("chunk_id"), F.md5("text").alias("text_md5"), "page_number", "content_type", "fidelity", "source_id", "source_name")


def compact_projection(s, d):
    e = table(s, d, "events")
    kind = F.expr("case event_type when 'click' then 'audio' when 'view' then 'text' when 'error' then 'video' else 'image' end")
    r = e.select(F.col("event_id").alias("key"), F.col("props").alias("text"), F.col("user_id").cast("string").alias("source_id"), kind.alias("element_type"), F.when(F.col("event_type") == "click", F.col("value")).alias("start"), F.when(F.col("event_type") == "click", F.expr("double(event_id % 100)")).alias("end"), F.expr("double(event_id % 7)").alias("duration"), F.expr("int(event_id % 30)").alias("page_number"))
    return compact(r).select("key", "element_type", F.round("start", 4).alias("start"), F.round("end", 4).alias("end"), F.round("duration", 4).alias("duration"), "page_number")


def _seen(s, d) -> DataFrame:
    o = table(s, d, "observations").groupBy("observation_id").agg(F.min("chunk_id").alias("chunk_id"), F.min("text").alias("text"), F.min("bbox_xyxy_norm").alias("bbox"), F.min("score").alias("score"))
    c = table(s, d, "chunks").groupBy("chunk_id").agg(F.min("path").alias("source"), F.min("page_number").alias("p"), F.min("content_type").alias("content_type"), F.min("source_name").alias("site"))
    k = F.col("observation_id") % 5
    return o.join(c, "chunk_id").select(F.col("observation_id").alias("key"), "text", "source", F.when((k < 2) & (F.col("p") >= 0), F.col("p")).alias("page"), F.when(k == 2, k).alias("segment_start"), F.when(k == 3, k).alias("frame_time"), "bbox", "content_type", "score", F.when(F.col("key") % 2 == 0, 0.5).alias("distance"), "site")


def evidence_items(s, d):
    return evidence(_seen(s, d)).drop("text").withColumn("score", F.round("score", 6))


def evidence_coverage(s, d):
    e = evidence(_seen(s, d)).join(_seen(s, d).select("key", "site"), "key")
    return coverage(e, "site")


def table_reconstruct(s, d):
    li = table(s, d, "lineitem").withColumn("n", F.row_number().over(W.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey")))
    words = li.select("l_orderkey", F.expr("int(l_linenumber)").alias("row"), F.expr("int(l_partkey % 3)").alias("col"), F.col("n").cast("double").alias("x"), F.expr("double(n * 7)").alias("y"), F.concat("l_returnflag", F.col("l_suppkey").cast("string")).alias("text"))
    return table_markdown(words, "l_orderkey").select("l_orderkey", F.md5("markdown").alias("markdown_md5"))


def box_duplicates_across_rows(s, d):
    from pagemill.operators.geometric import _boxes

    b = _boxes(s, d).where("family <> 'text'")
    rows = b.select(F.expr("record_id * 1000 + pos * 2 + int(family = 'images')").alias("id"), F.when(F.col("family") == "images", "image").otherwise("structured").alias("kind"), F.col("b").alias("box"), "record_id")
    return drop_duplicates_by_box(rows, "record_id", 0.1).select("id", "record_id", "kind")


QUERIES = {f.__name__: f for f in (page_elements, page_collapse, client_record_projection, compact_projection, evidence_items, evidence_coverage, table_reconstruct, box_duplicates_across_rows)}

_O = "SELECT observation_id, min(chunk_id) AS chunk_id, min(text) AS t, min(model) AS model, min(bbox_xyxy_norm) AS bbox, min(score) AS score FROM observations GROUP BY 1"
_BOX = "CASE WHEN len(bbox) = 4 THEN bbox END"
_EL = f"""WITH o AS ({_O}), c AS (SELECT chunk_id, min(text) AS text FROM chunks GROUP BY 1),
 i AS (SELECT chunk_id, 0 AS part, 0 AS oid, 0 AS f, 'text' AS content_type, trim(text, ' ') AS text, NULL::DOUBLE[] AS bbox FROM c
  UNION ALL SELECT chunk_id, 1 + observation_id % 3, observation_id, 0, CASE observation_id % 3 WHEN 0 THEN 'table' ELSE 'chart' END, trim(t, ' '), {_BOX} FROM o WHERE observation_id % 3 < 2
  UNION ALL SELECT chunk_id, 1 + observation_id % 3, observation_id, 1, CASE observation_id % 3 WHEN 0 THEN 'table_caption' ELSE 'chart_caption' END, trim(model, ' '), {_BOX} FROM o WHERE observation_id % 3 < 2 AND observation_id % 2 = 0),
 m AS (SELECT chunk_id, 3 AS part, observation_id AS oid, 0 AS f, 'image' AS content_type, coalesce(CASE WHEN trim(model, ' ') <> '' THEN trim(model, ' ') END, '') AS text, CASE WHEN observation_id % 3 = 0 THEN list_transform(bbox, lambda v: v + 0.002) ELSE bbox END AS bbox FROM o WHERE observation_id % 3 <> 1 AND observation_id % 4 <> 0 AND len(bbox) = 4),
 e AS (SELECT * FROM i WHERE coalesce(text, '') <> '' UNION ALL SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.chunk_id = m.chunk_id AND o.observation_id % 3 < 2 AND len(o.bbox) = 4 AND list_bool_and(list_transform([1, 2, 3, 4], lambda k: abs(o.bbox[k] - m.bbox[k]) <= 0.01)))),
 a AS (SELECT * FROM e WHERE chunk_id IN (SELECT chunk_id FROM c) UNION ALL SELECT chunk_id, 0, 0, 0, 'text', trim(text, ' '), NULL FROM c WHERE chunk_id NOT IN (SELECT chunk_id FROM e))"""
_C = "SELECT chunk_id, unnest(arg_max({'text': text, 'path': path, 'source_id': source_id, 'source_name': source_name, 'page_number': page_number, 'content_type': content_type, 'ci': metadata.chunk_index, 'sp': metadata.source_path, 'mt': metadata.content_metadata.type}, ingested_at)) FROM chunks GROUP BY 1"
_FULL = lambda c: f"coalesce(trim({c}, ' '), '') <> ''"
_TIER = lambda t: f"CASE WHEN lower({t}) IN ('audio', 'video', 'video_frame') THEN 'transcribed' WHEN lower({t}) = 'image' THEN 'vlm_caption' WHEN regexp_matches(lower({t}), '^(table|chart|infographic)') THEN 'ocr' WHEN lower({t}) = 'text' THEN 'verbatim' END"
_BASE = lambda c: f"regexp_extract({c}, '([^/\\\\]*)$', 1)"
_FOUND = f"""SELECT observation_id AS key, t AS text, site, src AS source, CASE WHEN page IS NOT NULL THEN 'page' WHEN k = 2 THEN 'segment' WHEN k = 3 THEN 'timestamp' WHEN len(bbox) > 0 THEN 'bbox' ELSE 'page' END AS locator, CASE WHEN page IS NOT NULL THEN src || ' p.' || page WHEN k = 2 OR k = 3 THEN src || ' @' || k ELSE src END AS citation, coalesce({_TIER("coalesce(content_type, 'text')")}, 'verbatim') AS fidelity, round(coalesce(score, CASE WHEN observation_id % 2 = 0 THEN 0.5 END, 0), 6) AS score
 FROM (SELECT o.*, content_type, site, observation_id % 5 AS k, CASE WHEN observation_id % 5 < 2 AND p >= 0 THEN p END AS page, regexp_replace({_BASE("coalesce(path, '')")}, '(?i)\\.pdf$', '') AS src FROM ({_O}) o JOIN (SELECT chunk_id, min(path) AS path, min(page_number) AS p, min(content_type) AS content_type, min(source_name) AS site FROM chunks GROUP BY 1) USING (chunk_id))"""
SQL = {
    "page_elements": f"{_EL} SELECT chunk_id, row_number() OVER (PARTITION BY chunk_id ORDER BY coalesce(bbox[2], 0), coalesce(bbox[1], 0), CASE content_type WHEN 'text' THEN 0 WHEN 'table' THEN 1 WHEN 'chart' THEN 2 ELSE 9 END, part, oid, f) AS place, content_type, md5(text) AS text_md5, bbox IS NOT NULL AS has_box FROM a",
    "page_collapse": f"{_EL} SELECT chunk_id, md5(coalesce(string_agg(i.text, chr(10) || chr(10) ORDER BY part, oid, f) FILTER (coalesce(i.text, '') <> ''), '')) AS text_md5 FROM c LEFT JOIN i USING (chunk_id) GROUP BY 1",
    "client_record_projection": f"SELECT chunk_id, md5(t) AS text_md5, coalesce(CASE WHEN page_number >= 0 THEN page_number END, ci) AS page_number, k AS content_type, {_TIER('k')} AS fidelity, s AS source_id, {_BASE('s')} AS source_name FROM (SELECT *, CASE WHEN {_FULL('text')} THEN text ELSE source_name END AS t, CASE WHEN {_FULL('mt')} THEN mt WHEN {_FULL('content_type')} THEN content_type END AS k, trim(CASE WHEN {_FULL('sp')} THEN sp WHEN {_FULL('path')} THEN path WHEN {_FULL('source_id')} THEN source_id END, ' ') AS s FROM ({_C})) WHERE {_FULL('t')}",
    "compact_projection": "SELECT event_id AS key, k AS element_type, CASE WHEN m THEN round(s, 4) END AS start, CASE WHEN m THEN round(e, 4) END AS \"end\", CASE WHEN m THEN round(CASE WHEN s IS NOT NULL AND e IS NOT NULL THEN greatest(0, e - s) ELSE event_id % 7 END, 4) END AS duration, CASE WHEN NOT m THEN (event_id % 30)::INT END AS page_number FROM (SELECT *, k IN ('audio', 'video') OR s IS NOT NULL OR e IS NOT NULL AS m FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'audio' WHEN 'view' THEN 'text' WHEN 'error' THEN 'video' ELSE 'image' END AS k, CASE WHEN event_type = 'click' THEN value END AS s, CASE WHEN event_type = 'click' THEN (event_id % 100)::DOUBLE END AS e FROM events))",
    "evidence_items": f"SELECT * EXCLUDE (text, site) FROM ({_FOUND})",
    "evidence_coverage": f"SELECT site, count(DISTINCT source) FILTER (source <> '') AS n_sources, count_if(r) AS n_ready, count_if(NOT r) AS n_omitted, array_to_string(list_filter([CASE WHEN count_if(r) = 0 THEN 'no answer-ready text' END, CASE WHEN count_if(r) > 0 AND count(DISTINCT source) FILTER (r AND source <> '') = 1 THEN 'single source' END, CASE WHEN bool_and(fidelity = 'vlm_caption') FILTER (r) THEN 'only low-fidelity evidence' END, CASE WHEN count_if(r) > 0 AND count_if(NOT r) > 0 THEN 'matches omitted' END], lambda x: x IS NOT NULL), '; ') AS thin FROM (SELECT *, {_FULL('text')} AS r FROM ({_FOUND})) GROUP BY 1",
    "table_reconstruct": "WITH w AS (SELECT l_orderkey, l_linenumber::INT AS row, (l_partkey % 3)::INT AS col, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS n, l_returnflag || l_suppkey AS text FROM lineitem), l AS (SELECT *, floor((n * 7 - min(n * 7) OVER (PARTITION BY l_orderkey, row, col)) / 10) AS ln FROM w), c AS (SELECT l_orderkey, row, col, string_agg(text, ' ' ORDER BY ln, n, text) AS t FROM l GROUP BY 1, 2, 3), k AS (SELECT DISTINCT l_orderkey, col FROM c), r AS (SELECT l_orderkey, row, '| ' || string_agg(coalesce(t, ''), ' | ' ORDER BY col) || ' |' AS t FROM (SELECT DISTINCT l_orderkey, row FROM c) JOIN k USING (l_orderkey) LEFT JOIN c USING (l_orderkey, row, col) GROUP BY 1, 2), a AS (SELECT l_orderkey, list(t ORDER BY row) AS ts FROM r GROUP BY 1) SELECT l_orderkey, md5(array_to_string(list_concat([ts[1], '| ' || array_to_string(list_transform(range(n), lambda x: '---'), ' | ') || ' |'], ts[2:]), chr(10))) AS markdown_md5 FROM a JOIN (SELECT l_orderkey, count(*) AS n FROM k GROUP BY 1) USING (l_orderkey)",
}
