"""Box operators on detections: anti join by overlap, unions, inclusion, assignment of words to cells, fusion per page."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.functions import geometry as G
from pagemill.operators.nested import nearby_objects
from pagemill.runtime import table


def drop_overlapping(df: DataFrame, boxes: str, others: str, threshold: float = 0.45) -> DataFrame:
    """Without the boxes that overlap one of the others in the row; no shuffle."""
    return df.withColumn(boxes, F.filter(F.col(boxes), lambda i: ~F.exists(F.col(others), lambda o: G.iou(i, o) >= threshold)))


def assign(words: DataFrame, cells: DataFrame, by: str, least: float = 0.25, delta: float = 2.0) -> DataFrame:
    """(word, cell) where a word's overlap with the cell, as a share of the word, is above `least` and at least the word's
    largest divided by delta."""
    j = words.join(cells, by).withColumn("share", G.contained(F.col("word_box"), F.col("cell_box")))
    top = F.max("share").over(W.partitionBy(by, "word"))
    return j.withColumn("top", top).where((F.col("top") > least) & (F.col("share") >= F.col("top") / delta)).select(by, "word", "cell", F.round("share", 6).alias("share"))


def _fused(boxes: list, scores: list, threshold: float, union: bool, most: bool) -> list[tuple[list, float, list[int]]]:
    """Clusters of boxes, greedily by score, each with its fused box, score and members."""
    clusters: list[dict] = []
    for i in sorted(range(len(boxes)), key=lambda i: (-scores[i], list(boxes[i]))):
        b, score = boxes[i], scores[i]
        best, at = threshold, None
        for c in clusters:
            m = c["box"]
            w, h = min(b[2], m[2]) - max(b[0], m[0]), min(b[3], m[3]) - max(b[1], m[1])
            n = max(w, 0) * max(h, 0)
            u = (b[2] - b[0]) * (b[3] - b[1]) + (m[2] - m[0]) * (m[3] - m[1]) - n
            if u > 0 and n / u > best:
                best, at = n / u, c
        if at is None:
            clusters.append({"box": list(b), "sum": [x * score for x in b], "w": score, "top": score, "of": [i]})
        else:
            at["sum"], at["w"] = [s + x * score for s, x in zip(at["sum"], b)], at["w"] + score
            at["top"], at["of"] = max(at["top"], score), at["of"] + [i]
            m = at["box"]
            at["box"] = [min(m[0], b[0]), min(m[1], b[1]), max(m[2], b[2]), max(m[3], b[3])] if union else [s / at["w"] for s in at["sum"]]
    return sorted(((c["box"], c["top"] if most else c["w"] / len(c["of"]), c["of"]) for c in clusters), key=lambda c: (-c[1], c[0]))


def fuse_boxes(df: DataFrame, threshold: float = 0.55, least: float = 0.0, union: bool = False, most: bool = False, by_label: bool = True) -> DataFrame:
    """Weighted boxes fusion per page, and per label unless by_label is off: (page, label, box, score), by falling score.

    Edges are clamped to 0..1 and put in order; boxes without area or with no score above `least` are dropped. A cluster's
    box is the mean weighted by score, or with `union` the box around all; its score the mean, or with `most` the highest;
    its label the one all have, else that of its highest score. Greedy by score, so per page in pandas; a page has few boxes.
    """

    def fuse(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for label, score, box in zip(pdf["label"], pdf["score"], pdf["box"]):
            x = [min(max(float(v), 0.0), 1.0) for v in box]
            b = [min(x[0], x[2]), min(x[1], x[3]), max(x[0], x[2]), max(x[1], x[3])]
            if b[2] > b[0] and b[3] > b[1]:
                rows.append((label, float(score), b))
        out = []
        for box, score, of in _fused([r[2] for r in rows], [r[1] for r in rows], threshold, union, most):
            out.append((pdf["page"].iloc[0], max((rows[i] for i in of), key=lambda r: r[1])[0], [float(x) for x in box], score))
        return pd.DataFrame(out, columns=["page", "label", "box", "score"])

    x = df.where(F.col("score") > least).where("size(box) = 4").select("page", "label", "box", "score")
    return x.groupBy(*["page", "label"][: 2 if by_label else 1]).applyInPandas(fuse, "page bigint, label string, box array<double>, score double")


def without_overlap(df: DataFrame) -> DataFrame:
    """Boxes of a page that hardly touch: twice fused to the box around all, at an overlap of a hundredth."""
    once = fuse_boxes(df, 0.01, union=True, most=True)
    return fuse_boxes(once, 0.01, union=True, most=True)


def _boxes(s, d) -> DataFrame:
    """Boxes of the records' nested objects, in either form: (record_id, family, pos, b)."""
    return nearby_objects(table(s, d, "extractions")).select("record_id", "family", "pos", F.col("bbox").alias("b")).where(G.valid(F.col("b")))


def bbox_iou_anti(s, d):
    b = _boxes(s, d)
    r = b.groupBy("record_id").agg(F.array_sort(F.collect_list(F.when(F.col("family") == "images", F.col("b")))).alias("images"), F.collect_list(F.when(F.col("family") == "structured", F.col("b"))).alias("structured"))
    return drop_overlapping(r, "images", "structured", 0.1).select("record_id", F.size("images").alias("n_images"), F.size("structured").alias("n_structured"))


def bbox_union(s, d):
    return _boxes(s, d).groupBy("record_id", "family").agg(*[f(F.col("b")[i]).alias(n) for i, (n, f) in enumerate((("x0", F.min), ("y0", F.min), ("x1", F.max), ("y1", F.max)))], F.count("*").alias("n"))


def box_inclusion_anti(s, d):
    """Text boxes without those that lie for more than nine tenths in a structured one of their record."""
    b = _boxes(s, d)
    t, o = b.where("family = 'text'"), b.where("family = 'structured'").select("record_id", F.col("b").alias("o"))
    inside = t.join(o, "record_id").where(G.contained(F.col("b"), F.col("o")) > 0.9).select("record_id", "pos").distinct()
    return t.join(inside, ["record_id", "pos"], "left_anti").select("record_id", "pos")


def assign_words_to_cells(s, d):
    b = _boxes(s, d)
    return assign(b.where("family = 'text'").select("record_id", F.col("pos").alias("word"), F.col("b").alias("word_box")), b.where("family = 'structured'").select("record_id", F.col("pos").alias("cell"), F.col("b").alias("cell_box")), "record_id")


def box_fusion(s, d):
    return fuse_boxes(_boxes(s, d).select(F.col("record_id").alias("page"), F.col("family").alias("label"), F.col("b").alias("box"), (F.lit(0.9) - F.pmod("pos", F.lit(5)) / 10).alias("score")), 0.3)


QUERIES = {f.__name__: f for f in (bbox_iou_anti, bbox_union, box_inclusion_anti, assign_words_to_cells, box_fusion)}

_LAST = "SELECT * FROM extractions WHERE record_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY received_at DESC NULLS LAST) = 1"
_JSON = f"SELECT record_id, json_extract(coalesce(json_extract(j, '$.metadata.content_metadata'), json_extract(j, '$.content_metadata'), json_extract(j, '$.metadata'), j), '$.hierarchy.nearby_objects') AS n FROM (SELECT record_id, try_cast(raw_metadata AS JSON) AS j FROM ({_LAST}) WHERE content_metadata IS NULL)"
_ITEM = "CASE json_type(e) WHEN 'ARRAY' THEN list_transform(json_extract(e, '$[*]'), lambda v: v::DOUBLE) WHEN 'OBJECT' THEN [" + ", ".join(f"json_extract(e, '$.{k}')::DOUBLE" for k in ("x0", "y0", "x1", "y1")) + "] END"
_FAMILY = lambda f: f"SELECT record_id, '{f}' AS family, unnest(range(len(x))) AS pos, unnest(x) AS b FROM (SELECT record_id, content_metadata.hierarchy.nearby_objects.{f}.bbox AS x FROM ({_LAST})) UNION ALL SELECT record_id, '{f}', pos, {_ITEM} FROM (SELECT record_id, unnest(range(len(x))) AS pos, unnest(x) AS e FROM (SELECT record_id, CASE json_type(json_extract(n, '$.{f}')) WHEN 'ARRAY' THEN list_transform(json_extract(n, '$.{f}[*]'), lambda o: json_extract(o, '$.bbox')) WHEN 'OBJECT' THEN json_extract(n, '$.{f}.bbox[*]') END AS x FROM ({_JSON})))"
_B = f"SELECT record_id, family, pos, b FROM ({' UNION ALL '.join(map(_FAMILY, ('text', 'images', 'structured')))}) WHERE len(b) = 4 AND b[3] > b[1] AND b[4] > b[2]"
_N = lambda a, b: f"greatest(least({a}[3], {b}[3]) - greatest({a}[1], {b}[1]), 0) * greatest(least({a}[4], {b}[4]) - greatest({a}[2], {b}[2]), 0)"
_A = lambda a: f"(({a}[3] - {a}[1]) * ({a}[4] - {a}[2]))"
SQL = {
    "bbox_iou_anti": f"WITH b AS ({_B}), i AS (SELECT * FROM b WHERE family = 'images'), s AS (SELECT * FROM b WHERE family = 'structured'), k AS (SELECT record_id, count(*) AS n FROM i WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.record_id = i.record_id AND {_N('i.b', 's.b')} / ({_A('i.b')} + {_A('s.b')} - {_N('i.b', 's.b')}) >= 0.1) GROUP BY 1) SELECT record_id, coalesce(n, 0)::INT AS n_images, m::INT AS n_structured FROM (SELECT record_id, count_if(family = 'structured') AS m FROM b GROUP BY 1) LEFT JOIN k USING (record_id)",
    "bbox_union": f"SELECT record_id, family, min(b[1]) AS x0, min(b[2]) AS y0, max(b[3]) AS x1, max(b[4]) AS y1, count(*) AS n FROM ({_B}) GROUP BY 1, 2",
    "box_inclusion_anti": f"WITH b AS ({_B}) SELECT record_id, pos::INT AS pos FROM b t WHERE family = 'text' AND NOT EXISTS (SELECT 1 FROM b s WHERE s.family = 'structured' AND s.record_id = t.record_id AND {_N('t.b', 's.b')} / {_A('t.b')} > 0.9)",
    "assign_words_to_cells": f"WITH b AS ({_B}), j AS (SELECT t.record_id, t.pos::INT AS word, s.pos::INT AS cell, {_N('t.b', 's.b')} / {_A('t.b')} AS share FROM b t JOIN b s USING (record_id) WHERE t.family = 'text' AND s.family = 'structured') SELECT record_id, word, cell, round(share, 6) AS share FROM (SELECT *, max(share) OVER (PARTITION BY record_id, word) AS top FROM j) WHERE top > 0.25 AND share >= top / 2",
}
