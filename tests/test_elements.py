"""Elements, frames, leases, fusion and store policies against brute force and built cases."""

import glob
import json
import random
import time

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagemill.operators import catalogue as C
from pagemill.operators import elements as E
from pagemill.operators import geometric as G
from pagemill.sources import files as S
from pagemill.streaming import work


def test_expressions(spark):
    one = spark.range(1)
    v = lambda c: one.select(c).first()[0]
    assert v(E.tile_starts(F.lit(1000), 400, 0.25)) == [0, 300, 600] and v(E.tile_starts(F.lit(300), 400, 0.2)) == [0] and v(E.tile_starts(F.lit(1050), 400, 0.25)) == [0, 300, 600, 650]
    assert v(E.by_headings(F.lit("intro\n# A\nx\n## B\ny # no"))) == ["intro\n", "# A\nx\n", "## B\ny # no"]
    assert v(E.sub_queries(F.lit('```json\n[" a ", "b", ""]\n```'), F.lit("q"))) == ["a", "b"] and v(E.sub_queries(F.lit("none"), F.lit("q"))) == ["q"]
    assert v(E.hamming(F.lit(5), F.lit(6))) == 2
    assert v(C.canonical_sql(F.lit("SELECT b,  a FROM t WHERE x = 'it''s' AND n=3.5;"))) == "select a,b from t where x=? and n=?"


def test_frames_follow_the_head(spark):
    rng = random.Random(3)
    rows = [("s", i, float(i), float(i + 1 + (i % 7 == 0)), 2.0 if i % 3 else None, (0xF0F0 ^ sum(1 << rng.randrange(16) for _ in range(rng.randrange(4)))) if i % 11 else None) for i in range(200)]
    rows = [r for r in rows if r[1] % 13] + [(None, 900, 0.0, 1.0, None, 1), ("t", 901, 0.0, 1.0, 0.0, -1)]
    want, head, end = [], None, None
    for s, f, a, b, fps, h in [r for r in rows if r[0] == "s"]:
        if head is not None and h is not None and (h ^ head).bit_count() <= 5 and a - end <= 2 / (fps or 1.0):
            want[-1] = (*want[-1][:3], max(want[-1][3], b), want[-1][4] + 1)
        else:
            want.append((s, f, a, b, 1))
            head = h
        end = b
    got = E.merge_frames(spark.createDataFrame(rows, "source string, frame bigint, start double, end double, fps double, hash bigint")).orderBy("source", "start").collect()
    assert [tuple(r) for r in got] == [*want, ("t", 901, 0.0, 1.0, 1)]
    dark = np.tile(np.arange(90), (64, 1))
    assert E.difference_hash(dark) == -1 and E.difference_hash(dark[:, ::-1]) == 0


def test_segments(spark):
    rows = [(1, "all", 10.0, 5.0, [(0.0, 2000.0, " a "), (2000.0, 5000.0, "b")]), (2, "own", 10.0, 5.0, [(0.0, 1.0, " ")]), (3, "x", 0.0, 5.0, None), (4, "y", 1.0, 5.0, [(0.5, 5.0, "z")])]
    got = E.segments(spark.createDataFrame(rows, "key int, text string, chunk_start double, duration double, segments array<struct<start double, end double, text string>>")).orderBy("key", "segment").collect()
    assert [(r["key"], r["start"], r["end"], r["text"]) for r in got] == [(1, 10.0, 12.0, "a"), (1, 12.0, 15.0, "b"), (2, 10.0, 15.0, "own"), (3, 0.0, 5.0, "x"), (4, 1.5, 6.0, "z")]


def test_owners_and_images_once(spark):
    m = lambda label, x: (label, None, None, [x, 0.0, 1.0, 1.0], "s")
    rows = [("p", 1, "table", "raw", [m("image", 0.1)]), ("p", 2, "text", "raw", [m("image", 0.10001), m("chart", 0.1)]), ("p", 3, "text", "raw", None), ("q", 1, "text", "raw", [m("image", 0.1)])]
    df = spark.createDataFrame(rows, f"page string, place int, content_type string, raw_text string, images array<{E.IMAGE}>")
    owner = {(r["page"], r["place"]): r["raw_text"] for r in E.first_owner(df, ["page"], "raw_text").collect()}
    assert owner == {("p", 1): None, ("p", 2): "raw", ("p", 3): None, ("q", 1): "raw"}
    left = {(r["page"], r["place"]): [i["label"] for i in r["images"]] for r in E.images_once(df, ["page"]).collect()}
    assert left == {("p", 1): ["image"], ("p", 2): ["chart"], ("p", 3): [], ("q", 1): ["image"]}


def test_structured_or_images_win(spark):
    rows = [(1, 1, "image", [0.0, 0.0, 1.0, 1.0]), (2, 1, "image", [0.0, 0.0, 1.0, 0.9]), (3, 1, "structured", [0.0, 0.0, 1.0, 0.95]), (4, 1, "structured", [0.5, 0.5, 0.6, 0.6]), (5, 2, "image", None)]
    df = spark.createDataFrame(rows, "id bigint, page int, kind string, box array<double>")
    keep = lambda wins: sorted(r["id"] for r in E.drop_duplicates_by_box(df, "page", 0.45, wins).collect())
    assert keep(True) == [3, 4, 5] and keep(False) == [1, 2, 4, 5]


def test_fusion(spark):
    rows = [(1, "a", [0.0, 0.0, 0.5, 0.5], 0.9), (1, "a", [0.1, 0.0, 0.5, 0.5], 0.3), (1, "b", [0.5, 0.5, -1.0, 0.0], 0.8), (1, "a", [0.2, 0.2, 0.2, 0.9], 0.9), (2, "a", [0.0, 0.0, 0.2, 2.0], 0.5)]
    df = spark.createDataFrame(rows, "page bigint, label string, box array<double>, score double")
    got = {(r["page"], r["label"]): (r["box"], r["score"]) for r in G.fuse_boxes(df).collect()}
    assert set(got) == {(1, "a"), (1, "b"), (2, "a")} and got[2, "a"][0] == [0.0, 0.0, 0.2, 1.0] and got[1, "b"][0] == [0.0, 0.0, 0.5, 0.5]
    assert got[1, "a"][0] == pytest.approx([0.025, 0.0, 0.5, 0.5]) and got[1, "a"][1] == pytest.approx(0.6)
    any_label = [r for r in G.fuse_boxes(df, union=True, most=True, by_label=False).collect() if r["page"] == 1]
    assert [(r["label"], r["box"], r["score"]) for r in any_label] == [("a", [0.0, 0.0, 0.5, 0.5], 0.9)]
    assert G.without_overlap(df).count() == 3 and G.fuse_boxes(df, least=0.85).count() == 1


def test_box_fusion_keeps_every_box_in_a_cluster(spark, sf):
    boxes = G._boxes(spark, sf)
    got = G.box_fusion(spark, sf).groupBy("page", "label").agg(F.count("*").alias("n"), F.min(F.col("box")[0]).alias("x")).collect()
    have = {(r["record_id"], r["family"]): r["n"] for r in boxes.groupBy("record_id", "family").agg(F.count("*").alias("n")).collect()}
    assert {(r["page"], r["label"]) for r in got} == set(have) and all(1 <= r["n"] <= have[r["page"], r["label"]] for r in got)


def test_leases(spark, tmp_path):
    e = lambda seq, at, kind, gen=None, item=1: (item, seq, float(at), kind, gen)
    rows = [e(1, 0, "enqueue"), e(2, 1, "claim"), e(3, 30, "heartbeat", 1), e(4, 200, "claim"), e(5, 201, "complete", 1), e(6, 300, "claim"), e(7, 400, "expire"), e(8, 500, "claim"), e(1, 0, "enqueue", None, 2), e(2, 5, "claim", None, 2), e(3, 6, "complete", 1, 2), e(4, 7, "complete", 1, 2), e(1, 0, "claim", None, 3)]
    df = spark.createDataFrame(rows, work.EVENT)
    got = {(r["item_id"], r["seq"]): (r["outcome"], r["status"]) for r in work.replayed(df).collect()}
    assert [got[1, i][0] for i in range(1, 9)] == ["ok", "ok", "ok", "ok", "stale", "ok", "exhausted", "idempotent"] and got[1, 8][1] == "failed"
    assert [got[2, i] for i in (3, 4)] == [("ok", "completed"), ("idempotent", "completed")] and got[3, 1] == ("unknown", "")
    twice = df.union(df.where("seq <= 3")).orderBy("item_id", "seq")
    assert work.replayed(twice).where("outcome = 'replayed'").count() == 7
    # three leases that run out exhaust an item
    lost = spark.createDataFrame([e(1, 0, "enqueue"), *[e(i + 2, i * 100 + 1, "claim") for i in range(4)]], work.EVENT)
    assert work.replayed(lost).orderBy(F.desc("seq")).first()["status"] == "failed"
    assert [r[0] for r in work.claimable(work.replayed(df), 5).collect()] == []


def test_leases_in_a_stream_and_epochs(spark, tmp_path):
    rows = [(1, 1, 0.0, "enqueue", None), (1, 2, 1.0, "claim", None), (1, 3, 2.0, "complete", 1), (1, 3, 2.0, "complete", 1)]
    df = spark.createDataFrame(rows, work.EVENT)
    df.where("seq < 3").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    # the timers of leases make batches without end: wait for the rows
    q = work.brokered(stream).writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").trigger(processingTime="1 second").foreachBatch(work.epoch_writer(f"{tmp_path}/out")).start()
    try:
        for wanted in (2, 4):
            for _ in range(60):
                time.sleep(1)
                if glob.glob(f"{tmp_path}/out/*/*.parquet") and spark.read.parquet(f"{tmp_path}/out").count() >= wanted:
                    break
            if wanted == 2:
                df.where("seq = 3").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    finally:
        q.stop()
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("seq", "outcome").collect()
    assert [(r["seq"], r["outcome"]) for r in got] == [(1, "ok"), (2, "ok"), (3, "ok"), (3, "replayed")]
    write = work.epoch_writer(f"{tmp_path}/again")
    for _ in range(2):
        write(df, 7)
    assert spark.read.parquet(f"{tmp_path}/again").count() == 4


def test_store_policies(spark, tmp_path):
    rows = [("a", [1.0, 2.0], "text"), (" ", [1.0, 2.0], "image"), (" ", [1.0, 2.0], "text"), ("b", [1.0], "text"), ("c", None, "text"), ("d", [1.0, float("nan")], "text")]
    df = spark.createDataFrame(rows, "text string, embedding array<double>, content_type string")
    n = lambda **k: S.write_table(df, f"{tmp_path}/t", least_dim=2, **k).first().asDict()
    assert n() == {"dropped_no_embedding": 1, "dropped_bad_length": 1, "dropped_no_text": 1, "written": 3}
    n(mode="append")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 6 and n(sparse=True)["written"] == 4
    S.write_table(df, f"{tmp_path}/t", least_dim=2)
    with pytest.raises(ValueError):
        S.write_table(df, f"{tmp_path}/t", "append", 1)
    with pytest.raises(ValueError):
        S.write_table(df.drop("content_type"), f"{tmp_path}/t", "append", 2)
    assert C.bad_vectors(df, 2).count() == 3 and C.bad_vectors(df, 2, "fill", 0.5).where("embedding = array(0.5D, 0.5D)").count() == 3
    with pytest.raises(PySparkException):
        C.bad_vectors(df, 2, "error").collect()
    S.write_records(df, f"{tmp_path}/r.jsonl")
    assert S.read_records(spark, f"{tmp_path}/r.jsonl").count() == 6
    assert S.transport(spark.createDataFrame([("x" * 600, "y" * 600, [1.0])], "text string, note string, embedding array<double>")).first() == ("x" * 600, "y" * 500, None)


def test_catalogue_of_the_session(spark):
    spark.createDataFrame([(1, "x")], "id int, name string").createOrReplaceTempView("some_view")
    tables, columns = C.introspect(spark)
    assert tables.where("table_name = 'some_view'").count() == 1 and [r["column_name"] for r in columns.where("table_name = 'some_view'").orderBy("ordinal_position").collect()] == ["id", "name"]
    loose = spark.createDataFrame([("s", "t", "7", "me")], "table_schema string, table_name string, ordinal_position string, owner string")
    assert C.normalised(loose, C.CATALOGUE["columns"]).first().asDict()["ordinal_position"] == 7 and json.loads(C.normalised(loose, C.CATALOGUE["tables"]).toJSON().first())["table_type"] == C.BASE_TABLE
